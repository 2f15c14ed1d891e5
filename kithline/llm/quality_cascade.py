"""Quality rules as a short-circuit cascade, with DataFrame functions only.

A rule has statistics of the text and a test that rejects.  On a bounded sample
every rule's cost (seconds to evaluate it beside what is known by then) and
selectivity (share that it rejects) are measured; the rules then stand in the order
of rejection per cost, and each is evaluated only on texts that no earlier rule
rejected.  The verdict is that of all rules together: the order decides the time
taken, never a result.

Defined results: a null text has no words and fails the word minimum; an empty
table gives an empty table; repeated rows are judged alike; texts are judged
whole, however long; rules of equal yield stand by cost, then by name; a limit that
is reached but not passed does not reject; columns of the input other than id and
text, whatever their names, are ignored by :func:`statistics` and kept by
:func:`kept_rows`.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, stored

WHITE = r"[ \t\n\x0B\f\r]+"
SPACE = r" \t\n\x0B\f\r"
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = "the of and to in is that for with was on are as it by at from le la les des et en un une est que dans du der die das und ist von zu den mit auf ein eine el los las y por con del se".split()
#: About so many rows are timed to order the rules; they decide the order only.
SAMPLE_ROWS = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def counted(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def symbols(text: Column) -> Column:
    return counted(text, r"[#*$%&|<>]")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(worded_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(ws: Column, width: int = WINDOW) -> Column:
    """Words covered by windows of ``width`` words that the text holds twice or more.

    Only texts with two equal window hashes sort (hash, place) pairs; the places
    whose neighbour in that order has the same hash are covered.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda v, x, k: F.coalesce(F.get(v, k)["h"] == x["h"], F.lit(False))
        places = let(pairs, lambda v: F.sort_array(F.transform(F.filter(v, lambda x, k: same(v, x, k + 1) | same(v, x, k - 1)), lambda x: x["i"])))
        steps = lambda q: F.transform(q, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(q, k + 1) - x, F.lit(width))))
        return let(places, lambda q: F.aggregate(steps(q), F.lit(0).cast("long"), lambda a, x: a + x))

    none = F.lit(0).cast("long")
    hashes = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(width))))
    some = lambda w: let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(none))
    return let(ws, lambda w: F.when(F.size(w) >= width, some(w)).otherwise(none))


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function that gives the named statistic as a column."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


#: Statistics by name, from the text (never null) and its words.
STATISTICS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, ws: F.size(ws).cast("long"),
    "word_chars": lambda t, ws: F.length(F.array_join(ws, "")).cast("long"),
    "n_symbols": lambda t, ws: symbols(t),
    "n_dup_lines": lambda t, ws: repeated_lines(t),
    "n_repeat_words": lambda t, ws: repeated_words(ws),
    "n_lines": lambda t, ws: F.size(worded_lines(t)).cast("long"),
    "n_bangs": lambda t, ws: counted(t, "!"),
    "n_lettered": lambda t, ws: counted(t, rf"[^A-Za-z\x80-\x{{10FFFF}}{SPACE}]*[A-Za-z\x80-\x{{10FFFF}}][^{SPACE}]*"),
    "n_stop": lambda t, ws: counted(t, rf"(?i)(?<![^{SPACE}])(?:{'|'.join(STOP_WORDS)})(?![^{SPACE}])"),
    "n_capitals": lambda t, ws: counted(t, rf"(?<![^{SPACE}])[A-Z]{{2,}}(?![^{SPACE}])"),
    "n_stutter": lambda t, ws: F.size(F.filter(ws, lambda x, i: F.coalesce(F.get(ws, i - 1) == x, F.lit(False)))).cast("long"),
    "n_bullets": lambda t, ws: counted(t, r"(?md)^[ \t]*[-*\u2022\u2023\u2013][ \t]"),
    "n_ellipses": lambda t, ws: counted(t, r"(?md)(?:\.\.\.|\u2026)[ \t\x0B\f\r]*$"),
}
BASE = [
    Rule("few_words", lambda s: s("n_words") < 20),
    Rule("repeated_words", lambda s: 100 * s("n_repeat_words") > 30 * s("n_words")),
]
#: The rules that follow the base rules; limits that clean prose of the four languages stays far from.
OWN = [
    Rule("symbols", lambda s: 10 * s("n_symbols") > s("n_words")),
    Rule("shouting", lambda s: 2 * s("n_bangs") > s("n_words")),
    Rule("repeated_lines", lambda s: (2 * s("n_dup_lines") > s("n_lines")) | ((s("n_lines") >= 5) & (10 * s("n_dup_lines") > 3 * s("n_lines")))),
    Rule("word_length", lambda s: (s("word_chars") < 2 * s("n_words")) | (s("word_chars") > 15 * s("n_words"))),
    Rule("letters", lambda s: 10 * s("n_lettered") < 6 * s("n_words")),
    Rule("stop_words", lambda s: (s("n_words") >= 50) & (s("n_stop") < 2)),
    Rule("capitals", lambda s: 2 * s("n_capitals") > s("n_words")),
    Rule("stutter", lambda s: 10 * s("n_stutter") > 3 * s("n_words")),
    Rule("bullets", lambda s: 10 * s("n_bullets") > 9 * s("n_lines")),
    Rule("ellipses", lambda s: 10 * s("n_ellipses") > 3 * s("n_lines")),
]
#: The rules of a training corpus: short texts of clean prose stay, so its word minimum is lower; no contract fixes these.
CORPUS = [Rule("few_words", lambda s: s("n_words") < 3), BASE[1], *OWN]


def of_text(text: Column, body: Callable[[Callable[[str], Column]], Column], known: dict[str, Column] | None = None) -> Column:
    """``body`` of a function that gives a statistic of the text by name, known ones as they are; the text is cut into words once."""
    whole, own = F.coalesce(text.cast("string"), F.lit("")), known or {}
    return let(words(whole), lambda ws: body(lambda name: own[name] if name in own else STATISTICS[name](whole, ws)))


def order_rules(df: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS, known: Sequence[str] = ()) -> list[tuple[Rule, float, float]]:
    """Rules with cost and selectivity on a sample, by rejection per cost, where the statistics ``known`` cost nothing."""
    total = df.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    given = df.select(F.col(text).cast("string").alias("t")).sample(min(1.0, rows / total), 7).repartition(2)
    sample = stored(given.select("t", *[of_text(F.col("t"), lambda s, n=n: s(n)).alias(n) for n in known]), "cascade-sample")
    columns, measured = {n: F.col(n) for n in known}, []
    for rule in [Rule("", lambda s: F.lit(False)), *rules]:
        began = time.perf_counter()
        seen, bad = sample.agg(F.count("*"), F.count_if(of_text(F.col("t"), rule.rejects, columns))).first()
        measured.append((rule, time.perf_counter() - began, bad / max(1, seen)))
    forget(sample)
    floor = min(m[1] for m in measured)
    return sorted(((r, c - floor + 1e-3, s) for r, c, s in measured[1:]), key=lambda x: (-x[2] / x[1], x[1], x[0].name))


def cascade(order: Sequence[Rule], statistic: Callable[[str], Column]) -> Column:
    """True where no rule rejects; a rule is evaluated where those before it did not reject."""
    verdict = F.lit(True)
    for rule in reversed(order):
        verdict = F.when(F.coalesce(rule.rejects(statistic), F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def kept_rows(df: DataFrame, text: str = "text", rules: Sequence[Rule] = (*BASE, *OWN)) -> DataFrame:
    """The rows of ``df`` that no rule rejects, with their columns unchanged."""
    order = [r for r, _, _ in order_rules(df, rules, text)]
    return df.filter(of_text(F.col(text), lambda s: cascade(order, s)))


#: Statistics that the query reports of every document, whatever its verdict.
REPORTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the base statistics, ``base_failed`` and the cascade's verdict ``kept``.

    The reported statistics are due of every document, so the cascade orders and
    skips the own rules by what they cost beside these.
    """
    given = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = [r for r, _, _ in order_rules(given, OWN, known=REPORTED)]
    worded = given.withColumn("words", words(F.col("text")))
    inline = lambda n: STATISTICS[n](F.col("text"), F.col("words"))
    reported = worded.select("doc_id", "text", "words", *[inline(n).alias(n) for n in REPORTED])
    known = lambda n: F.col(n) if n in REPORTED else inline(n)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = reported.withColumn("base_failed", failed)
    return judged.select("doc_id", *REPORTED, "base_failed", (~F.col("base_failed") & cascade(order, known)).alias("kept"))
