"""Pairwise similarities as column expressions; edit ratios as one Arrow function.

Guards: two empty strings are alike (1.0), an empty and another are not (0.0).
Edit ratios are those of insertions and deletions: twice the longest common
subsequence over the sum of both lengths.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .text import WS


def safe(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def _guarded(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(value)


def words(col: Column) -> Column:
    """White-space tokens, in order."""
    return F.array_remove(F.split(col, f"[{WS}]+"), "")


def word_set(col: Column) -> Column:
    return F.array_distinct(words(col))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def set_jaccard(x: Column, y: Column) -> Column:
    """Of two arrays of distinct values; the union's size follows from the intersection's."""
    both = F.size(F.array_intersect(x, y))
    return _share(both, F.size(x) + F.size(y) - both)


def jaccard(a: Column, b: Column, tokenize: bool = True, x: Column | None = None, y: Column | None = None) -> Column:
    """Of the sets of tokens, or of characters; ``x`` and ``y``: sets that are known already."""
    parts = word_set if tokenize else (lambda c: F.array_distinct(F.array_remove(F.split(c, ""), "")))
    return _guarded(a, b, set_jaccard(parts(a) if x is None else x, parts(b) if y is None else y))


def token_overlap(a: Column, b: Column, x: Column | None = None, y: Column | None = None) -> Column:
    """Share of a's distinct tokens that b has."""
    x, y = word_set(a) if x is None else x, word_set(b) if y is None else y
    return _guarded(a, b, _share(F.size(F.array_intersect(x, y)), F.size(x)))


def ngrams(col: Column, n: int) -> Column:
    """Distinct character n-grams, spaces included; none of shorter strings."""
    some = F.transform(F.sequence(F.lit(1), F.length(col) - (n - 1)), lambda i: F.substr(col, i, F.lit(n)))
    return F.when(F.length(col) >= n, F.array_distinct(some)).otherwise(F.array().cast("array<string>"))


def ngram_overlap(a: Column, b: Column, n: int = 3, x: Column | None = None, y: Column | None = None) -> Column:
    """Jaccard of n-gram sets; guards are on the sets, so two short strings are alike."""
    x, y = ngrams(a, n) if x is None else x, ngrams(b, n) if y is None else y
    short_a, short_b = F.length(a) < n, F.length(b) < n
    return F.when(short_a & short_b, 1.0).when(short_a | short_b, 0.0).otherwise(set_jaccard(x, y))


def relative_difference(x: Column, y: Column) -> Column:
    return F.abs(x - y) / (F.greatest(x, y) + 1)


def length_difference(a: Column, b: Column) -> Column:
    return relative_difference(F.length(a), F.length(b))


def token_count_difference(a: Column, b: Column, n: Column | None = None, m: Column | None = None) -> Column:
    return relative_difference(F.size(words(a)) if n is None else n, F.size(words(b)) if m is None else m)


def positional_ratio(a: Column, b: Column, max_len: int = 200) -> Column:
    """The edit ratio's stand-in without subsequences: equal characters at equal places."""
    x, y = F.substring(a, 1, max_len), F.substring(b, 1, max_len)
    same = F.aggregate(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: F.when((p == q) & (p != ""), 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    return _guarded(x, y, 2.0 * same / (F.length(x) + F.length(y)))


def lcs(masks: dict[str, int], size: int, other: str) -> int:
    """Length of the longest common subsequence, with the first string's character masks; bit-parallel."""
    full = (1 << size) - 1
    rows = full
    for c in other:
        hit = rows & masks.get(c, 0)
        rows = ((rows + hit) | (rows - hit)) & full
    return size - rows.bit_count()


def masks_of(s: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(s):
        out[c] = out.get(c, 0) | 1 << i
    return out


def edit_ratio(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    return 2.0 * lcs(masks_of(a), len(a), b) / (len(a) + len(b)) if a != b else 1.0


def _windows(short: str, long: str) -> list[tuple[float, int, int]]:
    """Windows of ``long`` of the other's length or cut at an end: an upper bound of the edit ratio, begin and end.

    The bound counts the characters that both hold; from one window to the next a
    character comes and one goes.
    """
    m, n = len(short), len(long)
    open_, shared, out = {}, 0, []
    for c in short:
        open_[c] = open_.get(c, 0) + 1
    for end in range(1, n + m):
        if end <= n:
            c = long[end - 1]
            open_[c] = open_.get(c, 0) - 1
            shared += open_[c] >= 0
        begin = end - m
        if begin > 0:
            c = long[begin - 1]
            shared -= open_[c] >= 0
            open_[c] += 1
        a, z = max(0, begin), min(end, n)
        out.append((2.0 * shared / (m + z - a), a, z))
    return out


def best_window(a: str, b: str) -> float:
    """The best edit ratio of the shorter string and a window of the longer, of its length or cut at an end.

    Windows are looked at in the order of their bounds, until none can be better.
    """
    if not a or not b:
        return float(a == b)
    if a in b or b in a:
        return 1.0
    pairs = [(a, b), (b, a)] if len(a) == len(b) else [(a, b) if len(a) < len(b) else (b, a)]
    best = 0.0
    for short, long in pairs:
        m, masks = len(short), masks_of(short)
        for bound, begin, end in sorted(_windows(short, long), reverse=True):
            if bound <= best:
                break
            best = max(best, 2.0 * lcs(masks, m, long[begin:end]) / (m + end - begin))
    return best


#: Characters of the shorter string that one machine word holds, and windows that are matched together.
WORD, TOGETHER = 64, 1 << 19


def _masks(short: str, long: str) -> np.ndarray:
    """For each character of ``long`` where it stands in ``short`` (at most ``WORD`` characters), as bits."""
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in (short, long))
    return ((a[:, None] == b) * (np.uint64(1) << np.arange(len(a), dtype=np.uint64))[:, None]).sum(axis=0, dtype=np.uint64)


def _lcs_of(masks: np.ndarray, begin: np.ndarray, size: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Longest common subsequences of many strings of ``width`` characters with the windows of ``masks``; all take a step together."""
    order = np.argsort(-size, kind="stable")
    begin, active = begin[order], -size[order]
    rows = np.full(len(order), np.iinfo(np.uint64).max)
    for step in range(int(size.max(initial=0))):
        n = int(np.searchsorted(active, -step))  # windows longer than the steps so far
        now = rows[:n]
        hit = now & masks[begin[:n] + step]
        rows[:n] = (now + hit) | (now - hit)
    inside = np.full(len(width), np.iinfo(np.uint64).max) >> (WORD - width).astype(np.uint64)
    out = np.empty(len(order), np.int64)
    out[order] = width[order] - np.bitwise_count(rows & inside[order])
    return out


def _best_of(jobs: list[tuple[int, str, str]], windows: bool, out: list[float]) -> None:
    """Raise ``out`` at each job's place to its best edit ratio, of the whole strings or of the windows."""
    masks, at, begin, size, width, owner = [], 0, [], [], [], []
    for place, short, long in jobs:
        m, n = len(short), len(long)
        masks.append(_masks(short, long))
        if windows:
            ends = np.arange(1, n + m)
            first, last = np.maximum(0, ends - m), np.minimum(ends, n)
        else:
            first, last = np.zeros(1, np.int64), np.full(1, n)
        begin.append(at + first)
        size.append(last - first)
        width.append(np.full(len(first), m))
        owner.append(np.full(len(first), place))
        at += n
    flat = [np.concatenate(x) for x in (masks, begin, size, width, owner)]
    shared = _lcs_of(*flat[:4])
    best = np.zeros(len(out))
    np.maximum.at(best, flat[4], 2.0 * shared / (flat[2] + flat[3]))
    for place, _, _ in jobs:
        out[place] = max(out[place], float(best[place]))


def ratios_of(kind: str, pairs: list[tuple[str, str]]) -> list[float]:
    """Edit ratios (``edit``) or best windows (``partial``) of pairs; those of a longer shorter string than a word one by one."""
    out, jobs, lanes = [0.0] * len(pairs), [], 0
    windows, alone = kind == "partial", {"edit": edit_ratio, "partial": best_window}[kind]
    for place, (a, b) in enumerate(pairs):
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        if not short or a == b or windows and short in long:
            out[place] = 1.0 if a == b or short and windows and short in long else 0.0
        elif len(short) > WORD:
            out[place] = alone(a, b)
        else:
            jobs.append((place, short, long))
            if windows and len(a) == len(b):
                jobs.append((place, long, short))
            lanes += (len(a) + len(b)) * (1 + windows)
            if lanes >= TOGETHER:
                _best_of(jobs, windows, out)
                jobs, lanes = [], 0
    if jobs:
        _best_of(jobs, windows, out)
    return out


def _ratio(kind: str) -> Callable:
    @pandas_udf(DoubleType())
    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = list(zip(a, b, strict=True))
        distinct = list(dict.fromkeys(pairs))
        known = dict(zip(distinct, ratios_of(kind, distinct), strict=True))
        return pd.Series([known[p] for p in pairs], dtype="float64")

    return ratios


def edit_similarity(a: Column, b: Column, max_len: int = 200) -> Column:
    """Of at most the first ``max_len`` characters."""
    return _ratio("edit")(F.substring(safe(a), 1, max_len), F.substring(safe(b), 1, max_len))


def partial_ratio(a: Column, b: Column) -> Column:
    return _ratio("partial")(safe(a), safe(b))


def token_sort_ratio(a: Column, b: Column) -> Column:
    in_order = lambda c: F.array_join(F.array_sort(words(safe(c))), " ")
    return _ratio("edit")(in_order(a), in_order(b))
