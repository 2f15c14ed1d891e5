"""The 25 features of a candidate pair, each in [0, 1]."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..schema import CAND, PREFIXES, S1, Settings
from ..tables import stored
from .blocking import weights
from .labels import truth_pairs

#: Lists of an S1 record's pairs, candidates that every task gets at a time, and so many times at most.
LISTS, FEW, TURNS = 16, 1 << 14, 64

# Names and order of the features.
FEATURES = [
    "name_exact_match", "name_jaccard", "name_token_overlap_s1", "name_token_overlap_cand", "name_edit_similarity", "name_partial_ratio",
    "name_token_sort_ratio", "name_trigram_overlap", "name_bigram_overlap", "name_len_diff", "name_token_count_diff",
    "addr_jaccard", "addr_token_overlap_s1", "addr_token_overlap_cand", "addr_edit_similarity", "addr_trigram_overlap", "addr_len_diff",
    "country_exact_match",
    "s1_name_missing", "cand_name_missing", "s1_addr_missing", "cand_addr_missing", "s1_country_missing", "cand_country_missing",
    "is_s2",
]


def feature_names() -> list[str]:
    return list(FEATURES)


def looked_up(pairs: DataFrame, s1: DataFrame, cands: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """Pairs with the normalised name, address and country of both sides (n1, a1, c1, n2, a2, c2), unknown ids with empty ones.

    Token sets of names and addresses (x1, y1, x2, y2), the names' token counts
    (t1, t2) and n-gram sets (g31, g32, g21, g22 of names, h31, h32 of addresses)
    are made once for each record, before the join.  ``pairs`` may be lists (S1 id,
    ids).  Lists go to their S1 records, and every task gets the candidates that they
    name, ``FEW`` at a time, so that no row of a pair is shuffled with its texts; beyond
    ``TURNS`` times that, pairs are joined with the texts alone.  ``truth``: the column
    ``label`` is 1 for pairs that it lists, else 0.
    """
    name, address = F.col("business_name_normalized"), F.col("business_address_normalized")

    def texts(df: DataFrame, key: str, k: str) -> DataFrame:
        return df.select(F.col("entity_id").alias(key), name.alias(f"n{k}"), address.alias(f"a{k}"), F.col("country_normalized").alias(f"c{k}"))

    def with_sets(df: DataFrame, k: str) -> DataFrame:
        n, a = F.col(f"n{k}"), F.col(f"a{k}")
        return df.withColumns({f"x{k}": sim.word_set(n), f"y{k}": sim.word_set(a), f"t{k}": F.size(sim.words(n)), f"g3{k}": sim.ngrams(n, 3), f"g2{k}": sim.ngrams(n, 2), f"h3{k}": sim.ngrams(a, 3)})

    own = ["entity_id", "business_name_normalized", "business_address_normalized", "country_normalized"]
    listed = pairs if "ids" in pairs.columns else pairs.groupBy(S1, F.pmod(F.xxhash64(CAND), F.lit(LISTS))).agg(F.collect_list(CAND).alias("ids"))
    named = stored(cands.select(*own).join(listed.select(F.explode("ids").alias("entity_id")).distinct(), "entity_id", "left_semi"), "named-candidates")
    listed = listed.select(S1, "ids").join(texts(s1, S1, "1"), S1, "left")
    extra = []
    if truth is not None:
        known = truth_pairs(truth).groupBy(S1).agg(F.collect_set(CAND).alias("known"))
        listed, extra = listed.join(known, S1, "left"), [F.when(F.array_contains("known", F.col(CAND)), 1).otherwise(0).alias("label")]
    turns = max(1, -(-named.count() // FEW))
    if turns > TURNS:
        joined = with_sets(with_sets(listed.withColumn(CAND, F.explode("ids")).join(texts(named, CAND, "2"), CAND, "left"), "1"), "2")
    else:
        if turns > 1:
            listed = stored(listed, "lists-with-texts")
        listed = with_sets(listed, "1")
        turn = lambda c: F.pmod(F.xxhash64(c), F.lit(turns))
        few = lambda k: with_sets(texts(named.filter(turn("entity_id") == k), CAND, "2"), "2") if turns > 1 else with_sets(texts(named, CAND, "2"), "2")
        ids = lambda k: F.filter("ids", lambda c: turn(c) == k) if turns > 1 else F.col("ids")
        joined = reduce(DataFrame.unionByName, [listed.withColumn(CAND, F.explode(ids(k))).join(F.broadcast(few(k)), CAND, "left") for k in range(turns)])
    empty = F.array().cast("array<string>")
    none = {"n": F.lit(""), "a": F.lit(""), "c": F.lit(""), "x": empty, "y": empty, "t": F.lit(0), "g3": empty, "g2": empty, "h3": empty}
    return joined.select(S1, CAND, *[F.coalesce(F.col(n + k), v).alias(n + k) for k in "12" for n, v in none.items()], *extra)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def expressions(settings: Settings | None = None) -> dict[str, Column]:
    """Each feature over the columns that :func:`looked_up` gives."""
    n1, a1, c1, x1, y1, t1 = (F.col(f"{n}1") for n in "nacxyt")
    n2, a2, c2, x2, y2, t2 = (F.col(f"{n}2") for n in "nacxyt")
    g = F.col
    cut = (settings or Settings()).edit_max_len
    made = [
        _flag((n1 == n2) & (n1 != "")), sim.jaccard(n1, n2, x=x1, y=x2), sim.token_overlap(n1, n2, x1, x2), sim.token_overlap(n2, n1, x2, x1), sim.edit_similarity(n1, n2, cut), sim.partial_ratio(n1, n2),
        sim.token_sort_ratio(n1, n2), sim.ngram_overlap(n1, n2, 3, g("g31"), g("g32")), sim.ngram_overlap(n1, n2, 2, g("g21"), g("g22")), sim.length_difference(n1, n2), sim.token_count_difference(n1, n2, t1, t2),
        sim.jaccard(a1, a2, x=y1, y=y2), sim.token_overlap(a1, a2, y1, y2), sim.token_overlap(a2, a1, y2, y1), sim.edit_similarity(a1, a2, cut), sim.ngram_overlap(a1, a2, 3, g("h31"), g("h32")), sim.length_difference(a1, a2),
        _flag((c1 == c2) & (c1 != "")),
        _flag(n1 == ""), _flag(n2 == ""), _flag(a1 == ""), _flag(a2 == ""), _flag(c1 == ""), _flag(c2 == ""),
        _flag(F.col(CAND).startswith(PREFIXES["S2"])),
    ]
    return {n: F.coalesce(e.cast("double"), F.lit(0.0)) for n, e in zip(FEATURES, made, strict=True)}


def extract(pairs: DataFrame, s1: DataFrame, cands: DataFrame, settings: Settings | None = None, only: list[str] | None = None, truth: DataFrame | None = None) -> DataFrame:
    """Pair ids and features (all, or those named); with ``truth`` also ``label``."""
    made = expressions(settings)
    return looked_up(pairs, s1, cands, truth).select(S1, CAND, *[made[n].alias(n) for n in only or FEATURES], *(["label"] if truth is not None else []))


def tfidf_cosine(pairs: DataFrame, left: str, right: str, key: str, ngrams: tuple[int, int] = (1, 2), max_features: int = 10_000) -> DataFrame:
    """(key, cosine) of two text columns of the same row, by word n-gram TF-IDF fitted on both columns.

    Words are those of two or more word characters; of more than ``max_features``
    n-grams the most frequent are taken, ties by n-gram.  No n-gram: 0.
    """
    def grams(text: Column) -> Column:
        def of_length(words: Column, n: int) -> Column:
            parts = F.transform(words, lambda w, i: F.slice(words, i + 1, F.lit(n)))
            return F.transform(F.filter(parts, lambda g: F.size(g) == n), lambda g: F.array_join(g, " "))

        found = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))
        return F.get(F.transform(F.array(found), lambda words: F.concat(*(of_length(words, n) for n in range(ngrams[0], ngrams[1] + 1)))), F.lit(0))

    rows = pairs.select(F.col(key), F.lit("a").alias("side"), F.coalesce(left, F.lit("")).alias("text")).unionByName(pairs.select(F.col(key), F.lit("b").alias("side"), F.coalesce(right, F.lit("")).alias("text")))
    rows = rows.select(F.concat("side", F.col(key).cast("string")).alias("row"), grams(F.col("text")).alias("grams"))
    top = rows.select(F.explode("grams").alias("gram")).groupBy("gram").count().orderBy(F.desc("count"), "gram").limit(max_features).select("gram")
    listed = rows.select("row", F.explode("grams").alias("gram")).join(F.broadcast(top), "gram").groupBy("row").agg(F.collect_list("gram").alias("grams"))
    w = weights(listed, F.col("grams"), rows.count(), 1, "row", None)
    a = w.filter(F.col("row").startswith("a")).select(F.substr("row", F.lit(2)).alias("__k"), "gram", F.col("weight").alias("w1"))
    b = w.filter(F.col("row").startswith("b")).select(F.substr("row", F.lit(2)).alias("__k"), "gram", F.col("weight").alias("w2"))
    dot = a.join(b, ["__k", "gram"]).groupBy("__k").agg(F.sum(F.col("w1") * F.col("w2")).alias("dot"))
    return pairs.select(key).join(dot, F.col(key).cast("string") == F.col("__k"), "left").select(key, F.coalesce("dot", F.lit(0.0)).alias("cosine"))
