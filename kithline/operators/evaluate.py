"""Entity-level evaluation and candidate recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schema import CAND, S1
from .candidates import as_lists
from .labels import truth_pairs
from .thresholds import f05


def id_set(column: str) -> Column:
    """The distinct ids of a comma list that is stripped as a whole; none of a blank one."""
    text = strip(F.coalesce(column, F.lit("")))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(text, ",")))


def precision(pred: Column, true: Column) -> Column:
    both = F.size(F.array_intersect(pred, true))
    return F.when((F.size(pred) == 0) & (F.size(true) == 0), 1.0).when((F.size(pred) == 0) | (F.size(true) == 0), 0.0).otherwise(both / F.size(pred))


def recall(pred: Column, true: Column) -> Column:
    both = F.size(F.array_intersect(pred, true))
    return F.when(F.size(true) == 0, 1.0).when(F.size(pred) == 0, 0.0).otherwise(both / F.size(true))


def entity_f05(pred: Column, true: Column) -> Column:
    return F.when((F.size(pred) == 0) & (F.size(true) == 0), 1.0).otherwise(f05(precision(pred, true), recall(pred, true)))


def entity_scores(results: DataFrame, truth: DataFrame) -> DataFrame:
    """Precision, recall and F0.5 of every S1 id of either side, with both sets and whether the truth has it."""
    pred = results.select(S1, id_set("matched_entity_ids").alias("pred"))
    true = truth.select(S1, id_set("matched_entity_ids").alias("true"), F.lit(True).alias("in_truth"))
    none = F.array().cast("array<string>")
    both = pred.join(true, S1, "full_outer").select(S1, F.coalesce("pred", none).alias("pred"), F.coalesce("true", none).alias("true"), F.coalesce("in_truth", F.lit(False)).alias("in_truth"))
    p, t = F.col("pred"), F.col("true")
    return both.withColumns({"precision": precision(p, t), "recall": recall(p, t), "f0_5": entity_f05(p, t)})


def _macro(scores: DataFrame) -> list[Column]:
    single = F.size("true") == 0
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return [mean("f0_5").alias("macro_f0_5"), mean("precision").alias("macro_precision"), mean("recall").alias("macro_recall"), F.count("*").alias("n_entities"), F.count_if(single).alias("n_singletons_total"), F.count_if(single & (F.size("pred") == 0)).alias("n_singletons_correct"), F.count_if(~single).alias("n_with_matches_total")]


def macro_f05(results: DataFrame, truth: DataFrame) -> DataFrame:
    """One row of means over the union of ids."""
    scores = entity_scores(results, truth)
    return scores.agg(*_macro(scores))


def candidate_recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: listed truth ids (a repeated one counts again), how many are candidates (pairs, or lists), and their share."""
    listed = truth_pairs(truth).groupBy(S1).agg(F.collect_list(CAND).alias("true")).join(as_lists(pairs), S1, "left")
    covered = F.size(F.filter("true", lambda c: F.array_contains(F.coalesce("ids", F.array().cast("array<string>")), c)))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    counted = listed.agg(zero(F.size("true")).alias("n_true"), zero(covered).alias("n_covered"))
    return counted.withColumn("candidate_recall", F.when(F.col("n_true") > 0, F.col("n_covered") / F.col("n_true")).otherwise(0.0))


def full_report(results: DataFrame, truth: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One row: macro figures, totals of matches, spread of F0.5 over truth ids, and candidate recall if pairs are given."""
    scores = entity_scores(results, truth)
    of_truth = F.when(F.col("in_truth"), F.col("f0_5"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    extra = [F.coalesce(F.sum(F.size("pred")), F.lit(0)).cast("long").alias("total_predicted"), F.coalesce(F.sum(F.size("true")), F.lit(0)).cast("long").alias("total_true"), zero(F.stddev_pop(of_truth)).alias("f0_5_std"), zero(F.min(of_truth)).alias("f0_5_min"), zero(F.max(of_truth)).alias("f0_5_max")]
    report = scores.agg(*_macro(scores), *extra)
    return report if pairs is None else report.join(candidate_recall(pairs, truth).select("candidate_recall"))


def print_report(report: DataFrame) -> None:
    row = report.first().asDict()
    print("\n".join(["evaluation", *(f"  {k:24} {v:.6f}" if isinstance(v, float) else f"  {k:24} {v}" for k, v in row.items())]))
