"""Pair-level metrics, threshold search and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import Settings

METRICS = ["tp", "fp", "fn", "tn", "precision", "recall", "f1", "f0_5"]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def f05(p: Column, r: Column) -> Column:
    return _ratio(1.25 * p * r, 0.25 * p + r)


def with_rates(counts: DataFrame) -> DataFrame:
    """tp, fp, fn, tn with precision, recall, f1 and f0_5; 0 where a denominator is."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rated = counts.withColumns({"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)})
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumns({"f1": _ratio(2.0 * p * r, p + r), "f0_5": f05(p, r)})


def pair_metrics(scored: DataFrame, label: str = "label", predicted: str = "is_match") -> DataFrame:
    """One row of metrics."""
    y, z = F.col(label) == 1, F.col(predicted) == 1
    return with_rates(scored.agg(*[F.count_if(c).alias(n) for n, c in (("tp", y & z), ("fp", ~y & z), ("fn", y & ~z), ("tn", ~y & ~z))]))


def grid(settings: Settings) -> list[float]:
    low, high, n = settings.threshold_min, settings.threshold_max, settings.threshold_steps
    return [high if n > 1 and i == n - 1 else low + i * ((high - low) / max(1, n - 1)) for i in range(n)]


def sweep(scored: DataFrame, settings: Settings | None = None, label: str = "label", probability: str = "probability") -> DataFrame:
    """Metrics at each threshold of the grid.

    Every row is counted once, at the number of thresholds that it reaches; sums
    from the top over those few counts give each threshold's figures.
    """
    steps = grid(settings or Settings())
    p = F.coalesce(F.col(probability), F.lit(-1.0))
    reached = F.size(F.filter(F.array(*map(F.lit, steps)), lambda t: p >= t))
    counts = scored.groupBy(reached.alias("k")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    spark = scored.sparkSession
    all_k = spark.range(len(steps) + 1).select(F.col("id").cast("int").alias("k"))
    full = all_k.join(counts, "k", "left").fillna(0, ["pos", "neg"])
    down = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    sums = full.select("k", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"))
    counted = sums.filter("k > 0").select(F.element_at(F.array(*map(F.lit, steps)), F.col("k")).alias("threshold"), "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"), (F.col("n") - F.col("fp")).alias("tn"))
    return with_rates(counted)


def tune(scored: DataFrame, settings: Settings | None = None, label: str = "label") -> tuple[float, dict]:
    """The best threshold, the lowest of equals, and its metrics."""
    settings = settings or Settings()
    if settings.metric not in METRICS:
        raise ValueError(f"unknown metric {settings.metric}")
    best = sweep(scored, settings, label).orderBy(F.desc(settings.metric), "threshold").first().asDict()
    return best.pop("threshold"), best


def apply_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn("is_match", F.when(F.col("probability") >= threshold, 1).otherwise(0).cast("int"))


def positive_pairs(scored: DataFrame) -> DataFrame:
    return scored.filter("is_match = 1")
