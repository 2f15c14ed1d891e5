"""Ground truth as pairs, labels, and the split by S1 entity."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schema import CAND, S1


def truth_pairs(truth: DataFrame) -> DataFrame:
    """One row for each listed id, stripped, blanks skipped, repeats kept."""
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), strip), lambda x: x != "")
    return truth.select(S1, F.explode(ids).alias(CAND))


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with ``label`` 1 where the truth has them, else 0."""
    known = truth_pairs(truth).distinct().withColumn("hit", F.lit(1))
    return pairs.join(known, [S1, CAND], "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


class Split(NamedTuple):
    s1_train: DataFrame
    s1_val: DataFrame
    truth_train: DataFrame
    truth_val: DataFrame
    train_ids: DataFrame
    val_ids: DataFrame


def split_members(s1: DataFrame, truth: DataFrame, fraction: float = 0.15, seed: int = 42, stratify: bool = True) -> DataFrame:
    """entity_id, stratum and in_val: of each stratum exactly max(1, floor(n * fraction)) by the order of md5(seed, id).

    The hashes' first four digits are counted; whole digits below the border are
    taken, and only rows of the border's own digits are ranked, so that no task
    sorts a stratum.
    """
    known = truth.select(F.col(S1).alias("entity_id"), (strip(F.coalesce("matched_entity_ids", F.lit(""))) != "").alias("matched")).groupBy("entity_id").agg(F.max("matched").alias("matched"))
    stratum = F.when(F.coalesce("matched", F.lit(False)), F.lit("matched")).otherwise(F.lit("singleton")) if stratify else F.lit("all")
    rows = s1.select("entity_id").join(known, "entity_id", "left").select("entity_id", stratum.alias("stratum"), F.md5(F.concat(F.lit(str(seed)), "entity_id")).alias("hash"))
    rows = rows.withColumn("digits", F.substring("hash", 1, 4))
    counts = rows.groupBy("stratum", "digits").agg(F.count("*").alias("n"))  # at most 65,536 for each of two strata
    whole = Window.partitionBy("stratum")
    upto = F.sum("n").over(whole.orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    wanted = F.greatest(F.lit(1), F.floor(F.sum("n").over(whole) * F.lit(fraction))).cast("long")
    border = counts.select("stratum", "digits", (wanted - upto).alias("open"), "n")
    placed = rows.join(F.broadcast(border), ["stratum", "digits"])
    at_border = (F.col("open") > 0) & (F.col("open") < F.col("n"))
    rank = F.row_number().over(Window.partitionBy("stratum", "digits").orderBy("hash", "entity_id"))
    ranked = placed.filter(at_border).withColumn("in_val", rank <= F.col("open"))
    sure = placed.filter(~at_border).withColumn("in_val", F.col("open") > 0)
    return ranked.unionByName(sure).select("entity_id", "stratum", "in_val")


def create_split(s1: DataFrame, truth: DataFrame, fraction: float = 0.15, seed: int = 42, stratify: bool = True) -> Split:
    members = split_members(s1, truth, fraction, seed, stratify)
    val, train = members.filter("in_val").select("entity_id"), members.filter("NOT in_val").select("entity_id")
    own = lambda ids: ids.withColumnRenamed("entity_id", S1)
    return Split(s1.join(train, "entity_id", "left_semi"), s1.join(val, "entity_id", "left_semi"), truth.join(own(train), S1, "left_semi"), truth.join(own(val), S1, "left_semi"), train, val)
