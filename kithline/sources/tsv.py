"""Tab-separated sources with validation, ground truth, and sinks."""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schema import PREFIXES, S1, SOURCE_COLUMNS, TRUTH_COLUMNS

log = logging.getLogger("kithline")

# Cells that a reader of the matched system takes as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def find_file(spark: SparkSession, local: str, fallback: str) -> str:
    """``local`` if it is there, else ``fallback`` if that is, else ``local``."""
    return local if exists(spark, local) or not exists(spark, fallback) else fallback


def or_missing(col: Column) -> Column:
    return F.when(~col.isin(*MISSING), col)


def read_tsv(spark: SparkSession, path: str, columns: list[str], label: str = "table", multi_line: bool = True) -> DataFrame:
    """The named columns, all strings, with missing cells as nulls.

    Header names are trimmed, their order is free, other columns are dropped.
    ``multi_line`` allows line breaks in quoted cells, but one task reads a file.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"{label}: no file at {path}")
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "mode": "FAILFAST", "inferSchema": False}
    raw = spark.read.options(**options).csv(path)
    named = raw.toDF(*[c.strip().lstrip("﻿") for c in raw.columns])
    lacking = [c for c in columns if c not in named.columns]
    if lacking:
        raise ValueError(f"{label}: columns missing: {lacking}")
    return named.select(*[or_missing(F.col(c)).alias(c) for c in columns])


def id_report(df: DataFrame, prefix: str, column: str = "entity_id") -> DataFrame:
    """One row: rows, ids that are null or lack the prefix, and distinct ids that occur more than once."""
    ids = df.groupBy(column).count()
    bad = F.when(~F.coalesce(F.col(column).startswith(prefix), F.lit(False)), F.col("count")).otherwise(0)
    again = F.count_if(F.col(column).isNotNull() & (F.col("count") > 1))
    return ids.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("n_rows"), F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("n_bad_prefix"), again.cast("long").alias("n_duplicate_ids"))


def validate_ids(df: DataFrame, prefix: str, label: str, column: str = "entity_id") -> None:
    """Raise ``ValueError`` for ids without the prefix, then for duplicates."""
    found = id_report(df, prefix, column).first()
    if found["n_bad_prefix"]:
        some = [r[0] for r in df.filter(~F.coalesce(F.col(column).startswith(prefix), F.lit(False))).select(column).limit(5).collect()]
        raise ValueError(f"{label}: {found['n_bad_prefix']} ids lack the prefix {prefix}: {some}")
    if found["n_duplicate_ids"]:
        some = [r[0] for r in df.groupBy(column).count().filter("count > 1").select(column).limit(5).collect()]
        raise ValueError(f"{label}: {found['n_duplicate_ids']} duplicate ids: {some}")


def missing_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in df.columns])


def load_source(spark: SparkSession, path: str, name: str, multi_line: bool = True) -> DataFrame:
    """Source ``S1``, ``S2`` or ``S3`` with valid ids."""
    df = read_tsv(spark, path, SOURCE_COLUMNS, name, multi_line)
    validate_ids(df, PREFIXES[name], name)
    log.info("%s missing values: %s", name, missing_counts(df).first().asDict())
    return df


def load_ground_truth(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    df = read_tsv(spark, path, TRUTH_COLUMNS, "ground truth", multi_line)
    validate_ids(df, PREFIXES["S1"], "ground truth", S1)
    log.info("singletons: %d", df.filter(strip(F.coalesce("matched_entity_ids", F.lit(""))) == "").count())
    return df


def load_test_data(spark: SparkSession, s1: str, s2: str, s3: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    return load_source(spark, s1, "S1", multi_line), load_source(spark, s2, "S2", multi_line), load_source(spark, s3, "S3", multi_line)


def load_train_data(spark: SparkSession, s1: str, s2: str, s3: str, truth: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return *load_test_data(spark, s1, s2, s3, multi_line), load_ground_truth(spark, truth, multi_line)


def write_tsv(df: DataFrame, path: str, columns: list[str], single: bool = True) -> None:
    """Columns as TSV with a header and nulls as empty cells.

    ``single`` moves one part file to ``path``; without it ``path`` is a folder of
    parts that all tasks write, which is the form for large results.
    """
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    spark, rows = df.sparkSession, df.select(*columns).fillna("")
    options = {"sep": "\t", "header": True, "emptyValue": "", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if not single:
        rows.write.mode("overwrite").options(**options).csv(path)
        return
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    rows.coalesce(1).write.options(**options).csv(staged)
    fs, folder = _file_system(spark, staged)
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(folder, True)


def write_matching_results(results: DataFrame, path: str, single: bool = True) -> None:
    write_tsv(results, path, [S1, "matched_entity_ids"], single)


def write_candidate_pairs(candidates: DataFrame, path: str, single: bool = True) -> None:
    write_tsv(candidates, path, [S1, "candidate_entity_ids"], single)


def save_threshold(spark: SparkSession, threshold: float, path: str) -> None:
    fs, p = _file_system(spark, path)
    out = fs.create(p, True)
    out.write(json.dumps({"threshold": threshold}).encode())
    out.close()


def load_threshold(spark: SparkSession, path: str, default: float = 0.5) -> float:
    if not exists(spark, path):
        return default
    return float(json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))["threshold"])
