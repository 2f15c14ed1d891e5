"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where a session on one machine (tests) names no shared folder.
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; a cluster has to name one."""
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not named and (not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return (named or LOCAL_CHECKPOINTS).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else has; what is there goes when the application ends."""
    path = f"{shared_dir(spark)}/kithline/{name}-{uuid.uuid4().hex}"
    files, p = file_system(spark, path)
    files.deleteOnExit(p)
    return path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for df in tables:
        for folder in _folders(df):
            files, p = file_system(df.sparkSession, folder)
            files.delete(p, True)


def stored_bytes(table: DataFrame) -> int:
    """Bytes of the files of a table that :func:`stored` wrote."""
    total = 0
    for folder in _folders(table):
        files, p = file_system(table.sparkSession, folder)
        total += files.getContentSummary(p).getLength()
    return total
