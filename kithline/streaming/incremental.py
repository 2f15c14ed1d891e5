"""Streams of new S2 and S3 records against a fixed master table.

Each micro-batch is linked like a batch pool and its matches are written once,
under the batch's number, so that a batch that is repeated after a failure
replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import preprocess
from ..operators import candidates as cand
from ..operators.thresholds import positive_pairs
from ..plans.linker import Linker
from ..schema import PREFIXES


def link_stream(linker: Linker, s1: DataFrame, arriving: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a query that writes matches (pair, probability) to ``out``/batch=<n>."""
    master = preprocess(s1).persist()

    def link(batch: DataFrame, number: int) -> None:
        pool = preprocess(batch).persist()
        parts = [pool.filter(F.col("entity_id").startswith(PREFIXES[k])) for k in ("S2", "S3")]
        pairs = cand.generate(master, *parts, linker.settings.strategies, linker.settings)
        positive_pairs(linker.score(pairs, master, pool)).write.mode("overwrite").parquet(f"{out}/batch={number}")
        linker.release()
        pool.unpersist()

    return arriving.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
