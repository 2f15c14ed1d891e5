"""Helpers shared by the operators: the shared folder, materialised tables and Arrow batch slicing."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..tables import forget as forget
from ..tables import new_path as new_path
from ..tables import shared_dir as shared_dir
from ..tables import stored as stored
from ..tables import stored_bytes as stored_bytes

#: Text bytes that one vectorised step handles at most; a longer single text is one step.
STEP_BYTES = 8 << 20


def count_partitions(spark: SparkSession, wanted: int = 1) -> int:
    """Shuffle partitions: the session's number, or ``wanted`` where the data need more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with as many more underscores as it takes to be none of ``taken``."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The named string column with nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), "")


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a null-free array and the offsets of each (one more than texts)."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], name: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of the named text column, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def frugal() -> None:
    """Let a worker's C library map arrays of over 256 KB on their own, so that freed ones return to the system at once."""
    tune = getattr(ctypes.CDLL(None), "mallopt", None)
    if tune is not None:
        tune(-3, 1 << 18)  # M_MMAP_THRESHOLD


def give_back() -> None:
    """Return a worker's freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
