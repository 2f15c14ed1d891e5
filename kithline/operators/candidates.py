"""From pairs to tagged, capped and grouped candidates."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CAND, CANDIDATE_SCHEMA, PREFIXES, S1, Settings
from .blocking import run_strategies, smallest_lists

#: Ids of lists that are turned around in one step, and of a bucket of candidates, about.
TURNED, BUCKET = 1 << 21, 1 << 20


def cap(pairs: DataFrame, limit: int | None) -> DataFrame:
    """At most ``limit`` candidates for each S1 record, the smallest ids first; ``None``: all."""
    if limit is None:
        return pairs
    rank = F.row_number().over(Window.partitionBy(S1).orderBy(CAND))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= limit).drop("rank")


def generate(s1: DataFrame, s2: DataFrame, s3: DataFrame, strategies: Sequence[str] | None = None, settings: Settings | None = None) -> DataFrame:
    """source1_entity_id, candidate_entity_id and candidate_source of all strategies' pairs."""
    settings = settings or Settings()
    names = settings.strategies if strategies is None else strategies
    if settings.max_candidates is None:
        pairs = run_strategies(s1, s2.unionByName(s3), names, settings)
        pairs = None if pairs is None else pairs.filter(~F.col(CAND).startswith(PREFIXES["S1"]))
    else:
        pairs = as_pairs(generate_lists(s1, s2, s3, strategies, settings))
    if pairs is None:
        return s1.sparkSession.createDataFrame([], CANDIDATE_SCHEMA)
    source = F.when(F.col(CAND).startswith(PREFIXES["S2"]), F.lit("S2")).otherwise(F.lit("S3"))
    return pairs.select(S1, CAND, source.alias("candidate_source"))


def generate_lists(s1: DataFrame, s2: DataFrame, s3: DataFrame, strategies: Sequence[str] | None = None, settings: Settings | None = None) -> DataFrame:
    """The pairs of :func:`generate` as lists (source1_entity_id, ids): a row for each S1 record that has any, its ids in order."""
    settings = settings or Settings()
    names, limit = settings.strategies if strategies is None else strategies, settings.max_candidates
    if limit is None:
        return as_lists(generate(s1, s2, s3, strategies, settings))
    lists = smallest_lists(s1, s2.unionByName(s3), names, settings, limit, PREFIXES["S1"])
    return s1.sparkSession.createDataFrame([], f"{S1} string, ids array<string>") if lists is None else lists


def as_lists(pairs: DataFrame) -> DataFrame:
    """Pairs, or lists already, as lists (source1_entity_id, ids) of distinct candidates in order."""
    if CAND not in pairs.columns:
        return pairs.select(S1, "ids")
    return pairs.groupBy(S1).agg(F.array_sort(F.collect_set(CAND)).alias("ids"))


def as_pairs(lists: DataFrame) -> DataFrame:
    """Lists, or pairs already, as pairs."""
    return lists.select(S1, CAND) if CAND in lists.columns else lists.select(S1, F.explode("ids").alias(CAND))


def grouped(pairs: DataFrame, key: str = S1, value: str = CAND, out: str = "candidate_entity_ids") -> DataFrame:
    """Each key's distinct values, sorted, as one comma list; lists of candidates are joined as they are."""
    if value == CAND and CAND not in pairs.columns:
        return pairs.filter(F.size("ids") > 0).select(key, F.concat_ws(",", "ids").alias(out))
    return pairs.groupBy(key).agg(F.concat_ws(",", F.array_sort(F.collect_set(value))).alias(out))


def with_all_ids(groups: DataFrame, ids: DataFrame, column: str = "candidate_entity_ids") -> DataFrame:
    """A row for every id (column ``source1_entity_id``), with an empty list where there is none."""
    return ids.select(S1).distinct().join(groups, S1, "left").select(S1, F.coalesce(column, F.lit("")).alias(column))


def s1_ids(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias(S1))


def pairs_to_grouped(pairs: DataFrame, key: str = S1, value: str = CAND, all_ids: DataFrame | None = None) -> DataFrame:
    out = f"{value}s"
    groups = grouped(pairs, key, value, out).withColumnRenamed(key, S1)
    return with_all_ids(groups, all_ids, out) if all_ids is not None else groups.withColumnRenamed(S1, key)


def _packed(named: pa.Array, counts: np.ndarray, own: pa.Array, places: np.ndarray) -> tuple[int, bytes]:
    """Size and bytes of candidates, how many S1 ids each has, the S1 ids and their places in turn, as steps from one to the next."""
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    steps = pa.array(np.diff(places, prepend=0).astype(np.int32))
    row = pa.RecordBatch.from_arrays([one(named), one(pa.array(counts.astype(np.int32))), one(own), one(steps)], names=["named", "counts", "own", "steps"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema) as stream:
        stream.write_batch(row)
    data = sink.getvalue()
    return data.size, pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(size: int, data: bytes) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    row = pa.ipc.open_stream(pa.decompress(data, size, codec="zstd")).read_next_batch()
    named, counts, own, steps = (row.column(k).flatten() for k in range(4))
    return named, counts.to_numpy(), own, np.cumsum(steps.to_numpy(), dtype=np.int64)


def _dealt(buckets: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists of S1 records, turned around a step at a time; a row for each step and bucket of candidates.  Rows without a list are candidates alone."""

    def step(own: pa.Array, lists: pa.Array, known: bool) -> pa.RecordBatch:
        named = lists.flatten().dictionary_encode()
        names = named.dictionary
        of_name = np.array([zlib.crc32(x.encode()) % buckets for x in names.to_pylist()], np.int64)
        code, row = named.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        if not known:  # of S1 records in order
            order = pc.array_sort_indices(own)
            place = np.empty(len(own), np.int64)
            place[order.to_numpy()] = np.arange(len(own))
            own, row = own.take(order), place[row]
        order = np.lexsort((row, code, of_name[code]))
        code, row = code[order], row[order]
        bucket = of_name[code]
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        made = []
        for low, high in zip(begin.tolist(), np.append(begin, len(bucket))[1:].tolist(), strict=True):
            first = np.flatnonzero(np.diff(code[low:high], prepend=-1))
            here = names.take(pa.array(code[low:high][first]))
            if known:
                made.append(_packed(here, np.zeros(len(here)), pa.array([], pa.string()), np.zeros(0, np.int64)))
            else:
                used, places = np.unique(row[low:high], return_inverse=True)
                made.append(_packed(here, np.diff(first, append=high - low), own.take(pa.array(used)), places))
        return pa.RecordBatch.from_arrays([pa.array(bucket[begin], pa.int32()), pa.array([known] * len(made), pa.bool_()), pa.array([n for n, _ in made], pa.int32()), pa.array([x for _, x in made], pa.binary())], names=["bucket", "known", "size", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lists = batch.column(0), batch.column(1)
            steps = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)) // most
            ends = [*(np.flatnonzero(np.diff(steps)) + 1).tolist(), batch.num_rows]
            for low, high in zip([0, *ends[:-1]], ends, strict=True):
                part = slice(low, high)
                empty = own[part].null_count == high - low
                yield step(own[part], lists[part], empty)

    return run


def _joined(bucket: pa.Table) -> pa.Table:
    """Each known candidate of a bucket with its S1 ids, sorted, as a comma list."""
    parts = [(known, *_unpacked(size, data)) for known, size, data in zip(*(bucket.column(c).to_pylist() for c in ("known", "size", "data")), strict=True)]
    text = lambda arrays: pa.concat_arrays([pa.array([], pa.string()), *arrays])
    known = pc.unique(text(p[1] for p in parts if p[0]))
    own = text(p[3] for p in parts)
    ids = pc.unique(own)
    ids = ids.take(pc.array_sort_indices(ids))
    rank = pc.index_in(own, ids).to_numpy().astype(np.int64)
    found, at = [np.zeros(0, np.int64)], 0
    for _, named, counts, mine, places in parts:
        code = np.repeat(pc.index_in(named, known).fill_null(-1).to_numpy().astype(np.int64), counts)
        found.append((code * len(ids) + rank[at : at + len(mine)][places])[code >= 0])
        at += len(mine)
    code, row = np.divmod(np.unique(np.concatenate(found)), max(1, len(ids)))
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(code, np.arange(len(known) + 1)), pa.int32()), ids.take(pa.array(row)))
    return pa.table({CAND: known, "ids": pc.binary_join(lists, ",")})


def by_candidate(lists: DataFrame, all_ids: DataFrame, out: str = f"{S1}s") -> DataFrame:
    """Lists (source1_entity_id, ids) turned around: for every id of ``all_ids`` (column ``candidate_entity_id``) the S1 records that name it, sorted, as a comma list.

    Tasks turn the lists that they read; a bucket of candidates gets from each step of
    ``TURNED`` ids one packed row, so that no pair and no comma list is shuffled.
    """
    n = lists.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    buckets = max(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // BUCKET)
    schema = "bucket int, known boolean, size int, data binary"
    turned = lists.filter(F.col(S1).isNotNull()).select(S1, "ids").mapInArrow(_dealt(buckets, TURNED), schema)
    every = all_ids.filter(F.col(CAND).isNotNull()).select(F.lit(None).cast("string").alias(S1), F.array(CAND).alias("ids")).mapInArrow(_dealt(buckets, TURNED), schema)
    return turned.unionByName(every).groupBy("bucket").applyInArrow(_joined, f"{CAND} string, ids string").withColumnRenamed("ids", out)
