"""Substring dedup by difference-cover anchors.

A window is ``WINDOW`` = 20 consecutive words of one text.  A word is removed if
a window that covers it also starts earlier: in a smaller doc_id, or earlier in
the same text.  All windows are judged on the input.

1. Texts are gathered into chunks of some MB that hold whole texts.
2. Anchors are the 8-word sequences at places that are 0, 1, 3 or 9 modulo 13.
   Differences of that cover reach every residue, so two equal windows share an
   anchor at the same shift below 13, which lies inside both: 12 + 8 = 20.  Each
   chunk sends each of its anchor hashes once to the hash's bucket; the answer
   has a flag for each that occurs elsewhere or twice in the chunk.
3. Extension: windows that contain a repeated anchor (all others are unique) are
   hashed as a whole, twice; each chunk sends each such pair of hashes once with the
   smallest doc_id that has it, and is told which of them start earlier elsewhere.
4. Words under windows that start earlier are removed.

A chunk sends a value once, however often it holds it, so a passage of a third
of all texts costs its bucket one value for each chunk.  Buckets grow with the
corpus, so that one is held by a task; what a chunk sends to a bucket is one row of
plain values, made without a step of its own, so that rows of few values are cheap.
An anchor hash that collides only costs a check.  A window is identified by 128 bits
of two independent hashes of its words: of 10**14 different windows two are taken
for one with a probability of 10**-11.

Defined results: a null text has no words; texts shorter than a window are kept
whole; a very long text is a chunk of its own, read whole; of repeated rows, and of
texts of one doc_id, one counts as the earlier; a null doc_id stands after all
others; an empty table gives an empty table; further columns, whatever their names,
are kept by :func:`removed_rows` and ignored by :func:`digests`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, frugal, give_back, slices, stored, text_column
from .spans import Words, rolling

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Text bytes of a chunk, about; a longer text is a chunk of its own.
CHUNK_BYTES = 3 << 20
#: Anchors a bucket holds on average, at most.
BUCKET_ANCHORS = 1 << 20
LAST = np.iinfo(np.int64).max
SENT = "bucket int, chunk long, body binary"
SENT_WINDOWS = SENT + ", ids binary"
TOLD = "chunk long, bucket int, flags binary"


def _as_chunks(doc_id: str, text: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        first = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for k, part in enumerate(slices(batches, text, CHUNK_BYTES)):
            ids = part.column(part.schema.get_field_index(doc_id)).fill_null(LAST).to_numpy(zero_copy_only=False)
            part = part.take(pa.array(np.argsort(ids, kind="stable")))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_batch(part)
            words = len(Words(*buffer_of(text_column(part, text))))
            yield pa.record_batch({"chunk": pa.array([first + k], pa.int64()), "words": pa.array([words], pa.int64()), "texts": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return run


class Chunk:
    """One chunk's rows, words and windows."""

    def __init__(self, body: bytes, doc_id: str, text: str, log_buckets: int):
        with pa.ipc.open_stream(body) as stream:
            self.rows = stream.read_next_batch()
        self.ids = self.rows.column(self.rows.schema.get_field_index(doc_id)).fill_null(LAST).to_numpy(zero_copy_only=False)
        self.words = Words(*buffer_of(text_column(self.rows, text)))
        self.hashes, self.log = self.words.hashes(), log_buckets
        n = len(self.words)
        self.doc = np.repeat(np.arange(len(self.ids)), self.words.counts)
        self.place = np.arange(n) - self.words.bounds[:-1][self.doc]
        self.left = self.words.counts[self.doc] - self.place  # words from here to the text's end

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys (bucket above 31 bits of hash), counts, and for each anchor its key's index and place."""
        n = max(0, len(self.words) - ANCHOR + 1)
        at = np.flatnonzero(np.isin(self.place[:n] % PERIOD, COVER) & (self.left[:n] >= ANCHOR) & (self.words.counts[self.doc[:n]] >= WINDOW))
        keys = rolling(self.hashes, ANCHOR)[at] >> np.uint64(33 - self.log)
        distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        return distinct, counts, inverse, at

    def candidates(self, told: np.ndarray) -> np.ndarray:
        """Starts of windows that contain an anchor that occurs more than once."""
        _, _, inverse, at = self.anchors()
        again = np.zeros(len(self.words) + WINDOW + 1, np.int64)
        again[at + 1] = told[inverse]
        upto = np.cumsum(again)
        starts = np.flatnonzero(self.left >= WINDOW)
        return starts[upto[starts + PERIOD] > upto[starts]]

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of candidate windows: both hashes; whether each repeats an earlier one here; the indices of the others, by bucket."""
        value, other = rolling(self.hashes, WINDOW)[starts], rolling(self.hashes, WINDOW, 0xC2B2AE3D27D4EB4F)[starts]
        order = np.lexsort((value, other))
        v, w = value[order], other[order]
        head = np.ones(len(order), bool)
        head[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        later = np.ones(len(starts), bool)
        later[order[head]] = False
        return value, other, later, order[head]  # in the order of the other hash, whose first bits are the bucket

    def bucket(self, other: np.ndarray) -> np.ndarray:
        return (other >> np.uint64(63 - self.log)) >> np.uint64(1)

    def removed(self, anchors: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Whether each word goes."""
        starts = self.candidates(anchors)
        _, _, later, ones = self.windows(starts)
        later[ones] = windows
        edge = np.zeros(len(self.words) + 1, np.int32)
        gone = starts[later]
        edge[gone] += 1
        edge[gone + WINDOW] -= 1
        return np.cumsum(edge[:-1]) > 0


def _told(column: pa.Array, k: int) -> np.ndarray:
    """A chunk's flags, in the order of its buckets, in which they come."""
    got = column[k].values
    return np.frombuffer(b"".join(got.field("flags").to_pylist()) if got is not None else b"", np.uint8).astype(bool)


def _pieces(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive pieces of an array as binaries."""
    at = np.concatenate([[0], ends]).astype(np.int64) * (values.nbytes // max(1, len(values)))
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _rows_of(buckets: np.ndarray, chunk: int, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each of the ascending buckets, with its part of every column (of rows of values)."""
    heads = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else np.zeros(0, int)
    ends = np.r_[heads[1:], len(buckets)] if len(heads) else heads
    bodies = [_pieces(c, ends) for c in columns]
    return pa.record_batch([pa.array(buckets[heads].astype(np.int32)), pa.array(np.full(len(heads), chunk, np.int64)), *bodies], ["bucket", "chunk", "body", "ids"][: 2 + len(bodies)])


def _send_anchors(names: tuple[str, str], log: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for k in range(batch.num_rows):
                distinct, counts, _, _ = Chunk(batch.column(1)[k].as_py(), *names, log).anchors()
                marked = (distinct << np.uint64(1)).astype(np.uint32) | (counts > 1)
                yield _rows_of(distinct >> np.uint64(31), batch.column(0)[k].as_py(), marked.astype(np.uint32))
        give_back()

    return run


def _send_windows(names: tuple[str, str], log: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk(batch.column(1)[k].as_py(), *names, log)
                starts = chunk.candidates(_told(batch.column(2), k))
                value, other, _, ones = chunk.windows(starts)
                both = np.stack([value[ones], other[ones]], axis=1)
                yield _rows_of(chunk.bucket(other[ones]), batch.column(0)[k].as_py(), both, chunk.ids[chunk.doc[starts[ones]]].astype(np.int64))
        give_back()

    return run


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[list[bytes]]]]:
    """Each bucket's chunks and bodies; rows come sorted by bucket."""
    now, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now and rows:
                yield now, *_turned(rows)
                rows = []
            now = bucket
            rows.append(row)
    if rows:
        yield now, *_turned(rows)


def _turned(rows: list) -> tuple[list[int], list[list[bytes]]]:
    chunks, *bodies = map(list, zip(*rows, strict=True))
    return chunks, bodies


def _tell(bucket: int, chunks: list[int], sizes: list[int], flags: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array(np.full(len(chunks), bucket, np.int32)), "flags": _pieces(flags.astype(np.uint8), np.cumsum(sizes))})


def _repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, chunks, (bodies,) in _by_bucket(batches):
        marked = np.frombuffer(b"".join(bodies), np.uint32)
        low, again = marked >> np.uint32(1), (marked & np.uint32(1)).astype(bool)
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        again[order[1:]] |= same
        again[order[:-1]] |= same
        yield _tell(bucket, chunks, [len(b) // 4 for b in bodies], again)


def _not_first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, chunks, (bodies, owners) in _by_bucket(batches):
        both, ids = np.frombuffer(b"".join(bodies), np.uint64).reshape(-1, 2), np.frombuffer(b"".join(owners), np.int64)
        sizes = [len(x) // 8 for x in owners]
        order = np.lexsort((np.repeat(chunks, sizes), ids, both[:, 0], both[:, 1]))
        later = np.zeros(len(ids), bool)
        later[order[1:]] = (both[order][1:] == both[order][:-1]).all(axis=1)
        yield _tell(bucket, chunks, sizes, later)


def _answered(sent: DataFrame, answer: Callable, name: str) -> DataFrame:
    """One row for each chunk with what its buckets answer."""
    told = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, TOLD)
    return stored(told.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "flags"))).alias(name)), name)


def _prepared(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """Chunks with both answers, and the logarithm of the number of buckets."""
    spark = docs.sparkSession
    chunks = stored(docs.mapInArrow(_as_chunks(doc_id, text), "chunk long, words long, texts binary"), "chunks", "none")
    words = chunks.agg(F.sum("words")).first()[0] or 0
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words * len(COVER) // PERIOD // BUCKET_ANCHORS)
    log = min(31, max(0, (wanted - 1).bit_length()))
    bodies = chunks.select("chunk", "texts")
    anchors = _answered(bodies.mapInArrow(_send_anchors((doc_id, text), log), SENT), _repeated, "anchors")
    with_anchors = bodies.join(anchors, "chunk", "left").select("chunk", "texts", "anchors")
    windows = _answered(with_anchors.mapInArrow(_send_windows((doc_id, text), log), SENT_WINDOWS), _not_first, "windows")
    return bodies.join(anchors, "chunk", "left").join(windows, "chunk", "left").select("chunk", "texts", "anchors", "windows"), log


def _judged(batches: Iterable[pa.RecordBatch], doc_id: str, text: str, log: int) -> Iterator[tuple[Chunk, np.ndarray]]:
    frugal()
    for batch in batches:
        for k in range(batch.num_rows):
            chunk = Chunk(batch.column(1)[k].as_py(), doc_id, text, log)
            yield chunk, chunk.removed(_told(batch.column(2), k), _told(batch.column(3), k))
    give_back()


def _kept_texts(chunk: Chunk, gone: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Removed words of each text, and its other words joined by one space."""
    w = chunk.words
    lost = np.add.reduceat(np.r_[gone, False].astype(np.int64), w.bounds[:-1]) * (w.counts > 0) if len(w.counts) else np.zeros(0, np.int64)
    data, starts, ends = w.spaced()
    out = []
    for d in range(len(w.counts)):
        a, z = w.bounds[d], w.bounds[d + 1]
        if a == z:
            out.append(b"")
        elif not lost[d]:
            out.append(data[starts[a] : ends[z - 1]])
        else:
            keep = ~gone[a:z]
            first = np.flatnonzero(keep & ~np.r_[False, keep[:-1]]) + a
            last = np.flatnonzero(keep & ~np.r_[keep[1:], False]) + a
            out.append(b" ".join(data[i:j] for i, j in zip(starts[first].tolist(), ends[last].tolist(), strict=True)))
    return lost, out


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chunks, log = _prepared(given, "doc_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, gone in _judged(batches, "doc_id", "text", log):
            lost, kept = _kept_texts(chunk, gone)
            yield pa.record_batch({"doc_id": chunk.rows.column(0), "n_words": pa.array(chunk.words.counts.astype(np.int64)), "n_removed": pa.array(lost), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string())})

    return chunks.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def removed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated words removed from the texts.

    A text that loses words becomes its other words joined by one space, and
    ``length`` its number of characters; a text that loses all is dropped; all
    others stay byte for byte.
    """
    chunks, log = _prepared(docs, doc_id, text)
    resized = length in docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, gone in _judged(batches, doc_id, text, log):
            lost, kept = _kept_texts(chunk, gone)
            changed = pa.array(lost > 0)
            rows, names = {n: chunk.rows.column(i) for i, n in enumerate(chunk.rows.schema.names)}, chunk.rows.schema.names
            new = pa.array([t.decode() if c else None for t, c in zip(kept, (lost > 0).tolist(), strict=True)], pa.string())
            rows[text] = pa.compute.if_else(changed, new.cast(rows[text].type), rows[text])
            if resized:
                sizes = pa.compute.utf8_length(new).cast(rows[length].type)
                rows[length] = pa.compute.if_else(changed, sizes, rows[length])
            stay = pa.array((lost == 0) | (lost < chunk.words.counts))
            yield pa.record_batch([rows[n] for n in names], names).filter(stay)

    return chunks.mapInArrow(run, docs.schema)
