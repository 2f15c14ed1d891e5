"""Token ids in files of canonical, length-limited Huffman codes.

The ids of a corpus are counted over all documents; package-merge gives code
lengths of at most ``MAX_BITS``; canonical codes follow from the lengths alone,
so the code book that is stored beside the files is one small array.

A file holds independent blocks of about ``BLOCK_IDS`` ids and whole documents:
doc_ids, lengths, the packed codes, and the bit offset of every ``STRIDE``-th id.
A block is decoded by one look-up table of ``MAX_BITS`` bits, for all its
checkpoints at once, and any document can be read from the checkpoint before it.
Files are Parquet files with a block a row, because Spark commits those once
even if executors are lost; they stand in ascending doc_id order.

Shards are as many as the stored tokens need at ``SHARD_BYTES`` each; rows of one
doc_id are spread over as many shards as they take.

Defined results: a null text has only the end id; a very long text is a block of its
own, encoded whole; repeated rows are written each; rows of equal doc_ids stand one
after the other, in the order in which the table is read; a null doc_id stands
first; ids of equal counts get codes by their value; an empty table gives no file
rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, count_partitions, forget, slices, stored, stored_bytes, text_column
from .tokens import encoder, with_end

MAX_BITS = 20
BLOCK_IDS = 1 << 20
STRIDE = 256
#: Bytes of stored tokens that a shard holds, about.
SHARD_BYTES = 128 << 20
FILE = "shard int, block int, before long, n_ids long, doc_ids binary, lengths binary, checkpoints binary, codes binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, 0 for ids without a count; by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError("more ids than codes of that length")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64) if counts.max() > 1 << 40 else counts[used].astype(np.int64)
    level, leaf_marks = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        leaf_marks.append(order < n)
        level = both[order]
    depth, take = np.zeros(n, np.int64), 2 * n - 2
    for marks in reversed(leaf_marks):
        leaves = int(marks[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    out[used] = depth
    return out


class Book:
    """Canonical codes of an array of code lengths: shorter codes first, then smaller ids."""

    def __init__(self, lengths: np.ndarray, limit: int = MAX_BITS):
        self.lengths, self.limit = lengths.astype(np.int64), limit
        used = np.flatnonzero(lengths)
        order = used[np.argsort(self.lengths[used], kind="stable")]
        own = self.lengths[order]
        width = np.int64(1) << (limit - own)  # table entries a code fills
        first = np.cumsum(width) - width
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = first >> (limit - own)
        self.ids = np.repeat(order, width).astype(np.uint32)
        self.bits = np.repeat(own, width).astype(np.uint8)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Packed codes, most significant bit first, and each stride's bit offset."""
        size = self.lengths[ids]
        end = np.cumsum(size)
        begin = end - size
        word = begin >> 5
        shifted = self.codes[ids] << (64 - size - (begin & 31))
        high, low = (shifted >> 32) & 0xFFFFFFFF, shifted & 0xFFFFFFFF
        n = (int(end[-1]) + 31 >> 5) + 1 if len(ids) else 0
        total = np.bincount(word, high, n + 1) + np.bincount(word + 1, low, n + 1) if n else np.zeros(0)
        return total.astype(np.uint32).astype(">u4").tobytes(), begin[::STRIDE].astype("<u4" if n < 1 << 26 else "<u8")

    def decode(self, codes: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` ids from the bit offsets ``checkpoints``, one every stride; all strides step together."""
        raw = np.frombuffer(codes + b"\0" * 8, np.uint8).astype(np.int64)
        five = raw[:-4] << 24 | raw[1:-3] << 16 | raw[2:-2] << 8 | raw[3:-1]  # 32 bits from every byte
        at, out = checkpoints.astype(np.int64), np.zeros((STRIDE, len(checkpoints)), np.uint32)
        mask, last = (1 << self.limit) - 1, count - (len(checkpoints) - 1) * STRIDE
        for k in range(min(STRIDE, count)):
            live = at[: len(checkpoints) - (k >= last)]
            entry = (five[live >> 3] >> (32 - self.limit - (live & 7))) & mask
            out[k, : len(live)] = self.ids[entry]
            at = live + self.bits[entry]
        return out.T.reshape(-1)[:count]


def token_table(docs: DataFrame, file: str, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (16-bit little-endian where the vocabulary allows, else 32-bit) with the end id."""
    kind = _kind(file)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 2 * STEP_BYTES):
            ids, bounds = with_end(*encoder(file, True).encode(text_column(part, "text")), end)
            raw, at = ids.astype(kind).tobytes(), (bounds * np.dtype(kind).itemsize).astype(np.int32)
            body = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(at), pa.py_buffer(raw)])
            yield pa.record_batch({"doc_id": part.column(0), "ids": body})

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, ids binary")


def _kind(file: str) -> str:
    return "<u2" if encoder(file, True).library.get_vocab_size() <= 1 << 16 else "<u4"


def _ids_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    width = np.dtype(kind).itemsize
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data[int(offsets[0]) : int(offsets[-1])].to_pybytes(), kind) if data is not None else np.zeros(0, kind)
    return flat, (offsets - offsets[0]) // width


def count_ids(tokens: DataFrame, kind: str, vocabulary: int) -> np.ndarray:
    """How often each id occurs; a task sends each id once, and the result has at most ``vocabulary`` rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_ids_of(batch.column(0), kind)[0], minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(seen), "n": pa.array(total[seen])})

    found = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(vocabulary, np.int64)
    out[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def write_files(tokens: DataFrame, lengths: np.ndarray, kind: str) -> DataFrame:
    """The file rows of a token table, in ascending doc_id order over shards and blocks."""
    packed_lengths = lengths.tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, shard = Book(np.frombuffer(packed_lengths, np.uint8)), TaskContext.get().partitionId()
        block = before = size = 0
        held: list[pa.RecordBatch] = []

        def row() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids, bounds = _ids_of(whole.column(1).chunk(0), kind)
            codes, checkpoints = book.encode(ids)
            doc_ids = whole.column(0).chunk(0)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as out:
                out.write_batch(pa.record_batch({"doc_id": doc_ids}))
            body = [sink.getvalue().to_pybytes(), np.diff(bounds).astype("<i8").tobytes(), checkpoints.astype("<u8").tobytes(), codes]
            numbers = [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64())]
            return pa.record_batch([*numbers, *(pa.array([b], pa.binary()) for b in body)], ["shard", "block", "before", "n_ids", "doc_ids", "lengths", "checkpoints", "codes"])

        for batch in batches:
            for part in slices([batch], "ids", BLOCK_IDS * np.dtype(kind).itemsize):
                held.append(part)
                size += len(_ids_of(part.column(1), kind)[0])
                if size >= BLOCK_IDS:
                    yield row()
                    before, block, size = before + size, block + 1, 0
                    held.clear()
        if held:
            yield row()

    n = count_partitions(tokens.sparkSession, -(-stored_bytes(tokens) // SHARD_BYTES))
    # The place in the stored table parts rows of one doc_id, so that a frequent one is spread.
    placed = tokens.withColumn("place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(n, "doc_id", "place").sortWithinPartitions("doc_id", "place")
    return ranged.drop("place").mapInArrow(run, FILE)


def read_files(files: DataFrame, lengths: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the file rows."""
    totals = dict(files.groupBy("shard").agg(F.sum("n_ids")).collect())  # one row for each shard
    base, sofar = {}, 0
    for shard in sorted(totals):
        base[shard] = sofar
        sofar += totals[shard]
    packed_lengths = lengths.tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(np.frombuffer(packed_lengths, np.uint8))
        for batch in batches:
            for r in range(batch.num_rows):
                shard, before, n, doc_ids, sizes, checkpoints, codes = (batch.column(i)[r].as_py() for i in (0, 2, 3, 4, 5, 6, 7))
                raw = memoryview(book.decode(codes, np.frombuffer(checkpoints, "<u8"), n).astype("<u4").tobytes())
                sizes = np.frombuffer(sizes, "<i8")
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                with pa.ipc.open_stream(doc_ids) as stream:
                    own = stream.read_next_batch().column(0)
                yield pa.record_batch({"doc_id": own, "start": pa.array(base[shard] + before + ends - sizes), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crc, pa.int64())})

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame, file: str, end: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, np.ndarray]:
    """Tokenise, count, and write all ids: the stored file rows and the code lengths that read them."""
    kind = _kind(file)
    tokens = stored(token_table(docs, file, end, doc_id, text), "tokens")
    lengths = code_lengths(count_ids(tokens, kind, encoder(file, True).library.get_vocab_size()))
    files = stored(write_files(tokens, lengths, kind), "huffman", "none")
    forget(tokens)
    return files, lengths
