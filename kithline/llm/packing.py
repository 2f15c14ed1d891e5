"""Best-fit packing after Martello-Toth dominance reduction.

Sizes are whole numbers up to the capacity, so the instance is its histogram of
sizes: at most ``capacity`` counts, whatever the corpus.  The driver solves that
histogram and gets bins as patterns with a multiplicity; every piece then finds
its place from its rank among pieces of its size.

Reduction: for the largest size j, a set with j that dominates every other
feasible one is fixed for good, as often as its sizes allow:

* a piece that fills the capacity, or with which not even the smallest fits: {j};
* k that fills up exactly: {j, k};
* no two others fit with j: {j, k} with the largest k that fits;
* two others fit, but no three: {j, k} if k is at least the largest sum of two
  that fit; or {j, k, l} with l the largest beside k, if l is at least the
  largest possible smaller one of two.

Each pattern is dominant for the counts at hand and is repeated while they last;
the sizes that are left are placed by best fit, largest first.

Defined results: a null text is its end id; longer texts are cut into pieces of
the capacity, of which the first may be shorter; repeated rows are packed each;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import STEP_BYTES, slices, stored, text_column
from .tokens import REMEMBERED, encoder, with_end

CAPACITY = 2048
Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((size, copies), ...), bins


class _Sizes:
    """A multiset of sizes with ordered look-up."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.order.pop(bisect_left(self.order, size))

    def at_most(self, limit: int, without: dict[int, int] | None = None) -> int:
        """The largest size up to ``limit`` of which more than ``without`` names are there; 0: none."""
        i = bisect_left(self.order, limit + 1) - 1
        while i >= 0 and self.count[self.order[i]] <= (without or {}).get(self.order[i], 0):
            i -= 1
        return self.order[i] if i >= 0 else 0

    def smallest(self, n: int, without: int) -> list[int]:
        """The n smallest, but for one of the size ``without``."""
        out: list[int] = []
        for s in self.order:
            out += [s] * min(n - len(out), self.count[s] - (s == without))
            if len(out) == n:
                break
        return out


def _largest_pair(sizes: _Sizes, j: int, room: int) -> tuple[int, int]:
    """The largest sum of two that fit beside j, and the largest smaller one of such two; zeros: none."""
    best = least = 0
    for s in sizes.order:
        if 2 * s > room or sizes.count[s] - (s == j) < 1:
            if 2 * s > room:
                break
            continue
        other = sizes.at_most(room - s, {j: 1, s: 1 + (s == j)} if s != j else {j: 2})
        if other >= s:
            best, least = max(best, s + other), s
    return best, least


def reduced(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns that dominance fixes, and the counts that are left.

    Goes over the sizes from the largest; a size without a dominant set is left.
    """
    sizes, fixed = _Sizes(counts), []
    j = sizes.order[-1] if sizes.order else 0
    while j:
        room = capacity - j
        low = sizes.smallest(3, j)
        k = sizes.at_most(room, {j: 1})
        found: list[int] | None = None
        if not low or low[0] > room:
            found = [j]
        elif k == room or len(low) < 2 or low[0] + low[1] > room:
            found = [j, k]
        elif len(low) < 3 or sum(low) > room:
            best, least = _largest_pair(sizes, j, room)
            if k >= best:
                found = [j, k]
            else:
                used = {j: 1}
                used[k] = used.get(k, 0) + 1
                beside = sizes.at_most(room - k, used)
                if beside and beside >= least:
                    found = [j, k, beside]
        if found:
            need = {s: found.count(s) for s in found}
            often = min(sizes.count[s] // n for s, n in need.items())
            for s, n in need.items():
                sizes.take(s, n * often)
            fixed.append((tuple(sorted(need.items(), reverse=True)), often))
        if not found or j not in sizes.count:
            j = sizes.at_most(j - 1)
    return fixed, sizes.count


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit, largest first, over bins grouped by what is in them."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []

    def add(room: int, content: dict[int, int], bins: int) -> None:
        if bins:
            if room not in groups:
                insort(rooms, room)
            groups.setdefault(room, []).append((content, bins))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                each = capacity // size
                add(capacity % size, {size: each}, left // each)
                if left % each:
                    add(capacity - size * (left % each), {size: left % each}, 1)
                break
            room = rooms[i]
            content, bins = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            each = room // size
            full = min(bins, left // each)
            rest = left - full * each if full < bins else 0
            rest = min(rest, each - 1)
            add(room - each * size, content | {size: each}, full)
            add(room - rest * size, content | {size: rest} if rest else content, 1 if bins > full and rest else 0)
            add(room, content, bins - full - (1 if bins > full and rest else 0))
            left -= full * each + rest
    return [(tuple(c.items()), n) for members in groups.values() for c, n in members]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, rest = reduced(counts, capacity)
    return fixed + best_fit(rest, capacity)


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Martello and Toth's bound L2 on the number of bins."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for low in sorted({s for s in counts if 2 * s <= capacity} | {0}):
        big = sum(n for s, n in counts.items() if s > capacity - low)
        half = [(s, n) for s, n in counts.items() if capacity - low >= s > capacity // 2]
        small = sum(s * n for s, n in counts.items() if low <= s <= capacity // 2)
        room = sum(n for _, n in half) * capacity - sum(s * n for s, n in half)
        best = max(best, big + sum(n for _, n in half) + max(0, -(-(small - room) // capacity)))
    return best


def _intervals(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each size, in order, the ranks that a pattern takes: first rank, copies a bin, first sequence, offset in it."""
    rows, taken, sequence = [], {}, 0
    for content, bins in patterns:
        offset = 0
        for size, copies in content:
            rows.append((size, taken.get(size, 0), copies, sequence, offset))
            taken[size] = taken.get(size, 0) + copies * bins
            offset += size * copies
        sequence += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("size", "first", "copies", "sequence", "offset"), table.T.copy(), strict=True))


def cut_pieces(docs: DataFrame, file: str, end: int = 0, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, step: int = 2 * STEP_BYTES, remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of every document's ids, with each one's rank among pieces of its length in its task.

    ``with_ids`` adds the ids themselves (little-endian 32-bit integers).  Text
    bytes of a ``step`` and units ``remembered`` trade a worker's memory for time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for part in slices(batches, "text", step):
            ids, bounds = with_end(*encoder(file, False, remembered).encode(text_column(part, "text")), end)
            raw, sizes = ids.tobytes(), np.diff(bounds)
            number = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
            first = sizes - (number - 1) * capacity
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            heads = np.searchsorted(ordered, ordered)
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - heads + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            begin = (bounds[:-1][doc] + start) * 4
            bodies = [raw[a:b] for a, b in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
            columns = {
                "doc_id": part.column(0).take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(b) for b in bodies], pa.int64()), "task": pa.array(np.full(len(doc), task, np.int32)), "rank": pa.array(rank),
            }
            yield pa.record_batch(columns | ({"ids": pa.array(bodies, pa.binary())} if with_ids else {}))

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long" + ", ids binary" * with_ids)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (of a stored table) with sequence_id and offset in place of task and rank."""
    counted = pieces.groupBy("length", "task").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(counted.select("length", "task", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "ranks")
    counts = {r[0]: r[1] for r in base.groupBy("length").agg(F.sum("count")).collect()}  # at most one row for each length
    at = _intervals(plan(counts, capacity))
    code = at["size"] << 44 | at["first"]
    names = [c for c in pieces.columns if c not in ("task", "rank")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            i = np.searchsorted(code, size << 44 | rank, "right") - 1
            bins, copy = np.divmod(rank - at["first"][i], at["copies"][i])
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            yield pa.record_batch(columns | {"sequence_id": pa.array(at["sequence"][i] + bins), "offset": pa.array(at["offset"][i] + copy * size)})

    ranked = pieces.join(base.drop("count").hint("merge"), ["length", "task"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base", "task")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in names)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, file: str, end: int = 0, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, **memory: int) -> DataFrame:
    """Every document's pieces with their places in sequences of at most ``capacity`` ids."""
    return place(stored(cut_pieces(docs, file, end, doc_id, text, capacity, with_ids, **memory), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, of pieces that carry their ids: at most ``capacity`` ids a group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
