"""SimHash fingerprints linked at few differing bits, with pigeonring candidate chains.

A text's A-Z are lower-cased and its words cut into shingles (repeats count); a
fingerprint bit is set where over half of the shingles' XXH64 values have it.

Candidates: the 64 bits form a ring of m = 5 segments.  If two fingerprints
differ in at most t = 4 bits, some segment starts a chain of which every prefix
of k segments differs in at most k * t / m bits: 0, 1, 2, 3, 4.  A bucket
therefore holds fingerprints that agree in the first segment of a chain and
differ in at most one bit of the second (each goes to the bucket of its own
value and, for every unset bit, to that with the bit set).  Of so many fingerprints
that such buckets would hold more than ``BUCKET`` on average, the third segment is
part of the key, too, with at most two differing bits in both.  Longer prefixes are
checked by masks before the full distance.  Within a bucket a search over the
unvisited fingerprints finds connected ones and emits a spanning forest, never
all pairs.  Equal fingerprints are one node, so copies add no rows.  Forests are
joined into components by contraction; all tables stay distributed.

Defined results: null or empty texts have fingerprint zero and are linked like
any other; repeated rows get the same values; fewer words than a shingle make
one shingle; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, buffer_of, forget, free_name, frugal, slices, stored, text_column
from .spans import LOWER, Words

SEED = 42
SHINGLE = 4
DISTANCE = 4
WIDTHS = (13, 13, 13, 13, 12)
LOWS = (0, 13, 26, 39, 52)
#: Fingerprints that a bucket of the short key may hold on average; beyond, keys are longer.
BUCKET = 4096
SHORT, LONG = 26, 39
#: A byte's bits as eight one-byte lanes of a 64-bit value.
LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)
#: Masks of the first k segments of the chain from each start.
CHAIN = [[sum(((1 << WIDTHS[(i + j) % 5]) - 1) << LOWS[(i + j) % 5] for j in range(k)) for k in range(6)] for i in range(5)]


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of a null-free string array."""
    data, offsets = buffer_of(texts)
    words = Words(LOWER[data], offsets)
    joined, starts, ends = words.spaced()
    counts = words.counts
    made = np.where(counts == 0, 0, np.maximum(1, counts - shingle + 1))
    total = int(made.sum())
    if not total:
        return np.zeros(len(counts), np.uint64)
    first = np.cumsum(made) - made
    text = np.repeat(np.arange(len(counts)), made)
    begin = words.bounds[:-1][text] + np.arange(total) - first[text]
    end = np.minimum(begin + shingle, words.bounds[1:][text]) - 1
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[begin].tolist(), ends[end].tolist(), strict=True)], np.uint64)
    return simhash(values, made)


def simhash(values: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Fingerprints of texts that have ``made`` of the hashes each, one text's after the other's; zero where a text has none."""
    total, out = len(values), np.zeros(len(made), np.uint64)
    if not total:
        return out
    first = np.cumsum(made) - made
    text = np.repeat(np.arange(len(made)), made)
    # Lane sums of at most 255 shingles each, then sums of those by text.
    within = (np.arange(total) - first[text]) % 255
    cuts = np.flatnonzero(within == 0)
    part_text = text[cuts]
    lanes = LANES[values.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, cuts, axis=0)
    bits = sums.view(np.uint8).reshape(len(cuts), 64).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, part_text[1:] != part_text[:-1]])
    votes = np.add.reduceat(bits, heads, axis=0)
    own = part_text[heads]
    set_bits = votes * 2 > made[own][:, None]
    out[own] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def text_md5(text: Column) -> Column:
    """The MD5 of a text; a null is an empty text."""
    return F.md5(F.coalesce(text, F.lit("")))


def fingerprint_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, marked: bool = False) -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a long) of every document; ``marked`` adds text_md5."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for part in slices(batches, "text", STEP_BYTES // 4):
            columns = {"doc_id": part.column(0), "fp": pa.array(fingerprints(text_column(part, "text"), shingle).view(np.int64))}
            yield pa.record_batch(columns | ({"text_md5": part.column(2)} if marked else {}))

    whole = F.col(text).cast("string")
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text"), *[text_md5(whole).alias("text_md5")] * marked)
    return given.mapInArrow(run, "doc_id long, fp long" + ", text_md5 string" * marked)


def _keys(bits: int = SHORT) -> Callable:
    """(bucket, fingerprint) for every start of a chain; of a key of ``LONG`` bits two set bits may differ, one of them in the second segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(5):
                keys, own = [np.full(len(fp), i, np.uint64)], [fp]
                for j in (i, (i + 1) % 5, (i + 2) % 5)[: bits // 13]:
                    part = (fp >> np.uint64(LOWS[j])) & np.uint64((1 << WIDTHS[j]) - 1)
                    keys[0] = keys[0] << np.uint64(13) | part
                home, second = keys[0], bits - 26
                width = lambda j, i=i: WIDTHS[(i + j) % 5]
                places = [second + x for x in range(width(1))] + [x for x in range(width(2))] * (bits == LONG)
                sets = [(x,) for x in places] + [(x, y) for x in places for y in range(min(x, 13)) if bits == LONG and y < width(2)]
                for places_set in sets:
                    mask = np.uint64(sum(1 << x for x in places_set))
                    unset = home & mask == 0
                    keys.append(home[unset] | mask)
                    own.append(fp[unset])
                yield pa.record_batch({"key": pa.array(np.concatenate(keys).astype(np.int64)), "fp": pa.array(np.concatenate(own).view(np.int64))})

    return run


def linked(values: np.ndarray, start: int, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of one bucket's fingerprints whose chain from ``start`` and distance hold."""
    masks = [np.uint64(m) for m in CHAIN[start]]
    rest, left, right = values, [], []
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            node = todo.pop()
            apart = rest ^ node
            near = np.bitwise_count(apart & masks[3]) <= 2
            near &= np.bitwise_count(apart & masks[4]) <= 3
            near[near] = np.bitwise_count(apart[near]) <= distance
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), node))
                right.append(found)
                todo.extend(found)
                rest = rest[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _forests(batches: Iterable[pa.RecordBatch], bits: int = SHORT) -> Iterator[pa.RecordBatch]:
    """Edges of each bucket; rows come sorted by bucket."""
    kept_key, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def edges(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[heads, len(key)])
        pair = heads[sizes == 2]
        a, b, start = fp[pair], fp[pair + 1], key[pair] >> bits
        apart = a ^ b
        near = np.bitwise_count(apart) <= DISTANCE
        for k, most in ((3, 2), (4, 3)):
            mask = np.array([CHAIN[i][k] for i in range(5)], np.uint64)[start]
            near &= np.bitwise_count(apart & mask) <= most
        left, right = [a[near]], [b[near]]
        for h, n in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            x, y = linked(fp[h : h + n], int(key[h]) >> bits)
            left.append(x)
            right.append(y)
        x, y = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
        return pa.record_batch({"a": pa.array(np.maximum(x, y)), "b": pa.array(np.minimum(x, y))})

    for batch in batches:
        key = np.concatenate([kept_key, batch.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([kept_fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        kept_key, kept_fp = key[last:], fp[last:]
        if last:
            yield edges(key[:last], fp[:last])
    if len(kept_key):
        yield edges(kept_key, kept_fp)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges a > b; roots are nodes, one for each component.

    Rounds of contraction: every node hooks onto its smallest neighbour, pointer
    jumps double each chain of hooks until all end at its root, and edges are drawn
    again between the roots, until none is left.  At most half of the nodes of a
    round are roots, and a chain of n hooks takes log n jumps.
    """
    roots = None
    edges = stored(edges.distinct(), "edges")
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to")), "hooks")
        while True:
            onward = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
            jumped = stored(hook.join(onward, "to").select("node", F.col("further").alias("to"), (F.col("further") != F.col("to")).alias("moved")), "jumps")
            ended = jumped.filter("moved").isEmpty()
            forget(hook)
            hook = jumped
            if ended:
                break
        at_a = hook.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        at_b = hook.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        drawn = edges.join(at_a, "a").join(at_b, "b").filter("ta <> tb")
        next_edges = stored(drawn.select(F.greatest("ta", "tb").alias("a"), F.least("ta", "tb").alias("b")).distinct(), "edges")
        if roots is None:
            roots = hook.select("node", F.col("to").alias("root"))
        else:
            step = hook.select(F.col("node").alias("root"), F.col("to").alias("next"))
            onto = stored(roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
            forget(roots, hook)
            roots = onto
        forget(edges)
        edges = next_edges
    if roots is None:
        roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def rooted_nodes(table: DataFrame) -> DataFrame:
    """Of a fingerprint table (doc_id, fp): every fp with its smallest doc_id as ``first`` and the root of its component."""
    nodes = stored(table.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    bits = SHORT if nodes.count() * 7.5 <= BUCKET << SHORT else LONG
    buckets = nodes.select("fp").mapInArrow(_keys(bits), "key long, fp long")
    forest = buckets.repartition("key").sortWithinPartitions("key").mapInArrow(lambda batches: _forests(batches, bits), "a long, b long")
    roots = connected(forest)
    rooted = stored(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    forget(nodes, roots)
    return rooted


def components(table: DataFrame) -> DataFrame:
    """Of a fingerprint table (doc_id, fp): doc_id, fp and component_id, the smallest doc_id reachable."""
    rooted = rooted_nodes(table)
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "named")
    forget(rooted, least)
    return table.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every document."""
    table = stored(fingerprint_table(docs, doc_id, text, shingle), "simhash")
    found = components(table)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame, linked: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of ``linked`` (doc_id, text_md5, component): that of the smallest (doc_id, text_md5), null ids last."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_md5").alias("md5"))
    own, mark, own_c, mark_c = (free_name(n, docs.columns) for n in ("__id", "__md5", "__chosen_id", "__chosen_md5"))
    chosen = stored(linked.groupBy("component").agg(F.min(order).alias("row")).select(F.col("row.id").alias(own_c), F.col("row.md5").alias(mark_c)), "chosen")
    keyed = docs.withColumn(own, F.col(doc_id).cast("long")).withColumn(mark, text_md5(F.col(text).cast("string")))
    kept = keyed.join(chosen, F.col(own).eqNullSafe(F.col(own_c)) & (F.col(mark) == F.col(mark_c)), "left_semi")
    return kept.dropDuplicates([own, mark]).drop(own, mark)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Of linked rows of ``docs`` the one with the smallest doc_id (then text_md5); rows that nothing links all stay."""
    table = stored(fingerprint_table(docs, doc_id, text, shingle, marked=True), "simhash")
    named = table.join(rooted_nodes(table).select("fp", F.col("root").alias("component")), "fp")
    return first_rows(docs, named.select("doc_id", "text_md5", "component"), doc_id, text)
