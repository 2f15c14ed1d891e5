"""SimHash near-dedup of a given similarity: Jaccard of sets of word shingles at ``LEAST`` or more, verified exactly.

A text's A-Z are lower-cased and its words cut into shingles of ``SHINGLE`` words; a
shingle is its 64-bit hash.  Texts with the same set of shingles are one node.

At a similarity of 0.8 two 64-bit fingerprints differ in 10 bits on average and in
up to ``RADIUS`` = 22 (all but one pair in 100,000), wide ones of 2,048 bits in 310
and in up to ``WIDE_RADIUS`` = 375 (all but 3 in 100,000).  Keys of segments cannot find
pairs at such a radius: a chain of them that is long enough to narrow texts down
differs in several bits, so every text would go to thousands of buckets.  So keys
are ``BANDS`` bands of ``ROWS`` minima over hash functions instead; a pair of
similarity s shares one with probability 1 - (1 - s ** ROWS) ** BANDS: 0.9996 at 0.8.
Every pair that shares a band is pruned by pigeonring chains of the fingerprints'
five segments, then by the distance of the wide ones, which texts that share a band
have, then by its sets.

A bucket's pairs are never all made.  In each round some nodes of a bucket, first
one, then eight times as many, are compared with the bucket's nodes that are not
linked with them; they are taken from components other than its largest, so a
bucket is done when only nodes of one component have not been compared.  First come
those that share the most bands with others, as the original of many copies does:
its copies are done after one round, however many; no task holds a bucket.

Defined results: texts without words are alike; very long texts are read whole;
fewer words than a shingle make one shingle; repeated rows are alike; an empty table
gives an empty table; ids may be null or repeated, and decide only which row of
linked ones stays; other columns, whatever their names, are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import STEP_BYTES, buffer_of, forget, free_name, frugal, slices, stored, text_column
from .simhash_ring import LOWS, WIDTHS, connected, first_rows, simhash, text_md5
from .spans import LOWER, Words, mixed, rolling

SHINGLE = 5
#: Least similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 26, 6
#: Differing bits of fingerprints that a pair may have; sets of fewer than ``FEW`` shingles are not judged by them.
RADIUS, WIDE_RADIUS, FEW = 22, 375, 16
#: Seeds of the wide fingerprint's 64-bit words.
WORDS = mixed(np.arange(1001, 1033, dtype=np.uint64))
#: Nodes of a bucket that the first round compares with its others, and how many times as many the next does.
FIRST, MORE = 1, 8
_SEEDS = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(2, -1)
ADD, TIMES = _SEEDS[0], _SEEDS[1] | np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text of a null-free string array, ascending, and how many each has."""
    data, offsets = buffer_of(texts)
    words = Words(LOWER[data], offsets)
    hashes, counts = words.hashes(), words.counts
    made = np.where(counts == 0, 0, np.maximum(1, counts - SHINGLE + 1))
    first = np.cumsum(made) - made
    text = np.repeat(np.arange(len(counts)), made)
    out = np.zeros(len(text), np.uint64)
    long = counts[text] >= SHINGLE
    begin = words.bounds[:-1][text] + np.arange(len(text)) - first[text]
    out[long] = rolling(hashes, SHINGLE)[begin[long]]
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
        out[first[i]] = rolling(hashes[words.bounds[i] : words.bounds[i + 1]], int(counts[i]))[0] ^ np.uint64(counts[i])
    order = np.lexsort((out, text))
    out = out[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[new], np.bincount(text[new], minlength=len(counts))


def sketches(values: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set the node (the sum of its shingles' hashes; zero of an empty set) and the hashes of its bands."""
    some = np.flatnonzero(made)
    node, bands = np.zeros(len(made), np.uint64), np.zeros((len(made), BANDS), np.uint64)
    if len(some):
        heads = (np.cumsum(made) - made)[some]
        node[some] = np.add.reduceat(mixed(values), heads)
        for band in range(BANDS):
            key = np.full(len(some), band + 1, np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                key = mixed(key ^ np.minimum.reduceat((values ^ ADD[k]) * TIMES[k], heads))
            bands[some, band] = key
    return node, bands


def sketch_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_md5, node, size of the set, fp (fingerprint of the set) and bands of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for part in slices(batches, "text", STEP_BYTES // 4):
            values, made = shingle_sets(text_column(part, "text"))
            node, bands = sketches(values, made)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(node) + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1).view(np.int64)))
            marks = [pa.array(x.view(np.int64)) for x in (node, made.astype(np.int64), simhash(values, made))]
            yield pa.record_batch([part.column(0), part.column(1), *marks, lists], ["doc_id", "text_md5", "node", "size", "fp", "bands"])

    whole = F.col(text).cast("string")
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_md5(whole).alias("text_md5"), whole.alias("text"))
    return given.mapInArrow(run, "doc_id long, text_md5 string, node long, size long, fp long, bands array<long>")


def set_table(texts: DataFrame) -> DataFrame:
    """Of (node, text) rows: node, set (its ascending shingles as 64-bit values) and wide, the 32 words of its wide fingerprint."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for part in slices(batches, "text", STEP_BYTES // 4):
            values, made = shingle_sets(text_column(part, "text"))
            at = np.concatenate([[0], np.cumsum(made) * 8]).astype(np.int32)
            body = pa.Array.from_buffers(pa.binary(), len(made), [None, pa.py_buffer(at), pa.py_buffer(values.tobytes())])
            wide = np.stack([simhash(mixed(values ^ w), made) for w in WORDS], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * len(WORDS)), pa.array(wide.reshape(-1).view(np.int64)))
            yield pa.record_batch([part.column(0), body, lists], ["node", "set", "wide"])

    return texts.select("node", "text").mapInArrow(run, "node long, set binary, wide array<long>")


def _alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, x, y) rows, where x and y are the sets of a and b: a, b and whether they are similar enough."""
    for batch in batches:
        out = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            one, other = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(one) > len(other):
                one, other = other, one
            at = np.minimum(np.searchsorted(other, one), len(other) - 1)
            shared = int(np.count_nonzero(other[at] == one))
            out.append(LEAST[1] * shared >= LEAST[0] * (len(one) + len(other) - shared))
        yield pa.record_batch({"a": batch.column(0), "b": batch.column(1), "alike": pa.array(out, pa.bool_())})


def within(x: Column, y: Column, radius: int = RADIUS) -> Column:
    """Whether two fingerprints differ in at most ``radius`` bits, and some chain of their segments stays within its shares."""
    apart = x.bitwiseXOR(y)
    masks = [((1 << w) - 1) << low for w, low in zip(WIDTHS, LOWS, strict=True)]
    segments = F.array(*[F.bit_count(apart.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for m in masks])

    def chains(d: Column) -> Column:
        whole = sum((d[k] for k in range(1, 5)), d[0]) <= radius
        some = F.lit(False)
        for i in range(5):
            chain, upto = F.lit(True), F.lit(0)
            for k in range(5):
                upto = upto + d[(i + k) % 5]
                chain = chain & (5 * upto <= radius * (k + 1))
            some = some | chain
        return whole & some

    return F.get(F.transform(F.array(segments), chains), F.lit(0))


def wide_apart(x: Column, y: Column) -> Column:
    """Differing bits of two wide fingerprints."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, d: n + d)


def _candidates(members: DataFrame, sketches: DataFrame, wanted: int) -> tuple[DataFrame, DataFrame]:
    """(key, node) of the nodes that a round compares, and the pairs a > b to verify.

    The first round's pairs are fewer than the members; later ones are pruned by
    the wide fingerprints, and met in the first band only that both have.
    """
    of_component = members.groupBy("key", "comp").agg(F.count_if(~F.col("used")).alias("open"), (-F.max("met")).alias("little"))
    largest = stored(of_component.groupBy("key").agg(F.max(F.struct("open", "little", "comp"))["comp"].alias("largest")), "largest")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("met"), "node"))
    others = members.join(largest, "key").filter(~F.col("used") & (F.col("comp") != F.col("largest")))
    chosen = stored(others.withColumn("rank", rank).filter(F.col("rank") <= wanted).select("key", "node", "size", "fp", "comp"), "chosen")
    sizes = LEAST[1] * F.least("size", "s2") >= LEAST[0] * F.greatest("size", "s2")
    near, rows = within(F.col("fp"), F.col("f2")), members.select("key", "node", "size", "fp", "comp")
    if wanted > FIRST:
        rows, met = rows.join(sketches, "node"), chosen.join(sketches, "node")
        near = near & (wide_apart(F.col("wide"), F.col("w2")) <= WIDE_RADIUS)
        first_band = F.get(F.array_intersect("bands", "b2"), F.lit(0)) == F.col("key")
    else:
        met, first_band = chosen, F.lit(True)
    met = met.withColumnsRenamed({"node": "n2", "size": "s2", "fp": "f2", "comp": "c2", "wide": "w2", "bands": "b2"})
    close = rows.join(met, "key").filter((F.col("comp") != F.col("c2")) & sizes & ((F.least("size", "s2") < FEW) | near) & first_band)
    pairs = stored(close.select(F.greatest("node", "n2").alias("a"), F.least("node", "n2").alias("b")).distinct(), "pairs")
    forget(largest)
    return chosen.select("key", "node"), pairs


def links(members: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the nodes that are linked with another, of bucket ``members`` (key, node, size, fp, met: how many it
    meets in all buckets), and by node their sketches (wide, bands) and sets."""
    now = stored(members.select("*", F.col("node").alias("comp"), F.lit(False).alias("used")), "members")
    found = verified = roots = None
    wanted = FIRST
    while not now.isEmpty():
        compared, pairs = _candidates(now, sketches, wanted)
        if verified is not None:
            pairs = pairs.join(verified.select("a", "b"), ["a", "b"], "left_anti")
        x = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
        y = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
        judged = stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_alike, "a long, b long, alike boolean"), "verified")
        verified = judged if verified is None else verified.unionByName(judged)
        more = judged.filter("alike").select("a", "b")
        found = more if found is None else found.unionByName(more)
        roots = connected(found)
        named = now.join(roots, "node", "left").join(compared.withColumn("done", F.lit(True)), ["key", "node"], "left")
        named = named.select("key", "node", "size", "fp", "met", F.coalesce("root", "node").alias("comp"), (F.col("used") | F.coalesce("done", F.lit(False))).alias("used"))
        after = stored(named, "members")
        # A bucket is open while a node that was not compared is not in its largest component of such nodes.
        open_keys = after.filter(~F.col("used")).groupBy("key").agg((F.min("comp") != F.max("comp")).alias("several"))
        left = stored(after.join(stored(open_keys.filter("several").select("key"), "open"), "key", "left_semi"), "members")
        forget(now, after, compared)
        now, wanted = left, wanted * MORE
    return connected(now.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)) if roots is None else roots


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_md5 and component, one number for all that are linked, of every row."""
    table = stored(sketch_table(docs, doc_id, text), "sketches")
    nodes = stored(table.groupBy("node").agg(F.first("bands").alias("bands"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.min(F.struct("doc_id", "text_md5")).alias("row")), "nodes")
    keys = nodes.filter("node <> 0").select("node", "size", "fp", F.explode("bands").alias("key"))
    shared = stored(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    sharing = stored(keys.join(shared, "key"), "sharing")
    met = stored(sharing.groupBy("node").agg(F.sum("n").alias("met")), "met")
    own, mark = free_name("__id", docs.columns), free_name("__md5", docs.columns)
    wanted = stored(nodes.join(met, "node", "left_semi").select("node", F.col("row.doc_id").alias(own), F.col("row.text_md5").alias(mark)), "wanted")
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("text_md5", text_md5(F.col("text")))
    texts = whole.join(wanted, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col("text_md5") == F.col(mark))).select("node", "text")
    sets = stored(set_table(texts.dropDuplicates(["node"])), "sets")
    marks = stored(sets.select("node", "wide").join(nodes.select("node", "bands"), "node"), "marks")
    roots = links(sharing.drop("n").join(met, "node"), marks, sets)
    found = stored(table.join(roots, "node", "left").select("doc_id", "text_md5", F.coalesce("root", "node").alias("component")), "linked")
    forget(table, nodes, shared, sharing, met, sets, marks)
    return found


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of linked rows of ``docs`` the one with the smallest doc_id (then text_md5); rows that nothing links all stay."""
    return first_rows(docs, components(docs, doc_id, text), doc_id, text)
