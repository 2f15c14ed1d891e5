"""Quality rules, SimHash components and substring dedup against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kithline.llm import quality_cascade, simhash_ring, spans, substring_dedup

from .conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text, fewest=20):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, chars, symbols, dup, again = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    failed = n < fewest or 100 * again > 30 * n
    lettered, capitals = sum(bool(re.search("[A-Za-z]|[^\0-\x7f]", w)) for w in words), sum(bool(re.fullmatch("[A-Z]{2,}", w)) for w in words)
    stop = sum("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) in quality_cascade.STOP_WORDS for w in words)
    stutter, bullets, ellipses = sum(a == b for a, b in zip(words, words[1:], strict=False)), sum(bool(re.match("[ \t]*[-*•‣–][ \t]", x)) for x in lines), sum(x.rstrip(" \t\x0b\f\r").endswith(("...", "…")) for x in lines)
    rejected = 10 * symbols > n or 2 * text.count("!") > n or 2 * dup > len(lines) or (len(lines) >= 5 and 10 * dup > 3 * len(lines)) or chars < 2 * n or chars > 15 * n
    rejected = rejected or 10 * lettered < 6 * n or (n >= 50 and stop < 2) or 2 * capitals > n or 10 * stutter > 3 * n or 10 * bullets > 9 * len(lines) or 10 * ellipses > 3 * len(lines)
    return n, chars, symbols, dup, again, failed, not failed and not rejected


def test_quality_equals_brute_force(odd, odd_rows):
    got = Counter(tuple(r) for r in quality_cascade.statistics(odd).collect())
    assert got == Counter((i, *quality(t)) for i, t in odd_rows)


def test_each_own_rule_rejects(spark):
    plain = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    prose = " ".join(plain) + " the of"
    lines = lambda f: "\n".join(f(" ".join(plain[4 * k : 4 * k + 4])) for k in range(15)) + "\nthe of"
    rows = [
        (0, prose), (1, " ".join(plain)), (2, " ".join(f"{k} 1" for k in range(70)) + " the of"), (3, " ".join(w.upper() for w in plain) + " the of"),
        (4, " ".join(w for w in plain[:20] for _ in range(3)) + " the of"), (5, lines(lambda x: "- " + x)), (6, lines(lambda x: x + "...")), (7, lines(lambda x: x + "… \r")), (8, lines(str)),
        (9, " \u2022\tpoint\n" * 3 + prose), (10, "THE Of " + " ".join(plain)), (11, "the, of. " + " ".join(plain)), (12, " ".join(plain[:40])),
    ]
    got = {r.doc_id: r.kept for r in quality_cascade.statistics(frame(spark, rows)).collect()}
    assert got == {i: quality(t)[-1] for i, t in rows} and sorted(i for i in got if not got[i]) == [1, 2, 3, 4, 5, 6, 7, 11]


def test_quality_keeps_rows_whole_and_orders_by_yield(odd, odd_rows, empty):
    kept = quality_cascade.kept_rows(odd.withColumn("kept", F.lit(1)).withColumn("n_words", F.lit("x")))
    assert kept.columns == [*odd.columns, "kept", "n_words"]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((i, t) for i, t in odd_rows if quality(t)[-1])
    assert quality_cascade.statistics(empty).count() == 0 and quality_cascade.kept_rows(empty).count() == 0
    order = quality_cascade.order_rules(odd, quality_cascade.OWN, known=quality_cascade.REPORTED)
    gains = [s / c for _, c, s in order]
    assert gains == sorted(gains, reverse=True) and order[-1][2] == 0 and {r.name for r, _, _ in order} == {r.name for r in quality_cascade.OWN}
    assert quality_cascade.statistics(odd.filter("doc_id = 12")).filter("kept").count() in (0, 1)  # with columns pruned


def fingerprint(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = np.zeros(64, np.int64)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        votes += np.array([h >> b & 1 for b in range(64)])
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(shingles))


def smallest_reachable(marks):
    """Of {key: fingerprint}: the smallest key reachable over links of at most 4 bits."""
    keys = sorted(marks)
    values = np.array([marks[k] for k in keys], np.uint64)
    out, seen = {}, np.zeros(len(keys), bool)
    for i, k in enumerate(keys):
        if seen[i]:
            continue
        todo, seen[i] = [i], True
        while todo:
            j = todo.pop()
            out[keys[j]] = k
            near = np.flatnonzero(~seen & (np.bitwise_count(values ^ values[j]) <= 4))
            seen[near] = True
            todo += near.tolist()
    return out


def test_simhash_equals_brute_force(spark, odd_rows):
    rows = [(1000 * n + i, t) for n, (i, t) in enumerate(odd_rows)]
    marks = {i: fingerprint(t) for i, t in rows}
    least = smallest_reachable(marks)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_ring.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: (f"{marks[i]:016x}", least[i]) for i, _ in rows}


@pytest.mark.parametrize("bucket", [simhash_ring.BUCKET, 0])
def test_simhash_links_of_random_fingerprints(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash_ring, "BUCKET", bucket)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values = []
    for c in centres.tolist():
        for _ in range(12):
            bits = rng.choice(64, rng.integers(0, 6), replace=False)
            values.append(c ^ sum(1 << int(b) for b in bits))
            c = values[-1] if rng.random() < 0.3 else c
    values += [values[0]] * 50 + [0, 1, 3, 31]
    marks = dict(enumerate(values))
    table = spark.createDataFrame([(i, int(np.uint64(v).astype(np.int64))) for i, v in marks.items()], "doc_id long, fp long")
    assert {r.doc_id: r.component_id for r in simhash_ring.components(table).collect()} == smallest_reachable(marks)


@pytest.mark.parametrize("shuffled", [False, True])
def test_long_paths_take_few_rounds(spark, shuffled, monkeypatch):
    order = list(range(1001))
    if shuffled:
        np.random.default_rng(2).shuffle(order)
    edges = spark.createDataFrame([(max(x, y), min(x, y)) for x, y in zip(order, order[1:], strict=False)], "a long, b long")
    made, store = [], simhash_ring.stored
    monkeypatch.setattr(simhash_ring, "stored", lambda df, name: made.append(name) or store(df, name))
    found = simhash_ring.connected(edges).collect()
    assert {r.node for r in found} == set(order) and len({r.root for r in found}) == 1
    assert made.count("hooks") <= (8 if shuffled else 1) and (shuffled or made.count("jumps") <= 12)


def test_one_of_each(spark, empty, odd):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "quite another text of some words here"), (3, "quite another text of some words here")]
    kept = simhash_ring.one_of_each(frame(spark, rows))
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert simhash_ring.near_duplicates(empty).count() == 0 and simhash_ring.one_of_each(empty).count() == 0
    assert simhash_ring.near_duplicates(odd.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))).count() == odd.count()
    mine = odd.withColumn("__id", F.lit("mine")).withColumn("__MD5", F.lit(2)).withColumn("row", F.lit(3)).withColumn("node", F.lit(4))
    assert simhash_ring.one_of_each(mine).columns == mine.columns and simhash_ring.one_of_each(mine).count() == simhash_ring.one_of_each(odd).count()


@pytest.mark.parametrize("bits", [simhash_ring.SHORT, simhash_ring.LONG])
def test_chains_find_every_close_pair(bits):
    """Every pair of at most 4 bits shares a bucket whose chain it passes."""
    rng = np.random.default_rng(1)
    import pyarrow as pa

    for _ in range(300):
        a = int(rng.integers(0, 1 << 62))
        b = a ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(1, 5), replace=False))
        pair = np.array([a, b], np.uint64)
        got = list(simhash_ring._keys(bits)([pa.record_batch({"fp": pa.array(pair.view(np.int64))})]))
        rows = {(k, f) for batch in got for k, f in zip(*(c.to_pylist() for c in batch.columns), strict=True)}
        shared = {k for k, _ in rows if len({f for q, f in rows if q == k}) == 2}
        assert any(len(simhash_ring.linked(pair, k >> bits)[0]) for k in shared)


def removed(rows):
    """(words, removed, kept text) of each row, rows in doc_id order."""
    seen, out = set(), []
    for i, t in rows:
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for j in range(len(words) - 19):
            window = tuple(words[j : j + 20])
            if window in seen:
                gone[j : j + 20] = [True] * 20
            seen.add(window)
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def test_substring_dedup_equals_brute_force(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 3000)
    rows = [(1000 * n + i, t) for n, (i, t) in enumerate(odd_rows)]
    got = {tuple(r) for r in substring_dedup.digests(frame(spark, rows)).collect()}
    assert got == {(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in removed(rows)}
    assert sum(r[2] for r in got) > 300


def test_substring_dedup_of_every_shift(spark):
    """A passage of exactly 20 words, once at each place modulo 13 in each text, is found at all of them."""
    passage = [f"p{i}" for i in range(20)]
    rows = [(k, " ".join([f"a{k}_{i}" for i in range(k)] + passage + [f"b{k}_{i}" for i in range(30)])) for k in range(30)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.digests(frame(spark, rows)).collect()}
    assert got == {k: 20 * (k > 0) for k in range(30)}


def test_removed_rows(spark, empty, odd):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, text), (3, "own start  " + text + " own end"), (4, None), (5, " kept  as it is ")]
    got = {r.doc_id: (r.text, r.n_chars) for r in substring_dedup.removed_rows(frame(spark, rows)).collect()}
    assert got == {1: (text, len(text)), 3: ("own start own end", 17), 4: (None, None), 5: (" kept  as it is ", 16)}
    assert substring_dedup.digests(empty).count() == 0 and substring_dedup.removed_rows(empty).count() == 0
    extra = substring_dedup.removed_rows(odd.withColumn("chunk", F.lit(1)).withColumn("texts", F.lit("x")))
    assert extra.columns == [*odd.columns, "chunk", "texts"]
    unnamed = spark.createDataFrame([(None, text), (7, text)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.digests(unnamed).collect()} == {7: 0, None: 30}


def test_rolling_hash_of_any_length():
    x = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for n in (1, 2, 3, 8, 13, 20):
        plain = np.zeros(len(x) - n + 1, np.uint64)
        for k in range(n):
            plain = plain * np.uint64(0x9E3779B97F4A7C15) + x[k : k + len(plain)]
        assert (spans.rolling(x, n) == spans.mixed(plain)).all()
    assert len(spans.rolling(x[:5], 8)) == 0


@pytest.mark.parametrize("text", ["", " ", "a", "  a  b ", "é ü\tß\n", "\x0b\x0c x"])
def test_words(text):
    import pyarrow as pa

    from kithline.llm.common import buffer_of

    texts = [text, "", text + "z", " "]
    w = spans.Words(*buffer_of(pa.array(texts)))
    assert [x.decode() for x in w.array().to_pylist()] == [x for t in texts for x in WORD.findall(t)]
    assert w.counts.tolist() == [len(WORD.findall(t)) for t in texts]
    joined, starts, ends = w.spaced()
    assert [joined[a:z].decode() for a, z in zip(starts, ends, strict=True)] == [x for t in texts for x in WORD.findall(t)]
