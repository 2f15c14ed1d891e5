"""Token files, packing and the lexicon against the tokenizers library and brute force."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kithline.llm import huffman_ids, lexicon_bpe, packing, tokens

from .conftest import frame

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return {f: Tokenizer.from_file(f) for f in (BYTES, WORDS)}


def ids_of(library, file, text):
    return library[file].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts(n):
    rng = random.Random(7)
    parts = ["a", "B", "J", "́", "̌", "'s", "'LL", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u2003", "é", "É", "漢", "1", "²", "½", "!", "'", "''", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85", "\U0001f642", "\u200b", "\ufeff", "_", "İ", "Σ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", "ab" * 3000, "x" * 2000 + " y"]


@pytest.mark.parametrize(("file", "words_only"), [(BYTES, False), (WORDS, True)])
def test_encoder_equals_library(library, file, words_only):
    texts = odd_texts(4000)
    made = tokens.Encoder(file, words_only, remembered=50)
    for part in (texts, texts[:100], [t for t in texts if "<|" not in t]):
        ids, bounds = made.encode(pa.array(part))
        assert all(ids[a:z].tolist() == ids_of(library, file, t) for t, a, z in zip(part, bounds, bounds[1:], strict=False))


def test_token_files(odd, odd_rows, library, empty):
    files, lengths = huffman_ids.encode_corpus(odd, WORDS, end=2)
    got = sorted(tuple(r) for r in huffman_ids.read_files(files, lengths).collect())
    ids = {}
    for i, t in odd_rows:
        ids.setdefault(i, []).append([*ids_of(library, WORDS, t), 2])
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((i, len(x), crc(x)) for i, many in ids.items() for x in many)
    start = 0
    for _, at, n, _ in sorted(got, key=lambda r: r[1]):
        assert at == start
        start += n
    in_order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert in_order == sorted(in_order)
    files, lengths = huffman_ids.encode_corpus(empty, WORDS, end=2)
    assert huffman_ids.read_files(files, lengths).count() == 0


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.4, n) % 49408).astype(np.int64)
    lengths = huffman_ids.code_lengths(np.bincount(ids, minlength=49408))
    book = huffman_ids.Book(lengths)
    codes, checkpoints = book.encode(ids)
    assert (book.decode(codes, checkpoints, n) == ids).all()
    used = lengths[lengths > 0].astype(float)
    assert (2.0**-used).sum() <= 1


def test_code_lengths_are_optimal():
    import heapq

    rng = random.Random(1)
    for _ in range(50):
        counts = np.array([rng.choice([0, 1, 1, 2, 5, 100, 10000]) for _ in range(rng.randint(2, 40))])
        heap = sorted(int(c) for c in counts if c)
        if len(heap) < 2:
            continue
        cost = 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        assert (huffman_ids.code_lengths(counts, 30) * counts).sum() == cost
        short = huffman_ids.code_lengths(counts, 6)
        assert short.max() <= 6 and (2.0 ** -short[short > 0].astype(float)).sum() <= 1
    with pytest.raises(ValueError):
        huffman_ids.code_lengths(np.ones(9, int), 3)


def placed(rows):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    return by_doc, by_sequence


def test_packing(spark, odd_rows, library, empty):
    rows = [(1000 * n + i, t) for n, (i, t) in enumerate(odd_rows)]
    packed = packing.pack(frame(spark, rows).withColumn("rank", F.lit(1)), BYTES, 0, with_ids=True)
    by_doc, by_sequence = placed(packed.collect())
    for i, t in rows:
        ids, at = [*ids_of(library, BYTES, t), 0], 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, crc(ids[at : at + r.length])) and (k == 0 or r.length == 2048) and r.length <= 2048
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    sizes = Counter(r.length for many in by_doc.values() for r in many)
    assert packing.lower_bound(sizes) <= len(by_sequence) <= packing.lower_bound(sizes) + 1
    assert {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(packed).collect()} == {s: sum(n for _, n in p) for s, p in by_sequence.items()}
    assert packing.pack(empty, BYTES).count() == 0
    assert sorted(packing.pack(frame(spark, [(1, "a"), (1, "a"), (None, None)]), BYTES).select("length").collect()) == [(1,), (2,), (2,)]


@lru_cache(None)
def fewest(items, capacity):
    """The least number of bins, by search."""
    if not items:
        return 0
    first, rest = items[0], items[1:]
    best = len(items)

    def fill(room, left, start):
        nonlocal best
        best = min(best, 1 + fewest(tuple(left), capacity))
        for k in range(start, len(left)):
            if left[k] <= room and (k == start or left[k] != left[k - 1]):
                fill(room - left[k], left[:k] + left[k + 1 :], k)

    fill(capacity - first, list(rest), 0)
    return best


def test_reduction_never_loses_the_optimum():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        items = tuple(sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True))
        fixed, rest = packing.reduced(Counter(items), capacity)
        left = tuple(sorted((s for s, n in rest.items() for _ in range(n)), reverse=True))
        assert sum(n for _, n in fixed) + fewest(left, capacity) == fewest(items, capacity), items
        plan = packing.plan(Counter(items), capacity)
        assert Counter({s: sum(k * n for c, n in plan for size, k in c if size == s) for s in set(items)}) == Counter(items)
        assert all(sum(s * k for s, k in c) <= capacity for c, _ in plan)
        assert packing.lower_bound(Counter(items), capacity) <= fewest(items, capacity)


def test_best_fit_equals_item_by_item():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.choice([10, 50, 100])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 60))), reverse=True)
        rooms = []
        for s in items:
            fits = [r for r in rooms if r >= s]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - s)
        assert sum(n for _, n in packing.best_fit(Counter(items), capacity)) == len(rooms)


def test_lexicon_round_trip(odd, odd_rows, library, empty):
    got = Counter(tuple(r) for r in lexicon_bpe.round_trip(odd, BYTES, size=40).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in odd_rows:
        ids = ids_of(library, BYTES, t)
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library[BYTES].decode(ids, skip_special_tokens=False).encode())] += 1
    assert got == want
    assert lexicon_bpe.round_trip(empty, BYTES).count() == 0
    assert {(r.doc_id, len(r.ids) // 4) for r in lexicon_bpe.encoded(odd, BYTES, size=40).collect()} == {k[:2] for k in want}


def test_lexicon_equals_library_whatever_its_words(tmp_path, library):
    texts = odd_texts(3000)
    units = Counter(tokens.units_of(pa.array(texts))[0].to_pylist())
    for size in (0, 1, 300):
        path = tmp_path / f"{size}.bin"
        path.write_bytes(lexicon_bpe.compiled([w for w, _ in units.most_common(size) if len(w) <= 64], BYTES))
        made = lexicon_bpe.Lexicon(str(path), BYTES)
        ids, bounds = made.encode(pa.array(texts))
        raw, at = made.decode(ids, bounds)
        for k, t in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == ids_of(library, BYTES, t)
            assert raw[at[k] : at[k + 1]] == t.encode()


def test_automaton_is_minimal_and_numbers_words():
    rng = random.Random(6)
    for _ in range(30):
        words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 80))})
        made = lexicon_bpe.Automaton(words)
        tails = lambda p, words=words: frozenset(w[len(p) :] for w in words if w.startswith(p))
        assert len(made.arcs) == len({tails(w[:k]) for w in words for k in range(len(w) + 1)})
        arcs = {k: (t, s) for k, t, s in zip(made.keys, made.targets, made.skips, strict=True)}
        for number, word in enumerate(words):
            state, total = made.root, 0
            for byte in word:
                state, skip = arcs[state << 8 | byte]
                total += skip
            assert made.final[state] and total == number


def test_merges_of_long_words(library):
    made = lexicon_bpe.Merges(BYTES)
    rng = random.Random(8)
    for n in (150, 250, 900):
        word = "".join(rng.choice("etaoinshr") for _ in range(n))
        got = [np.frombuffer(x, "<u4").tolist() for x in made.encode_many([word.encode(), b" x", b""])]
        assert got == [ids_of(library, BYTES, word), ids_of(library, BYTES, " x"), []]


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "a", "é漢ab"])
def test_a_megabyte_without_spaces(library, letters):
    made, rng = lexicon_bpe.Merges(BYTES), random.Random(9)
    word = "".join(rng.choice(letters) for _ in range(1 << 20))
    began = time.perf_counter()
    got = np.frombuffer(made.encode_many([word.encode()])[0], "<u4").tolist()
    assert time.perf_counter() - began < 20 and got == ids_of(library, BYTES, word)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        lexicon_bpe.Merges(WORDS)


def test_columns_with_clashing_names(spark, odd):
    more = odd
    for name in ("ids", "n", "word", "start", "piece", "length", "shard", "block", "sequence_id", "offset", "n_tokens"):
        more = more.withColumn(name, F.lit("x"))
    plain = lambda df: Counter(tuple(r) for r in df.collect())
    assert plain(lexicon_bpe.round_trip(more, BYTES, size=40)) == plain(lexicon_bpe.round_trip(odd, BYTES, size=40))
    of = lambda docs: plain(huffman_ids.read_files(*huffman_ids.encode_corpus(docs, WORDS, 2)).select("doc_id", "n_tokens", "ids_crc32"))
    assert of(more) == of(odd)
    pieces = lambda docs: plain(packing.pack(docs, BYTES, 0).select("doc_id", "piece", "start", "length", "ids_crc32"))
    assert pieces(more) == pieces(odd)


def test_a_frequent_doc_id_is_spread_over_shards(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    files, lengths = huffman_ids.encode_corpus(rows, WORDS, 2)
    by_shard = [r["sum(n_ids)"] for r in files.groupBy("shard").sum("n_ids").collect()]
    assert len(by_shard) == 4 and max(by_shard) < 2 * min(by_shard)
    read = huffman_ids.read_files(files, lengths).orderBy("start").collect()
    assert [r.doc_id for r in read] == sorted(r.doc_id for r in rows.collect())
    assert [r.start for r in read] == [sum(x.n_tokens for x in read[:k]) for k in range(len(read))]
