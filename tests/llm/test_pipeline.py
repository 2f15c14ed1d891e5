"""The corpus pipeline against a brute-force version, stage by stage and as a whole."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from kithline.llm import packing, simhash_ring

from .conftest import frame
from .test_simhash_similar import smallest_linked
from .test_texts import WORD, quality, removed
from .test_tokens import crc, placed


@pytest.fixture(scope="module")
def rows(odd_rows):
    """The odd documents as they are, with repeated and null ids, and one that shares a passage with the first."""
    passage = " ".join(odd_rows[0][1].split()[:60])
    shared = (500, "  ".join(["new start", passage, *(f"fresh{k} the of" for k in range(80))]))
    return [*odd_rows, shared, (None, "lost and found the of it " + " ".join(f"a{k}" for k in range(70))), (None, "also lost the of it " + " ".join(f"b{k}" for k in range(70))), (17, "seventeen again the of it " + " ".join(f"c{k}" for k in range(70)))]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    more = frame(spark, rows).withColumn("__id", F.lit("own")).withColumn("node", F.lit(1)).withColumn("chunk", F.lit(2)).withColumn("text_md5", F.lit("x")).withColumn("n_words", F.lit(3))
    more.write.parquet(f"{path}/documents.parquet")
    return path


def brute(rows):
    """(doc_id, text) of what the first three stages leave."""
    kept = sorted((r for r in rows if quality(r[1], 3)[-1]), key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    least = smallest_linked([(n, t) for n, (_, t) in enumerate(kept)])
    kept = [r for n, r in enumerate(kept) if least[n] == n]
    left = []
    for (i, t), (_, n, gone, text) in zip(kept, removed(kept), strict=True):
        if not gone or gone < n:
            left.append((i, text if gone else t))
    return left


def test_pipeline(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
    want = brute(rows)
    assert Counter((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == Counter((i, t, len(t)) for i, t in want)
    lost = [i for i, t in want if (i, t) not in rows]
    assert 500 in lost and sum(i is None for i, _ in want) == 2 and sum(i == 17 for i, _ in want) == 3
    by_doc, by_sequence = placed(corpus_pipeline.run(spark, folder).collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes, found = Counter(), Counter()
    for i, t in want:
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        sizes[i] += len(ids)
        found[i, crc(ids)] += len(ids) <= 2048
    assert {i: sum(r.length for r in pieces) for i, pieces in by_doc.items()} == sizes
    assert all(sum(r.ids_crc32 == c and r.piece == 0 for r in by_doc[i]) >= n for (i, c), n in found.items())
    assert all(sum(n for _, n in p) <= 2048 for p in by_sequence.values())


def test_pipeline_of_nothing(spark, tmp_path, empty):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert len(corpus_pipeline.STAGES) == 4 and corpus_pipeline.ORACLE_SQL is None


def test_quality_stage_rejects_menus_and_repeated_lines(spark):
    words = [*(f"word{k}" for k in range(58)), "the", "of"]
    lines = [" ".join(words[6 * k : 6 * k + 6]) for k in range(10)]
    rows = [
        (1, " | ".join(words)), (2, " ".join(words)), (3, "# " + " ".join(words)),
        (4, "\n".join([*lines[:6], *["read more"] * 5])), (5, "\n".join([*lines, "read more", "read more"])),
    ]
    kept = corpus_pipeline.quality_rules(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]


@pytest.mark.parametrize("one_of_each", [lambda docs: corpus_pipeline.near_duplicates(None, docs, ""), simhash_ring.one_of_each])
def test_null_and_repeated_ids_lose_only_linked_rows(spark, one_of_each):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(60))
    rows = [(None, text(k)) for k in range(5)] + [(7, text(k)) for k in range(5, 10)] + [(None, text(0)), (None, text(9)), (7, text(4)), (3, text(5)), (7, text(6))]
    kept = one_of_each(frame(spark, rows))
    want = [(None, text(k)) for k in range(4)] + [(7, text(4)), (3, text(5))] + [(7, text(k)) for k in range(6, 10)]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)


def test_output_is_the_packed_corpus(spark, folder, rows):
    made = corpus_pipeline.run(spark, folder)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [(i, [*library.encode(t, add_special_tokens=False).ids, 0]) for i, t in brute(rows)]
    got = made.collect()
    assert all(any(j == r.doc_id and np.frombuffer(r.ids, "<i4").tolist() == ids[r.start : r.start + r.length] for j, ids in texts) for r in got)
    packed = packing.sequences(made).collect()
    assert sum(len(r.ids) for r in packed) == 4 * sum(len(ids) for _, ids in texts) and max(len(r.ids) for r in packed) <= 4 * 2048
