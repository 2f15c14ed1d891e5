"""Reading, writing, whole plans, the command line and the stream."""

import random

import pytest

from kithline.operators.models import load_model
from kithline.plans import cli
from kithline.plans.linker import Linker, Paths, run_validate
from kithline.schema import SOURCE_COLUMNS, Settings
from kithline.sources import tsv
from kithline.streaming.incremental import link_stream


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def test_read_tsv(spark, tmp_path):
    path = write(tmp_path / "a.tsv", '﻿ country \tentity_id\tbusiness_address\textra\tbusiness_name\nUS\tS1-1\t"a ""b"" c"\tx\tNA\n\nnull\tS1-2\t"two\nlines"\ty\tAcme\n')
    rows = tsv.read_tsv(spark, path, SOURCE_COLUMNS).collect()
    assert [tuple(r) for r in rows] == [("S1-1", None, 'a "b" c', "US"), ("S1-2", "Acme", "two\nlines", None)]
    with pytest.raises(ValueError):
        tsv.read_tsv(spark, path, [*SOURCE_COLUMNS, "zzz"])
    with pytest.raises(FileNotFoundError):
        tsv.read_tsv(spark, str(tmp_path / "none.tsv"), SOURCE_COLUMNS)


def test_id_checks(spark, tmp_path):
    for body, message in (("S2-1\ta\tb\tc\nS1-1\ta\tb\tc\nS1-1\ta\tb\tc\n", "prefix"), ("S1-1\ta\tb\tc\nS1-1\td\te\tf\n", "duplicate"), ("\ta\tb\tc\n", "prefix")):
        with pytest.raises(ValueError, match=message):
            tsv.load_source(spark, write(tmp_path / "b.tsv", HEAD + body), "S1")
    good = tsv.load_source(spark, write(tmp_path / "c.tsv", HEAD + "S1-1\ta\t\tc\n"), "S1")
    assert tsv.missing_counts(good).first().business_address == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("S1-1", "S2-1,S3-1"), ("S1-2", None)], "source1_entity_id string, matched_entity_ids string").coalesce(1)
    out = tmp_path / "r.tsv"
    tsv.write_matching_results(rows, str(out))
    assert out.read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    tsv.write_tsv(rows, str(tmp_path / "many"), ["source1_entity_id"], single=False)
    assert (tmp_path / "many" / "_SUCCESS").exists()
    with pytest.raises(ValueError):
        tsv.write_candidate_pairs(rows, str(out))
    path = str(tmp_path / "t.json")
    assert tsv.load_threshold(spark, path) == 0.5
    tsv.save_threshold(spark, 0.7, path)
    assert tsv.load_threshold(spark, path) == 0.7
    assert tsv.find_file(spark, str(tmp_path / "none"), path) == path and tsv.find_file(spark, "/none/a", "/none/b") == "/none/a"


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """Companies of which half have a noisy copy in S2, some in S3 too."""
    rng, at = random.Random(4), tmp_path_factory.mktemp("corpus")
    words = [f"{a}{b}" for a in ("alp", "bet", "gam", "del", "eps", "zet") for b in ("tron", "mart", "gen", "soft", "line")]
    s1, s2, s3, truth = [], [], [], []
    for i in range(60):
        name, place = f"{rng.choice(words)} {rng.choice(words)} {i} Limited", f"{i} {rng.choice(words)} Road"
        s1.append(f"S1-{i:03}\t{name}\t{place}\tUS")
        found = []
        if i % 2:
            s2.append(f"S2-{i:03}\t{name.replace('Limited', 'Ltd')}\t{place.replace('Road', 'Rd')}\tUS")
            found.append(f"S2-{i:03}")
        if i % 4 == 1:
            s3.append(f"S3-{i:03}\t{name.upper()}\t{place}\tUS")
            found.append(f"S3-{i:03}")
        truth.append(f"S1-{i:03}\t{','.join(found)}")
    s3.append("S3-999\tSomething Else\t\t")
    for name, rows in (("source1", s1), ("source2", s2), ("source3", s3)):
        write(at / f"{name}.tsv", HEAD + "\n".join(rows) + "\n")
    write(at / "ground_truth.tsv", "source1_entity_id\tmatched_entity_ids\n" + "\n".join(truth) + "\n")
    return at


def test_command_line_trains_and_predicts(spark, corpus, tmp_path):
    args = ["--mode", "all", "--blocking", "exact_name", "token_address", "--train", str(corpus), "--test", str(corpus), "--out", str(tmp_path)]
    assert cli.main(args, spark) == 0
    rows = dict(line.split("\t") for line in (tmp_path / "matching_results.tsv").read_text().splitlines()[1:])
    assert len(rows) == 60 and rows["S1-005"] == "S2-005,S3-005" and rows["S1-002"] == ""
    assert len((tmp_path / "candidate_pairs.tsv").read_text().splitlines()) == 61
    paths = Paths(*(str(corpus / f"source{i}.tsv") for i in (1, 2, 3)), str(corpus / "ground_truth.tsv"), str(tmp_path / "model"), str(tmp_path / "threshold.json"))
    figures = run_validate(spark, paths, Settings(strategies=("exact_name", "token_address")))
    assert figures["macro_f0_5"] > 0.9 and figures["candidate_recall"] == 1.0
    assert cli.main(["--mode", "predict", "--test", str(tmp_path / "none"), "--out", str(tmp_path)], spark) == 1


def test_stream_links_new_records(spark, corpus, tmp_path):
    settings = Settings(strategies=("exact_name",), model_options={"maxIter": 20})
    tables = tsv.load_train_data(spark, *(str(corpus / f"source{i}.tsv") for i in (1, 2, 3)), str(corpus / "ground_truth.tsv"))
    linker = Linker(spark, settings)
    linker.fit(*tables)
    tables[1].write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(tables[1].schema).parquet(str(tmp_path / "in"))
    link_stream(linker, tables[0], arriving, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30
    with pytest.raises(ValueError):
        Linker(spark, settings).predict(*tables[:3])
    assert load_model is not None
