"""What the linkage does not make on larger registers."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kithline import queries
from kithline.operators import blocking, candidates, decide, evaluate, features, labels, models
from kithline.plans.linker import Linker
from kithline.schema import CAND, S1, Settings

from .test_linkage import found, register


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(31)
    words = ["every", "often", "often", *(f"word{k}" for k in range(9))]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(0, 4)))
    rows = lambda p, n: register(spark, *((f"{p}-{k:03}", text(), text(), "") for k in range(n)))
    return rows("S1", 40), rows("S2", 40), rows("S3", 40).unionByName(register(spark, ("S1-900", "every often", "every often", "")))


def test_a_cap_makes_no_pairs_beyond_it(sides, monkeypatch):
    every = blocking.run_strategies(sides[0], sides[1].unionByName(sides[2]), Settings().strategies, Settings())
    want = {k: found(candidates.cap(every.filter(~every[CAND].startswith("S1-")), k)) for k in (5, 500)}

    def refused(*_):
        raise AssertionError("all pairs of a token were made")

    for name in ("exact_name", "token_name", "token_address"):
        monkeypatch.setitem(blocking.STRATEGIES, name, refused)
    for k, pairs in want.items():
        assert found(candidates.generate(*sides, settings=Settings(max_candidates=k))) == pairs and len(pairs) > 100


def test_texts_of_pairs_are_not_shuffled(sides, spark):
    pairs = spark.createDataFrame([(f"S1-{k:03}", f"S2-{k % 7:03}") for k in range(40)], f"{S1} string, {CAND} string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features.extract(pairs, sides[0], sides[1], only=["name_jaccard"])._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [candidate_entity_id" in plan


def test_the_top_k_query_takes_blocks_where_a_join_is_large(sides, spark, monkeypatch):
    monkeypatch.setattr(blocking, "JOIN_ROWS", 0)
    monkeypatch.setattr(queries.Linkage, "sides", (sides[0], sides[1]))
    taken, blocks = [], blocking._kernel_scores
    monkeypatch.setattr(blocking, "_kernel_scores", lambda *a: taken.append(1) or blocks(*a))
    assert queries.block_tfidf_topk(spark, "none").columns == [S1, CAND, "score"] and taken


def plan_of(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture
def linkage(sides, spark, monkeypatch):
    """The queries' tables, of the records above."""
    monkeypatch.setattr(queries.Linkage, "rows", sides[0].unionByName(sides[1]).unionByName(sides[2].filter("entity_id LIKE 'S3%'")))
    monkeypatch.setattr(queries.Linkage, "register", queries.Linkage.rows.withColumn("shown", F.substring("entity_id", 4, 3).cast("int") % 5))
    return queries.Linkage(spark, "none")


def test_blocks_make_no_copies_of_names(sides, monkeypatch):
    monkeypatch.setattr(blocking, "BLOCK_S1", 10)
    plans, write = {}, blocking.stored
    monkeypatch.setattr(blocking, "stored", lambda df, name: plans.setdefault(name, []).append(plan_of(df)) or write(df, name))
    blocking.tfidf_scores(sides[0], sides[1], kernel=True)
    assert len(plans["best-of-block"]) > 1 and not any("CoGroup" in p or "Generate" in p for p in plans["best-of-block"])


def test_grouped_candidates_are_never_pairs(linkage, spark):
    got = queries.candidates_grouped(spark, "none")
    assert "Generate" not in plan_of(got)
    pairs = found(linkage.pairs)
    assert {(r[0], c) for r in got.collect() for c in r[1].split(",") if c} == pairs and len(pairs) > 100


def test_lists_decide_and_cover_as_pairs_do(spark):
    pairs = spark.createDataFrame([(f"S1-{k % 4}", f"S{2 + k % 2}-{k % 7}") for k in range(20)], f"{S1} string, {CAND} string").distinct()
    lists, ids = candidates.as_lists(pairs), spark.createDataFrame([(f"S1-{k}",) for k in range(5)], f"{S1} string")
    truth = spark.createDataFrame([("S1-0", "S2-0,S2-0,S3-1"), ("S1-1", "S2-6, S3-5"), ("S1-4", "S2-1"), ("S1-9", "")], f"{S1} string, matched_entity_ids string")
    known = found(pairs)
    listed = [(s, c.strip()) for s, ids_ in [("S1-0", "S2-0,S2-0,S3-1"), ("S1-1", "S2-6, S3-5"), ("S1-4", "S2-1")] for c in ids_.split(",")]
    for offered in (pairs, lists):
        row = evaluate.candidate_recall(offered, truth).first()
        assert (row.n_true, row.n_covered) == (len(listed), sum(p in known for p in listed))
        given = pairs.withColumn("is_match", F.lit(1)).union(spark.createDataFrame([("S1-3", "S2-99", 1), ("S1-4", "S2-1", 1)]))
        got = {r[0]: r[1] for r in decide.match_output(given, ids, None, offered).collect()}
        assert got == {f"S1-{k}": ",".join(sorted(c for s, c in known if s == f"S1-{k}")) for k in range(5)}


def test_tasks_get_few_candidates_at_a_time(sides, spark, monkeypatch):
    pairs = spark.createDataFrame([(f"S1-{k % 40:03}", f"S2-{k % 45:03}") for k in range(200)], f"{S1} string, {CAND} string").distinct()
    truth = spark.createDataFrame([("S1-001", "S2-001,S2-041"), ("S1-002", "S2-002")], f"{S1} string, matched_entity_ids string")
    made = lambda: features.extract(candidates.as_lists(pairs), sides[0], sides[1], only=["name_jaccard", "addr_trigram_overlap"], truth=truth)
    want = {tuple(r) for r in labels.label_pairs(features.extract(pairs, sides[0], sides[1], only=["name_jaccard", "addr_trigram_overlap"]), truth).collect()}
    monkeypatch.setattr(features, "FEW", 9)
    turns = made()
    assert plan_of(turns).count("BroadcastHashJoin [candidate_entity_id") == 5 and {tuple(r) for r in turns.collect()} == want and sum(r[-1] for r in want) > 1
    monkeypatch.setattr(features, "TURNS", 0)
    assert {tuple(r) for r in made().collect()} == want


def test_scores_keep_no_features(sides, spark, monkeypatch):
    monkeypatch.setattr(models, "predict_probability", lambda model, df: df.withColumn("probability", F.col("name_jaccard")))
    linker = Linker(spark, Settings(), model="given")
    pairs = spark.createDataFrame([("S1-001", "S2-001")], f"{S1} string, {CAND} string")
    plan = plan_of(linker.score(pairs, sides[0], sides[1]))
    assert "InMemoryTableScan" not in plan and "ratios" not in plan


def test_lists_are_turned_around_without_pairs(linkage, spark, monkeypatch):
    monkeypatch.setattr(candidates, "TURNED", 50)
    monkeypatch.setattr(candidates, "BUCKET", 20)
    monkeypatch.setattr(queries.Linkage, "candidates", linkage.candidates)
    got = queries.candidates_by_pool(spark, "none")
    assert "Generate" not in plan_of(got) and "collect_set" not in plan_of(got)
    pairs, pool = found(linkage.pairs), linkage.of("S2", "S3").select("entity_id")
    want = {r[0]: ",".join(sorted(s for s, c in pairs if c == r[0])) for r in pool.collect()}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.items()) and len(pairs) > 100
    odd = spark.createDataFrame([("b,é", ["y", "z", "x"]), ("a", ["y"]), ("B", []), ("c", ["y"])], linkage.candidates.schema)
    names = spark.createDataFrame([("y",), ("y",), ("z",), ("w",)], f"{CAND} string")
    assert sorted(tuple(r) for r in candidates.by_candidate(odd, names).collect()) == [("w", ""), ("y", "a,b,é,c"), ("z", "b,é")]


def test_chunks_of_classes_are_dealt_by_their_pairs(sides, monkeypatch):
    want = found(blocking.token_address(sides[0], sides[1]))
    monkeypatch.setattr(blocking, "RARE_PAIRS", 0)
    monkeypatch.setattr(blocking, "SALT_PAIRS", 20)
    got = blocking.token_address(sides[0], sides[1])
    tasks = int(re.search(r"RoundRobinPartitioning\((\d+)\)", plan_of(got))[1])
    assert found(got) == want and len(want) > 100 and len(want) / 20 - 1 < tasks <= len(want) / 20 + 1
