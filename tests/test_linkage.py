"""Blocking, candidates, features, labels, thresholds, output and evaluation on small registers."""

import random

import pytest
from pyspark.sql import functions as F

from kithline.functions.text import preprocess
from kithline.operators import blocking, candidates, decide, evaluate, features, labels, models, thresholds
from kithline.schema import CAND, S1, Settings

SOURCE = "entity_id string, business_name string, business_address string, country string"


def register(spark, *rows):
    return preprocess(spark.createDataFrame(list(rows), SOURCE))


def found(df):
    return {(r[S1], r[CAND]) for r in df.collect()}


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], f"{S1} string")


@pytest.fixture(scope="module")
def small(spark):
    s1 = register(spark, ("S1-31", "Larkfield Corp", "888 Quarry Lane", "NO"), ("S1-32", "Tideway Ltd", "905 Harbour Road", "NO"))
    s2 = register(spark, ("S2-71", "LARKFIELD corporation", "888, Quarry Ln.", "NO"))
    s3 = register(spark, ("S3-81", "tideway limited", "905 Harbour Rd", "NO"))
    return s1, s2, s3


BOTH = {("S1-31", "S2-71"), ("S1-32", "S3-81")}


def test_exact_token_and_address_blocking(small):
    s1, pool = small[0], small[1].unionByName(small[2])
    assert found(blocking.exact_name(s1, pool)) == BOTH
    assert found(blocking.token_name(s1, pool)) == BOTH
    assert found(blocking.token_address(s1, pool, 1)) == BOTH
    assert found(blocking.token_address(s1, pool)) == BOTH


def test_tokens_count_with_multiplicity(spark):
    s1 = register(spark, ("S1-1", "", "Porto Porto", ""))
    pool = register(spark, ("S2-1", "", "Porto", ""), ("S2-2", "", "Braga", ""))
    assert found(blocking.token_address(s1, pool, 2)) == {("S1-1", "S2-1")}


def test_short_address_tokens_do_not_block(spark):
    s1 = register(spark, ("S1-5", "Quill Services Technology", "7 Ox Dr", "Chile"))
    pool = register(spark, ("S2-6", "quill services tech", "7 Ox Drive", "Chile"), ("S3-7", "Nothing Alike", "7 Yew Lane", "Peru"))
    assert found(blocking.exact_name(s1, pool)) == {("S1-5", "S2-6")}
    assert found(blocking.token_address(s1, pool)) == set()


def test_country_aware(spark):
    s1 = register(spark, ("S1-1", "Velmora Glass", "1", "Norge"), ("S1-2", "Unmet Zz", "2", ""), ("S1-3", "Ferry Works", "3", ""))
    pool = register(spark, ("S2-1", "Velmora Glass", "", "norge "), ("S2-2", "Works of the Ferry", "", "Chile"), ("S2-3", "Velmora Glass", "", ""), ("S2-4", "Velmora Glass", "", "Chile"))
    assert found(blocking.country_aware(s1, pool)) == {("S1-1", "S2-1"), ("S1-3", "S2-2")}
    assert found(blocking.country_aware(s1, pool, min_shared=2)) == {("S1-1", "S2-1"), ("S1-3", "S2-2")}
    assert found(blocking.country_aware(s1, pool, "exact_name")) == {("S1-1", "S2-1")}


def plain_shared(s1, pool, least):
    """Pairs by counting each token of both lists."""
    rows = lambda df: {r.entity_id: [t for t in r.name_tokens if len(t) >= 3] for r in df.collect()}
    one, two = rows(s1), rows(pool)
    return {(i, j) for i, x in one.items() for j, y in two.items() if sum(x.count(t) * y.count(t) for t in set(x)) >= least}


@pytest.mark.parametrize("salted", [False, True])
def test_shared_tokens_of_frequent_and_repeated_words(spark, salted, monkeypatch):
    if salted:
        monkeypatch.setattr(blocking, "SALT_PAIRS", 50)
    rng = random.Random(12)
    words = ["every", "often", "often", *(f"word{k}" for k in range(12))]
    name = lambda: " ".join([*["every"] * rng.choice([1, 1, 1, 2]), *rng.choices(words, k=rng.randint(0, 3))])
    s1 = register(spark, *((f"S1-{k}", name(), "", "x") for k in range(40)))
    pool = register(spark, *((f"S2-{k}", name(), "", "x" if k % 2 else "y") for k in range(60)))
    for least in (1, 2, 3):
        assert found(blocking.token_name(s1, pool, least)) == plain_shared(s1, pool, least)
    assert found(blocking.country_aware(s1, pool)) == plain_shared(s1, pool.filter("country = 'x'"), 1)


def test_both_paths_of_top_k_agree(spark, monkeypatch):
    rng = random.Random(13)
    name = lambda: " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 3)))
    s1 = register(spark, *((f"S1-{k}", name(), "", "") for k in range(50)))
    pool = register(spark, *((f"S{2 + k % 2}-{k}", name(), "", "") for k in range(120)))
    rows = lambda **o: {tuple(r) for r in blocking.tfidf_scores(s1, pool, 4, **o).collect()}
    want = rows(kernel=False)
    for size in ("BLOCK_S1", "BLOCK_POOL", "SLICE"):
        monkeypatch.setattr(blocking, size, 16)
    assert rows(kernel=True) == want and len(want) > 100
    monkeypatch.setattr(blocking, "JOIN_ROWS", 10)
    assert rows() == want


def test_tfidf_top_k(spark):
    s1 = register(spark, ("S1-1", "alpha beta", "", ""), ("S1-2", "", "", ""))
    pool = register(spark, *((f"S2-{i}", n, "", "") for i, n in enumerate(["alpha beta", "alpha betas", "gamma", "alpha", ""])))
    got = blocking.tfidf_scores(s1, pool, top_k=2).collect()
    assert {(r[S1], r[CAND]) for r in got} == {("S1-1", "S2-0"), ("S1-1", "S2-1")}
    assert max(r.score for r in got) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        blocking.tfidf_scores(s1, register(spark, ("S2-1", "zzz", "", "")))


def test_dispatch_skips_unknown_and_accepts_own(small):
    s1, s2, s3 = small
    assert found(candidates.generate(s1, s2, s3, ["no such", "exact_name"])) == BOTH
    assert candidates.generate(s1, s2, s3, []).count() == 0
    blocking.register_strategy("nothing", lambda a, b, s: blocking.exact_name(a, b).limit(0))
    assert found(candidates.generate(s1, s2, s3, ["nothing"])) == set()


def test_candidates_are_tagged_capped_and_grouped(spark, small):
    s1, s2, s3 = small
    assert {r.candidate_source for r in candidates.generate(s1, s2, s3, ["exact_name"]).collect()} == {"S2", "S3"}
    pairs = spark.createDataFrame([("S1-1", f"S2-{i:03}") for i in range(700)] + [("S1-2", "S3-1")], f"{S1} string, {CAND} string")
    capped = candidates.cap(pairs, 500)
    assert capped.count() == 501 and ("S1-1", "S2-499") in found(capped) and ("S1-1", "S2-500") not in found(capped)
    assert candidates.cap(pairs, None).count() == 701
    groups = candidates.with_all_ids(candidates.grouped(pairs.filter(f"{S1} = 'S1-2'")), ids(spark, "S1-2", "S1-3"))
    assert dict(groups.collect()) == {"S1-2": "S3-1", "S1-3": ""}
    assert dict(candidates.pairs_to_grouped(pairs.filter(f"{S1} = 'S1-2'"), all_ids=ids(spark, "S1-2")).collect()) == {"S1-2": "S3-1"}


def test_features(spark):
    s1 = register(spark, ("S1-9", "Oakum Ltd", "14 Mill Road", "Fiji"))
    pool = register(spark, ("S2-4", "OAKUM limited", "14 Mill Rd.", "fiji"), ("S3-8", "Brine Inc", "20 Kiln Lane", "Mali"))
    pairs = spark.createDataFrame([("S1-9", "S2-4"), ("S1-9", "S3-8"), ("S1-9", "S3-404")], f"{S1} string, {CAND} string")
    rows = {r[CAND]: r.asDict() for r in features.extract(pairs, s1, pool).collect()}
    assert len(features.feature_names()) == 25
    assert all(0.0 <= rows[c][n] <= 1.0 for c in rows for n in features.FEATURES)
    same, other = rows["S2-4"], rows["S3-8"]
    assert all(same[n] == 1.0 for n in features.FEATURES if "overlap" in n or "jaccard" in n or "ratio" in n or "similarity" in n or "exact" in n)
    assert all(same[n] == 0.0 for n in features.FEATURES if "diff" in n or "missing" in n) and same["is_s2"] == 1.0
    # "oakum ltd" and "brine inc" share the space only; "14 mill rd" and "20 kiln ln": a space, i, l, a space
    assert other["name_edit_similarity"] == pytest.approx(2 / 18) and other["name_len_diff"] == 0.0
    assert other["addr_edit_similarity"] == pytest.approx(8 / 20) and other["addr_len_diff"] == 0.0 and other["is_s2"] == 0.0
    assert rows["S3-404"]["cand_name_missing"] == 1.0


def test_labels_and_recall(spark):
    truth = spark.createDataFrame([("S1-1", " S2-1 , S3-1,,S2-1"), ("S1-2", None), ("S1-3", " ")], f"{S1} string, matched_entity_ids string")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-9"), ("S1-2", "S2-1")], f"{S1} string, {CAND} string")
    assert {(r[S1], r[CAND]): r.label for r in labels.label_pairs(pairs, truth).collect()} == {("S1-1", "S2-1"): 1, ("S1-1", "S2-9"): 0, ("S1-2", "S2-1"): 0}
    got = evaluate.candidate_recall(pairs, truth).first()
    assert (got.n_true, got.n_covered, got.candidate_recall) == (3, 2, pytest.approx(2 / 3))
    assert evaluate.candidate_recall(pairs, truth.limit(0)).first().candidate_recall == 0.0


@pytest.mark.parametrize("stratify", [True, False])
def test_split_is_exact_and_disjoint(spark, stratify):
    s1 = spark.range(200).select(F.format_string("S1-%03d", "id").alias("entity_id"))
    truth = s1.select(F.col("entity_id").alias(S1), F.when(F.substring("entity_id", -1, 1) < "3", F.lit("S2-1")).alias("matched_entity_ids"))
    parts = labels.create_split(s1, truth, 0.15, 42, stratify)
    val, train = ({r[0] for r in p.collect()} for p in (parts.val_ids, parts.train_ids))
    assert len(val) == 30 and not val & train and len(train) == 170 and parts.truth_val.count() == 30
    if stratify:
        assert sum(v[-1] < "3" for v in val) == 9


def test_metrics_and_threshold(spark):
    scored = spark.createDataFrame([(1, 0.9), (1, 0.6), (0, 0.6), (0, 0.2), (1, None)], "label int, probability double")
    row = thresholds.pair_metrics(thresholds.apply_threshold(scored, 0.5)).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 1) and row.f0_5 == pytest.approx(2 / 3)
    best, figures = thresholds.tune(scored, Settings())
    steps = thresholds.grid(Settings())
    assert best == min(t for t in steps if t > 0.6) and figures["precision"] == 1.0 and steps[-1] == 0.95 and len(steps) == 85
    for r in thresholds.sweep(scored).collect():
        assert r.tp == sum(1 for y, p in [(1, 0.9), (1, 0.6)] if p >= r.threshold)
    with pytest.raises(ValueError):
        thresholds.tune(scored, Settings(metric="no such"))
    assert thresholds.positive_pairs(thresholds.apply_threshold(scored, 0.9)).count() == 1


def test_match_output_guards(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), f"{S1} string, {CAND} string, probability double, is_match int")
    everyone = ids(spark, "S1-001", "S1-002", "S1-003")
    out = lambda df, **k: dict(decide.match_output(df, everyone, **k).collect())
    empty = {"S1-001": "", "S1-002": "", "S1-003": ""}
    assert out(make(("S1-001", "S2-001", 0.9, 1))) == empty | {"S1-001": "S2-001"}
    assert out(make()) == empty and out(make(("S1-001", "S1-002", 0.9, 1))) == empty and out(make(("S1-001", "S2-1", 0.1, 0))) == empty
    assert out(make(("S1-001", "S3-200", 0.9, 1), ("S1-001", "S2-100", 0.9, 1), ("S1-001", "S2-100", 0.9, 1)))["S1-001"] == "S2-100,S3-200"
    valid = spark.createDataFrame([("S2-1",)], f"{CAND} string")
    pairs = spark.createDataFrame([("S1-001", "S2-1")], f"{S1} string, {CAND} string")
    both = make(("S1-001", "S2-1", 0.9, 1), ("S1-001", "S2-2", 0.9, 1), ("S1-002", "S2-1", 0.9, 1))
    assert out(both, valid_ids=valid, candidates=pairs) == empty | {"S1-001": "S2-1"}


def test_validator(spark):
    results = lambda *r: spark.createDataFrame(list(r), f"{S1} string, matched_entity_ids string")
    groups = spark.createDataFrame([("S1-001", "S2-001,S3-001"), ("S1-002", "")], f"{S1} string, candidate_entity_ids string")
    both = ids(spark, "S1-001", "S1-002")
    assert decide.validate_output(results(("S1-001", "S2-001"), ("S1-002", "")), groups, both) == []
    assert "missing" in decide.validate_output(results(("S1-001", "S2-001")), groups, both)[0]
    assert len(decide.validate_output(results(("S1-001", "S2-999"), ("S1-002", "")), groups, both)) == 1
    assert decide.validate_output(results(("S1-001", "S2-999"), ("S1-002", "")), None, both) == []
    assert len(decide.validate_output(results(("S1-001", "S1-002,S1-002"), ("S1-001", ""), ("S1-002", "")), groups, both)) == 4


def test_entity_metrics(spark):
    results = spark.createDataFrame([("a", ""), ("b", "x"), ("c", ""), ("d", "a,b"), ("e", "q")], f"{S1} string, matched_entity_ids string")
    truth = spark.createDataFrame([("a", None), ("b", ""), ("c", "x"), ("d", "a"), ("f", "z")], f"{S1} string, matched_entity_ids string")
    rows = {r[S1]: (r.precision, r.recall, r.f0_5) for r in evaluate.entity_scores(results, truth).collect()}
    assert rows["a"] == (1, 1, 1) and rows["b"] == (0, 1, 0) and rows["c"] == (0, 0, 0) and rows["d"] == (0.5, 1, pytest.approx(0.555556, abs=1e-6))
    row = evaluate.macro_f05(results, truth).first()
    assert (row.n_entities, row.n_singletons_total, row.n_singletons_correct, row.n_with_matches_total) == (6, 3, 1, 3)
    assert evaluate.macro_f05(results.limit(0), truth.limit(0)).first().macro_f0_5 == 0.0
    report = evaluate.full_report(results, truth).first()
    assert (report.total_predicted, report.total_true, report.f0_5_max) == (4, 3, 1.0)
    evaluate.print_report(evaluate.full_report(results, truth))


def test_tfidf_cosine(spark):
    rows = spark.createDataFrame([(1, "alpha beta", "alpha beta"), (2, "alpha", "gamma"), (3, "", None), (4, "alpha beta", "beta alpha")], "k int, a string, b string")
    got = dict(features.tfidf_cosine(rows, "a", "b", "k").collect())
    assert got[1] == pytest.approx(1.0) and got[2] == 0.0 and got[3] == 0.0 and 0 < got[4] < 1


def test_models(spark, tmp_path):
    base = {n: 0.0 for n in features.FEATURES}
    data = [(*(base | {"name_jaccard": (i % 10) / 10, "addr_jaccard": (i % 7) / 7}).values(), int(i % 10 > 6)) for i in range(200)]
    rows = spark.createDataFrame(data, [*features.FEATURES, "label"]).repartition(2)
    small = {"random_forest": {"numTrees": 40, "maxDepth": 5}, "gradient_boosting": {"maxIter": 3, "maxDepth": 2}, "logistic_regression": {"maxIter": 50}}
    for name, options in small.items():
        model = models.train(rows, name, Settings(model_options=options))
        scored = models.predict_probability(model, rows)
        good, bad = (scored.filter(f"label = {y}").agg(F.avg("probability")).first()[0] for y in (1, 0))
        assert 0 <= bad < good <= 1
    models.save_model(model, str(tmp_path / "m"))
    assert models.predict_probability(models.load_model(spark, str(tmp_path / "m")), rows).count() == 200
    with pytest.raises(ValueError):
        models.build_model("no such")
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, str(tmp_path / "none"))
