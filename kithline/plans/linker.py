"""Training, evaluation and prediction as plans over the operators."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import preprocess, preprocess_all
from ..operators import candidates as cand
from ..operators import decide, evaluate, models, thresholds
from ..operators.features import extract
from ..operators.labels import create_split, label_pairs
from ..schema import CAND, S1, TRUTH_COLUMNS, Settings
from ..sources import tsv

log = logging.getLogger("kithline")


@dataclass(frozen=True)
class Paths:
    """Where tables are read and results are written."""

    s1: str
    s2: str
    s3: str
    truth: str = ""
    model: str = "models/model"
    threshold: str = "models/threshold.json"
    results: str = "output/matching_results.tsv"
    candidates: str = "output/candidate_pairs.tsv"


@dataclass(frozen=True)
class Prediction:
    results: DataFrame
    candidates: DataFrame
    scored: DataFrame


class Linker:
    """Fits, evaluates and applies a linkage; tables go in and out as DataFrames."""

    def __init__(self, spark: SparkSession, settings: Settings | None = None, model: PipelineModel | None = None, threshold: float | None = None):
        self.spark, self.settings, self.model = spark, settings or Settings(), model
        self.threshold = self.settings.threshold if threshold is None else threshold

        self._held: list[DataFrame] = []

    def _kept(self, df: DataFrame) -> DataFrame:
        self._held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self._held[-1]

    def release(self) -> None:
        """Unpersist what this linker keeps; results that are still to be read would be computed again."""
        while self._held:
            self._held.pop().unpersist()

    def _pairs(self, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
        """Candidates as lists."""
        return self._kept(cand.generate_lists(s1, s2, s3, self.settings.strategies, self.settings))

    def score(self, pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
        """Pairs (or lists) with probability and is_match; features are made as they are read, those that the model reads alone, and not kept."""
        if self.model is None:
            raise ValueError("fit or load a model first")
        scored = models.predict_probability(self.model, extract(pairs, s1, pool, self.settings)).select(S1, CAND, "probability")
        return thresholds.apply_threshold(scored, self.settings.default_threshold if self.threshold is None else self.threshold)

    def fit(self, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame) -> dict:
        """Train on the larger part of the S1 entities and tune the threshold on the rest, unless one is given."""
        began, s = time.time(), self.settings
        parts = create_split(s1, truth, s.val_fraction, s.seed, s.stratify)
        train, two, three = map(self._kept, preprocess_all(parts.s1_train, s2, s3))
        val, pool = self._kept(preprocess(parts.s1_val)), two.unionByName(three)
        pairs = self._pairs(train, two, three)
        covered = evaluate.candidate_recall(pairs, parts.truth_train).first()["candidate_recall"]
        labelled = label_pairs(extract(pairs, train, pool, s), parts.truth_train)
        self.model = models.train(self._kept(labelled), s.model_type, s)
        val_pairs = self._pairs(val, two, three)
        scored = models.predict_probability(self.model, self._kept(label_pairs(extract(val_pairs, val, pool, s), parts.truth_val))).select(S1, CAND, "label", "probability")
        tuned, pair_figures = thresholds.tune(self._kept(scored), s)
        self.threshold = tuned if s.threshold is None else s.threshold
        results = decide.match_output(thresholds.apply_threshold(scored, self.threshold), cand.s1_ids(val), None, val_pairs if s.enforce_candidates else None)
        figures = evaluate.macro_f05(results, parts.truth_val).first().asDict() | {f"pair_{k}": v for k, v in pair_figures.items()}
        self.release()
        return {"model": self.model, "threshold": self.threshold, "val_metrics": figures, "candidate_recall_train": covered, "elapsed_seconds": time.time() - began}

    def evaluate(self, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame) -> dict:
        """Entity figures and candidate recall on the split's smaller part."""
        s = self.settings
        parts = create_split(s1, truth, s.val_fraction, s.seed, s.stratify)
        val, two, three = map(self._kept, preprocess_all(parts.s1_val, s2, s3))
        pairs = self._pairs(val, two, three)
        results = decide.match_output(self.score(pairs, val, two.unionByName(three)), cand.s1_ids(val), None, pairs if s.enforce_candidates else None)
        report = evaluate.full_report(results, parts.truth_val, pairs).first().asDict()
        self.release()
        return report

    def predict(self, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> Prediction:
        """Match lists of all S1 records; ``RuntimeError`` if they break a rule.

        Call :meth:`release` when the result has been read.
        """
        one, two, three = map(self._kept, preprocess_all(s1, s2, s3))
        pool = two.unionByName(three)
        pairs = self._pairs(one, two, three)
        scored, ids = self.score(pairs, one, pool), cand.s1_ids(one)
        valid = pool.select(F.col("entity_id").alias(CAND))
        results = self._kept(decide.match_output(scored, ids, valid, pairs if self.settings.enforce_candidates else None))
        groups = self._kept(cand.with_all_ids(cand.grouped(pairs), ids))
        broken = decide.validate_output(results, groups, ids)
        if broken:
            raise RuntimeError("; ".join(broken))
        return Prediction(results, groups, scored)


def run_train(spark: SparkSession, paths: Paths, settings: Settings | None = None) -> dict:
    linker = Linker(spark, settings)
    out = linker.fit(*tsv.load_train_data(spark, paths.s1, paths.s2, paths.s3, paths.truth, linker.settings.multi_line))
    models.save_model(linker.model, paths.model)
    tsv.save_threshold(spark, linker.threshold, paths.threshold)
    return out


def _loaded(spark: SparkSession, paths: Paths, settings: Settings) -> Linker:
    stored = tsv.load_threshold(spark, paths.threshold, settings.default_threshold)
    return Linker(spark, settings, models.load_model(spark, paths.model), stored if settings.threshold is None else settings.threshold)


def run_validate(spark: SparkSession, paths: Paths, settings: Settings | None = None) -> dict:
    settings = settings or Settings()
    return _loaded(spark, paths, settings).evaluate(*tsv.load_train_data(spark, paths.s1, paths.s2, paths.s3, paths.truth, settings.multi_line))


def run_predict(spark: SparkSession, paths: Paths, settings: Settings | None = None) -> DataFrame:
    settings = settings or Settings()
    linker = _loaded(spark, paths, settings)
    found = linker.predict(*tsv.load_test_data(spark, paths.s1, paths.s2, paths.s3, settings.multi_line))
    tsv.write_matching_results(found.results, paths.results)
    tsv.write_candidate_pairs(found.candidates, paths.candidates)
    linker.release()
    return tsv.read_tsv(spark, paths.results, TRUTH_COLUMNS, multi_line=False).fillna("")


def run_all(spark: SparkSession, train: Paths, test: Paths, settings: Settings | None = None) -> DataFrame:
    """Training, then prediction with what it stored."""
    run_train(spark, train, settings)
    return run_predict(spark, replace(test, model=train.model, threshold=train.threshold), settings)
