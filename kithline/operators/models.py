"""Pair classifiers on Spark ML."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import Settings
from ..sources.tsv import exists
from .features import FEATURES

COMMON = {"labelCol": "label", "probabilityCol": "probability_vector", "rawPredictionCol": "raw", "predictionCol": "predicted"}


def _assembled(out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol=out)


def _logistic(n: int, settings: Settings) -> Pipeline:
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    options = {"regParam": 1.0 / max(1, n), "elasticNetParam": 0.0, "standardization": False, "weightCol": "weight", "maxIter": 1000} | settings.model_options
    return Pipeline(stages=[_assembled("raw_features"), scaler, LogisticRegression(**COMMON, **options)])


def _forest(n: int, settings: Settings) -> Pipeline:
    options = {"numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 5, "featureSubsetStrategy": "sqrt", "weightCol": "weight", "seed": settings.seed} | settings.model_options
    return Pipeline(stages=[_assembled(), RandomForestClassifier(**COMMON, **options)])


def _boosting(n: int, settings: Settings) -> Pipeline:
    common = {k: v for k, v in COMMON.items() if k not in ("probabilityCol", "rawPredictionCol")}
    options = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 8, "seed": settings.seed} | settings.model_options
    model = GBTClassifier(**common, **options)
    model.setProbabilityCol("probability_vector").setRawPredictionCol("raw")
    return Pipeline(stages=[_assembled(), model])


MODELS: dict[str, Callable[[int, Settings], Pipeline]] = {"logistic_regression": _logistic, "random_forest": _forest, "gradient_boosting": _boosting}


def register_model(name: str, factory: Callable[[int, Settings], Pipeline]) -> None:
    MODELS[name] = factory


def build_model(model_type: str | None = None, n: int = 1, settings: Settings | None = None) -> Pipeline:
    """An unfitted pipeline for ``n`` training rows."""
    settings = settings or Settings()
    name = settings.model_type if model_type is None else model_type
    if name not in MODELS:
        raise ValueError(f"unknown model {name}; known: {sorted(MODELS)}")
    return MODELS[name](n, settings)


def balanced(labelled: DataFrame) -> tuple[DataFrame, int]:
    """Rows with ``weight`` n / (2 n_class), and n."""
    counts = {int(r[0]): r[1] for r in labelled.groupBy("label").count().collect()}
    n = sum(counts.values())
    weight = F.when(F.col("label") == 1, n / (2 * max(1, counts.get(1, 0)))).otherwise(n / (2 * max(1, counts.get(0, 0))))
    return labelled.withColumn("weight", F.lit(weight)).withColumn("label", F.col("label").cast("double")), n


def train(labelled: DataFrame, model_type: str | None = None, settings: Settings | None = None) -> PipelineModel:
    rows, n = balanced(labelled)
    return build_model(model_type, n, settings).fit(rows)


def predict_probability(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` with ``probability``, that of a match."""
    scored = model.transform(features)
    return scored.select(*features.columns, F.get(vector_to_array("probability_vector"), F.lit(1)).alias("probability"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not exists(spark, path):
        raise FileNotFoundError(f"no model at {path}; train first")
    return PipelineModel.load(path)
