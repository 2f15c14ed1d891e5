"""Table layouts, id prefixes and the settings that every stage takes explicitly."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
S1, CAND = "source1_entity_id", "candidate_entity_id"
PREFIXES = {"S1": "S1-", "S2": "S2-", "S3": "S3-"}

SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])
TRUTH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRUTH_COLUMNS])
PAIR_SCHEMA = T.StructType([T.StructField(S1, T.StringType()), T.StructField(CAND, T.StringType())])
CANDIDATE_SCHEMA = T.StructType([*PAIR_SCHEMA.fields, T.StructField("candidate_source", T.StringType())])
PREDICTION_SCHEMA = T.StructType([*PAIR_SCHEMA.fields, T.StructField("probability", T.DoubleType()), T.StructField("is_match", T.IntegerType())])


@dataclass(frozen=True)
class Settings:
    """Defaults are those of the system whose results are matched."""

    strategies: tuple[str, ...] = ("exact_name", "token_name", "tfidf_name", "token_address")
    max_candidates: int | None = 500
    tfidf_top_k: int = 10
    tfidf_ngrams: tuple[int, int] = (2, 3)
    min_block_token: int = 3
    address_min_shared: int = 2
    edit_max_len: int = 200
    model_type: str = "logistic_regression"
    seed: int = 42
    val_fraction: float = 0.15
    stratify: bool = True
    default_threshold: float = 0.5
    threshold: float | None = None
    threshold_min: float = 0.10
    threshold_max: float = 0.95
    threshold_steps: int = 85
    metric: str = "f0_5"
    enforce_candidates: bool = True
    #: Whether quoted cells of the sources may hold line breaks; without, all tasks read a large file.
    multi_line: bool = True
    model_options: dict = field(default_factory=dict)
