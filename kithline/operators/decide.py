"""From predictions to one validated match list for each S1 record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CAND, PREFIXES, S1
from .candidates import as_lists, grouped, with_all_ids


def match_output(predictions: DataFrame, all_ids: DataFrame, valid_ids: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """source1_entity_id and matched_entity_ids of every id of ``all_ids``.

    Matches have to be S2 or S3 ids, in ``valid_ids`` (candidate_entity_id) and,
    as pairs, in ``candidates`` (pairs, or lists), where these are given.
    """
    kept = predictions.filter("is_match = 1").select(S1, CAND)
    kept = kept.filter(F.col(CAND).startswith(PREFIXES["S2"]) | F.col(CAND).startswith(PREFIXES["S3"]))
    if valid_ids is not None:
        kept = kept.join(valid_ids.select(CAND), CAND, "left_semi")
    if candidates is not None:
        # Matches are few: each record's go to its list, and no pair of a candidate is shuffled.
        mine = kept.groupBy(S1).agg(F.collect_set(CAND).alias("mine"))
        kept = as_lists(candidates).join(mine, S1).select(S1, F.explode(F.array_intersect("mine", "ids")).alias(CAND))
    return with_all_ids(grouped(kept.select(S1, CAND).distinct(), out="matched_entity_ids"), all_ids, "matched_entity_ids")


def _listed(column: str):
    return F.filter(F.split(F.coalesce(column, F.lit("")), ","), lambda x: x != "")


def violations(results: DataFrame, all_ids: DataFrame, candidates_grouped: DataFrame | None = None) -> DataFrame:
    """One row: how many S1 ids or result rows break each rule."""
    rows = results.select(S1, _listed("matched_entity_ids").alias("ids"))
    repeated = results.groupBy(S1).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_rows"))
    missing = all_ids.select(S1).distinct().join(results.select(S1), S1, "left_anti").agg(F.count("*").alias("missing_rows"))
    own = rows.agg(F.count_if(F.exists("ids", lambda x: x.startswith(PREFIXES["S1"]))).alias("s1_in_list"), F.count_if(F.size("ids") != F.size(F.array_distinct("ids"))).alias("duplicate_in_list"))
    parts = [repeated, missing, own]
    if candidates_grouped is not None:
        offered = candidates_grouped.select(S1, _listed("candidate_entity_ids").alias("offered"))
        beyond = rows.join(offered, S1, "left").filter(F.size(F.array_except("ids", F.coalesce("offered", F.array().cast("array<string>")))) > 0)
        parts.append(beyond.agg(F.count("*").alias("not_candidates")))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p)  # one row each
    return out


MESSAGES = {
    "duplicate_rows": "S1 ids with more than one row", "missing_rows": "S1 ids missing from the results", "s1_in_list": "rows that list an S1 id",
    "duplicate_in_list": "rows that list an id twice", "not_candidates": "rows that list an id that is no candidate",
}


def validate_output(results: DataFrame, candidates_grouped: DataFrame | None, all_ids: DataFrame) -> list[str]:
    """A message for each broken rule; none if all is well."""
    found = violations(results, all_ids, candidates_grouped).first().asDict()
    return [f"{found[k]} {text}" for k, text in MESSAGES.items() if found.get(k)]
