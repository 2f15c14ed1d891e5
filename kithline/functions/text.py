"""Normalisation of names, addresses and countries, and their tokens, as column expressions.

Only Unicode composition needs Python: texts without a character beyond ASCII
reach the Arrow function as nulls and stay as they are.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: White space as Python's ``str.strip`` and ``\s`` have it, for use inside brackets.
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_NO_WORD_BEFORE, _NO_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"

# Word rules that must equal those of the matched system, in order.
NAME_RULES = [
    ("private limited", "pvt ltd"), ("pvt ltd", "pvt ltd"), ("private ltd", "pvt ltd"), ("pte ltd", "pvt ltd"),
    ("llimited", "ltd"), ("limited", "ltd"), ("ltd", "ltd"), ("llp", "llp"), ("llc", "llc"),
    ("incorporated", "inc"), ("inc", "inc"), ("corporation", "corp"), ("corp", "corp"), ("company", "co"), ("and", "&"),
    ("enterprises", "enterprises"), ("enterprise", "enterprise"), ("services", "services"), ("solutions", "solutions"),
    ("technologies", "tech"), ("technology", "tech"),
]
ADDRESS_RULES = [
    ("road|rd", "rd"), ("street|st", "st"), ("avenue|ave", "ave"), ("boulevard|blvd", "blvd"), ("drive|dr", "dr"), ("lane|ln", "ln"),
    ("court|ct", "ct"), ("place|pl", "pl"), ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w"),
    ("northeast", "ne"), ("northwest", "nw"), ("southeast", "se"), ("southwest", "sw"), ("suite|ste", "ste"), ("apartment|apt", "apt"),
    ("floor|fl", "fl"), ("building|bldg", "bldg"), ("block|blk", "blk"), ("nagar|ngr", "ngr"), ("marg", "marg"), ("colony|col", "col"),
]


@pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFC")


@pandas_udf(StringType())
def _ascii(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def _where_not_ascii(col: Column, function) -> Column:
    return F.coalesce(function(F.when(col.rlike(r"[^\x00-\x7F]"), col)), col)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^[{WS}]+|[{WS}]+$", "")


def collapse(col: Column) -> Column:
    return F.regexp_replace(col, f"[{WS}]+", " ")


def unicode_normalize(col: Column) -> Column:
    """Canonical composition, then white space stripped at both ends."""
    return strip(_where_not_ascii(col, _nfc))


def to_ascii_safe(col: Column) -> Column:
    """Compatibility decomposition without what is not ASCII."""
    return _where_not_ascii(F.coalesce(col, F.lit("")), _ascii)


def clean_punctuation(col: Column) -> Column:
    """All but word characters, white space and ``& / -`` become spaces; runs of spaces become one."""
    return F.trim(collapse(F.regexp_replace(col, rf"[^\p{{L}}\p{{N}}_&/\-{WS}]", " ")))


def _normal(col: Column, rules: list[tuple[str, str]]) -> Column:
    start = clean_punctuation(F.lower(unicode_normalize(F.coalesce(col, F.lit("")))))
    apply = lambda c, r: F.regexp_replace(c, f"(?iu){_NO_WORD_BEFORE}(?:{r[0]}){_NO_WORD_AFTER}", r[1])
    return F.trim(collapse(reduce(apply, rules, start)))


def normalize_name(col: Column) -> Column:
    return _normal(col, NAME_RULES)


def normalize_address(col: Column) -> Column:
    return _normal(col, ADDRESS_RULES)


def normalize_country(col: Column) -> Column:
    """Stripped and lower-cased; countries are an open set."""
    return F.lower(strip(F.coalesce(col, F.lit(""))))


def tokens(col: Column, min_length: int = 2) -> Column:
    """White-space tokens of at least ``min_length`` characters, in order, with repeats."""
    return F.filter(F.split(col, " "), lambda t: F.length(t) >= max(1, min_length))


def token_set(col: Column, min_length: int = 3) -> Column:
    return F.array_distinct(tokens(col, min_length))


def preprocess(source: DataFrame) -> DataFrame:
    """A source with missing values as empty strings, normalised columns and token columns beside the raw ones."""
    raw = [c for c in ("business_name", "business_address", "country") if c in source.columns]
    filled = source.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in raw})
    normal = filled.withColumns({
        "business_name_normalized": normalize_name(F.col("business_name")),
        "business_address_normalized": normalize_address(F.col("business_address")),
        "country_normalized": normalize_country(F.col("country")),
    })
    return normal.withColumns({"name_tokens": tokens(F.col("business_name_normalized")), "address_tokens": tokens(F.col("business_address_normalized"))})


def preprocess_all(s1: DataFrame, s2: DataFrame, s3: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return preprocess(s1), preprocess(s2), preprocess(s3)
