"""Normalisation and tokens: golden rows and random strings against plain Python."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from kithline.functions import text as txt


def column(spark, function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r[1] for r in rows.select("i", function(F.col("s")).alias("o")).orderBy("i").collect()]


NAMES = {
    None: "", "": "", "   ": "", "Pelham Corporation": "pelham corp", "PELHAM CORP.": "pelham corp", "Orrery Technology Private Limited": "orrery tech pvt ltd",
    "Orrery Technologies Pvt.Ltd": "orrery tech pvt ltd", "Orrery tech (private) ltd": "orrery tech pvt ltd", "Reed and Marsh": "reed & marsh", "Reed & Marsh": "reed & marsh",
    "\tTern \n Quay  Inc ": "tern quay inc", "नदी किनारा": "नद क न र", "L.L.P. Tern": "l l p tern",
    "T_Q (R) s-u/v & w": "t_q r s-u/v & w", "Heron Pte Limited": "heron pte ltd", "Heron Pte Ltd": "heron pvt ltd", "Wren Llimited": "wren ltd", "Sandy Rand": "sandy rand",
    "Services and Solutions": "services & solutions", "limited² limited": "limited² ltd", "Cafe\u0301": "café",
}


def test_names(spark):
    assert column(spark, txt.normalize_name, NAMES) == list(NAMES.values())


def test_addresses(spark):
    given = {"3 Fen Boulevard, Suite 9": "3 fen blvd ste 9", "3 FEN blvd; STE 9": "3 fen blvd ste 9", "61 Rye Court, Floor 2": "61 rye ct fl 2", None: "", "South-West Avenue": "s-w ave"}
    assert column(spark, txt.normalize_address, given) == list(given.values())


def test_countries_are_an_open_set(spark):
    given = {"PE": "pe", " Norge\n": "norge", "Côte d'Ivoire": "côte d'ivoire", "Nowhere At All": "nowhere at all", None: "", "\t": ""}
    assert column(spark, txt.normalize_country, given) == list(given.values())


def test_ascii_safe_drops_other_scripts(spark):
    assert column(spark, txt.to_ascii_safe, ["Olé", "नदी", "tern", None, "ﬂat"]) == ["Ole", "", "tern", "", "flat"]


def test_tokens_keep_repeats_and_order(spark):
    assert column(spark, txt.tokens, ["b aa b aa ccc", ""]) == [["aa", "aa", "ccc"], []]
    assert column(spark, txt.token_set, ["abc de abc"]) == [["abc"]]


def test_cleaning_equals_plain_python(spark):
    rng = random.Random(1)
    alphabet = "aZé_&/-.,'() \t  　\u001cß²½र́ı\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    clean = lambda s: re.sub(r"\s+", " ", re.sub(r"[^\w\s&/-]", " ", s)).strip()
    assert column(spark, txt.clean_punctuation, texts) == [clean(s) for s in texts]
    assert column(spark, txt.unicode_normalize, texts) == [unicodedata.normalize("NFC", s).strip() for s in texts]


def test_preprocess_keeps_raw_columns(spark):
    rows = spark.createDataFrame([("S1-1", "Tern Corp", None, "PE")], "entity_id string, business_name string, business_address string, country string")
    out = txt.preprocess(rows).first()
    assert (out.business_name, out.business_address, out.name_tokens, out.address_tokens) == ("Tern Corp", "", ["tern", "corp"], [])


@pytest.mark.parametrize("rules", [txt.NAME_RULES, txt.ADDRESS_RULES])
def test_rules_are_settled(rules):
    assert all(a and b for a, b in rules)
