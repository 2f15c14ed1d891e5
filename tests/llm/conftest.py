import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Documents of (doc_id, text), with the columns of the table."""
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies, odd white space and added tokens."""
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "Kabé" for b in "oru" for c in ("n", "st", "ß", "漢")] + ["the", "of"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (0, base), (1, None), (2, ""), (3, " \t\n"), (4, base), (5, "one"), (6, "one two three"), (7, " ".join(near)), (8, "a  b\r\nc d　e\x1cf"),
        (9, "<|endoftext|> x<|startoftext|>Y <|STARTOFTEXT|>"), (10, text(30000)), (11, "lo " * 400), (12, base + "\n" + text(50) + "\n" + base), (13, "x" * 9000),
        (14, "*** $$$ %%% &&& ||| <<< >>> ### " * 10), (15, "same line\nsame line\n\nsame line\nother"), (16, "don't WE'LL 'tis ''s I'm J̌ ½² \U0001f642"),
        (17, text(200)), (17, text(40)), (18, "one two three"), (18, "one two three"), (20, text(19)), (21, text(20)), (22, base.upper()),
    ]
    return rows + [(100 + i, text(rng.randint(1, 80))) for i in range(40)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
