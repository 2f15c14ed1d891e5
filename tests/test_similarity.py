"""Similarity functions at their bounds, and kernels against the plain dynamic programme."""

import random

import pytest
from pyspark.sql import functions as F

from kithline.functions import similarity as sim


def pairs(spark, function, values):
    rows = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, a string, b string")
    return [r[1] for r in rows.select("i", function(F.col("a"), F.col("b")).alias("o")).orderBy("i").collect()]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_edit_kernel_equals_dynamic_programme():
    rng = random.Random(2)
    for _ in range(1500):
        a, b = ("".join(rng.choice("abcé ") for _ in range(rng.randint(1, 25))) for _ in range(2))
        assert sim.edit_ratio(a, b) == pytest.approx(2 * plain_lcs(a, b) / (len(a) + len(b)))


def test_best_window_equals_all_windows():
    rng = random.Random(3)
    ratio = lambda s, w: 2 * plain_lcs(s, w) / (len(s) + len(w))
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 10))) for _ in range(2))
        s, t = sorted((a, b), key=len)
        windows = [t[:i] for i in range(1, len(s))] + [t[i : i + len(s)] for i in range(len(t) - len(s) + 1)] + [t[i:] for i in range(len(t) - len(s), len(t))]
        best = max(ratio(s, w) for w in windows)
        if len(a) == len(b):
            best = max(best, *(ratio(t, w) for w in [s[:i] for i in range(1, len(t))] + [s] + [s[i:] for i in range(1, len(s))]))
        assert sim.best_window(a, b) == pytest.approx(1.0 if a in b or b in a else best)


@pytest.mark.parametrize("together", [sim.TOGETHER, 100])
def test_kernels_of_many_pairs_equal_those_of_one(together, monkeypatch):
    monkeypatch.setattr(sim, "TOGETHER", together)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc é漢\U0001f642") for _ in range(rng.choice([0, 1, 2, 9, 30, 63, 64, 65, 90])))
    given = [(word(), word()) for _ in range(400)] + [("abc", "abc"), ("", ""), ("", "a")]
    assert sim.ratios_of("edit", given) == pytest.approx([sim.edit_ratio(a, b) for a, b in given])
    assert sim.ratios_of("partial", given) == pytest.approx([sim.best_window(a, b) for a, b in given])


GUARDS = [("", "", 1.0), ("a", "", 0.0), ("", "a", 0.0)]


@pytest.mark.parametrize("function", [sim.jaccard, sim.token_overlap, sim.edit_similarity, sim.partial_ratio, sim.token_sort_ratio, sim.positional_ratio])
def test_guards(spark, function):
    assert pairs(spark, function, [g[:2] for g in GUARDS]) == [g[2] for g in GUARDS]


def test_values(spark):
    assert pairs(spark, sim.jaccard, [("a b c", "b c d"), (" ", " "), ("a a", "a")]) == [0.5, 0.0, 1.0]
    assert pairs(spark, lambda a, b: sim.jaccard(a, b, tokenize=False), [("ab", "ba"), ("abc", "bcd")]) == [1.0, 0.5]
    assert pairs(spark, sim.token_overlap, [("a b", "b c d"), ("b c d", "a b")]) == [0.5, pytest.approx(1 / 3)]
    assert pairs(spark, sim.edit_similarity, [("kitten", "sitting"), ("x" * 300, "x" * 200 + "y" * 100)]) == [pytest.approx(8 / 13), 1.0]
    assert pairs(spark, sim.token_sort_ratio, [("b a", "a b")]) == [1.0]
    assert pairs(spark, sim.partial_ratio, [("abc", "xxabcxx"), (None, None)]) == [1.0, 1.0]
    assert pairs(spark, sim.positional_ratio, [("abcd", "abxd")]) == [0.75]
    assert pairs(spark, sim.ngram_overlap, [("ab", "xy"), ("abcd", "ab"), ("abcd", "abcd"), ("abcd", "bcde")]) == [1.0, 0.0, 1.0, pytest.approx(1 / 3)]
    assert pairs(spark, sim.length_difference, [("abcd", "ab"), ("", "")]) == [0.4, 0.0]
    assert pairs(spark, sim.token_count_difference, [("a b c", "a")]) == [0.5]
