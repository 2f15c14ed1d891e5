"""Near duplicates by verified Jaccard similarity against brute force."""

import random

from kithline.llm import simhash_similar

from .conftest import frame
from .test_texts import WORD, fingerprint


def shingle_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def smallest_linked(rows):
    """Of (id, text) rows: the smallest id reachable over pairs of similarity 0.8 or more."""
    sets, least = {i: shingle_set(t) for i, t in rows}, {}
    for i in sorted(sets):
        if i in least:
            continue
        todo, least[i] = [i], i
        while todo:
            j = todo.pop()
            near = [k for k in sets if k not in least and alike(sets[j], sets[k])]
            least |= dict.fromkeys(near, i)
            todo += near
    return least


def varied():
    """Texts with some words replaced, so that similarities lie on both sides of 0.8."""
    rng, rows = random.Random(3), []
    for g in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([8, 40, 200, 600]))]
        for _ in range(8):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randrange(0, 1 + len(words) // 20)):
                words[at] = f"n{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(words)))
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "one two"), (len(rows) + 3, "One  TWO")]


def test_near_copies_beyond_4_bits_are_linked(spark):
    rows = varied()
    least = smallest_linked(rows)
    far = [i for i, t in rows if least[i] != i and all((fingerprint(t) ^ fingerprint(u)).bit_count() > 4 for j, u in rows if j < i and least[j] == least[i])]
    assert len(far) >= 5  # the radius of op8 leaves these as documents of their own
    kept = simhash_similar.one_of_each(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_close_fingerprints_alone_do_not_link(spark, odd_rows, empty, odd):
    rows = [(1000 * n + i, t) for n, (i, t) in enumerate(odd_rows)]
    kept = simhash_similar.one_of_each(frame(spark, rows))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(smallest_linked(rows).values()))
    assert simhash_similar.one_of_each(empty).count() == 0
