"""Operator 13 against brute force, and the prefixes' promise that similar sets meet."""

import random
from collections import Counter

import numpy as np
import pytest
from oracle import compare, duck
from test_duplicates import ODD, brute_near, family, frame, given

from tapeworks.llm import jaccard_join, linking

FOLDER = "/root/testdata/sf0.001"


def boilerplate(n=60, seed=8):
    """Texts that share most of their words with many others, in passages of several lengths."""
    rnd = random.Random(seed)
    passages = [" ".join(f"p{k}w{i}" for i in range(rnd.randint(4, 40))) for k in range(5)]
    out = []
    for i in range(n):
        parts = [rnd.choice(passages) for _ in range(rnd.randint(1, 4))] + [" ".join(f"own{rnd.randrange(400)}" for _ in range(rnd.randint(0, 12)))]
        out.append((7000 + i, "  ".join(parts)))
    return out


@pytest.mark.parametrize("words,percent,often,docs_a_task", [(5, 80, 64, 512), (5, 80, 2, 512), (3, 85, 1, 8), (1, 60, 3, 16), (5, 100, 2, 512)])
def test_groups_equal_brute_force(spark, monkeypatch, words, percent, often, docs_a_task):
    monkeypatch.setattr(jaccard_join, "CLASSES", ((often, 2),))
    monkeypatch.setattr(linking, "GROUP_DOCS", docs_a_task)
    rows = given() + family() + boilerplate() + ODD + [(9100, "q r s t u"), (9101, "q r s t u v"), (9102, "x " * 40_000), (9103, "x " * 50_000)]
    got = jaccard_join.jaccard_groups(frame(spark, rows), words, percent)
    assert sorted(((r._id, r._n, r._component) for r in got.collect()), key=str) == brute_near(rows, words, percent)


@pytest.mark.parametrize("classes", [((0, 2),), ((2, 2),), ((1, 2), (4, 3)), ()])
@pytest.mark.parametrize("percent", [50, 80, 93])
def test_similar_sets_share_a_combination(monkeypatch, classes, percent):
    """Whatever the frequencies: they only order the tokens and choose their classes."""
    monkeypatch.setattr(jaccard_join, "CLASSES", classes)
    rnd = random.Random(percent)
    often = {}
    for _ in range(150):
        base = [rnd.randrange(2**64) for _ in range(rnd.choice([1, 2, 4, 5, 9, 17, 33, 120, 400]))]
        sets = [set(base)]
        for share in (0.02, 0.05, 0.1, 0.2):
            kept = {t for t in base if rnd.random() > share}
            sets.append(kept | {rnd.randrange(2**64) for _ in range(int(len(base) * rnd.random() * share))})
        times = Counter(t for s in sets for t in s)
        for t in times:
            often[t] = rnd.choice([1, 2, 3, 5, 100]) if times[t] == 1 else rnd.choice([2, 3, 5, 100])
        index = [_index(s, percent, often) for s in sets]
        for a in range(len(sets)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and sets[a] != sets[b]:
                    assert index[a] & index[b]


def _index(tokens, percent, often):
    if not tokens:
        return set()
    held = np.bincount([t // jaccard_join.RANGE for t in tokens], minlength=4)
    signed = [(often[t], t - 2**64 if t >= 2**63 else t) for t in tokens if often[t] > 1]
    return set(jaccard_join.combinations(len(tokens), percent, held.tolist(), signed))


def test_combinations_stay_proportional_to_the_document():
    rnd = random.Random(1)
    for size in (5, 50, 500, 5000, 20_000):
        tokens = sorted(rnd.randrange(2**64) for _ in range(size))
        held = np.bincount([t // jaccard_join.RANGE for t in tokens], minlength=4).tolist()
        signed = [(1000, t - 2**64 if t >= 2**63 else t) for t in tokens]
        assert len(list(jaccard_join.combinations(size, 80, held, signed))) <= 4 * size + 10


def test_a_table_without_rows(spark):
    assert jaccard_join.jaccard_groups(frame(spark, [])).count() == 0


def test_the_query_equals_sql(spark):
    assert compare(jaccard_join.op13_jaccard_join(spark, FOLDER), jaccard_join.OP13_SQL, duck(FOLDER)) == []
