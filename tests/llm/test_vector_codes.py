"""Operator 12 against plain Lloyd rounds in Python's integers, and its trees against all distances."""

import math
import random

import numpy as np
import pytest
from oracle import compare, duck

from tapeworks.llm import vector_codes as V

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, code string, _label string, error int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "c", "l", 1) for i, v, x in rows], SCHEMA)


def brute(rows, parts, entries, rounds, scale=4096):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    width = -(-len(kept[0][1]) // parts)
    whole = [[n * scale // d for n, d in (float(x).as_integer_ratio() for x in r[1])] + [0] * (width * parts - len(r[1])) for r in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in whole]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def away(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign(p, own):
        return min(range(len(books[p])), key=lambda k: (away(own, books[p][k]), k))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(assign(p, v[p]), []).append(v[p])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out = []
    for (i, _, label), v in zip(kept, cut):
        codes = [assign(p, v[p]) for p in range(parts)]
        error = sum(away(v[p], books[p][k]) for p, k in enumerate(codes))
        out.append((i, label, bytes(codes).hex(), error))
    return [(i, None if label is None else str(label), c, e if e < 1 << 63 else None) for i, label, c, e in out], books


def vectors(n, width, seed, spread=1.0):
    rnd = random.Random(seed)
    centers = [[rnd.uniform(-1, 1) for _ in range(width)] for _ in range(9)]
    return [(i, [c + spread * rnd.gauss(0, 0.2) for c in rnd.choice(centers)], rnd.choice([None, 1, 2])) for i in range(n)]


ODD = [
    (None, [0.5] * 6, 1), (9001, None, 1), (9002, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (9003, [float("nan")] * 6, 1), (9004, [float("inf")] * 6, 2), (9005, [], 1), (9006, [1.0], None),
    (3, [0.25] * 6, 2), (3, [0.25] * 6, 2), (9007, [-0.0001] * 6, 2), (9008, [1 / 4096, 2 / 4096, -1 / 4096, 0.0, 0.0, 0.0], None),
]


@pytest.mark.parametrize("rows,parts,entries", [
    (vectors(300, 6, 1) + ODD, 3, 5), (vectors(120, 7, 2), 2, 16), (vectors(3, 4, 3), 2, 16), ([(i, [0.5, 0.5], 1) for i in range(200)], 2, 4),
    (vectors(80, 4, 4) + [(500, [1e10, -1e12, 5000.0, 0.1], 1), (501, [3e38, 1.0, -3e38, 0.1], 1), (502, [1e10, -1e12, 5001.0, 0.1], 1)], 2, 6),
])
def test_codes_equal_plain_rounds(spark, rows, parts, entries, monkeypatch):
    monkeypatch.setattr(V, "LEAF", 3)
    codes, books = V.compress(frame(spark, rows).repartition(3), parts=parts, entries=entries, rounds=4)
    want, want_books = brute(rows, parts, entries, 4)
    assert books == want_books
    assert sorted((tuple(r) for r in codes.select("vec_id", "_label", "code", "error").collect()), key=str) == sorted(want, key=str)


def test_tables_without_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")], 1)]):
        codes, books = V.compress(frame(spark, rows))
        assert codes.count() == 0 and books == [[]] * 8
        assert V.with_label_errors(codes).count() == 0


def test_label_errors_of_nulls_and_hot_labels(spark):
    codes = spark.createDataFrame([(i, x, "00", 2) for i, x in enumerate([None, None, "a", "a", "a", "b"])], "vec_id long, _label string, code string, error long")
    got = {r.vec_id: r.label_error for r in V.with_label_errors(codes).collect()}
    assert got == {0: 4, 1: 4, 2: 6, 3: 6, 4: 6, 5: 2}


@pytest.mark.parametrize("seed", range(6))
def test_balls_hold_their_points_and_owners_are_the_nearest(seed):
    rnd = np.random.default_rng(seed)
    points = rnd.integers(-50, 50, (rnd.integers(1, 900), rnd.integers(1, 9)))
    if seed % 2:
        points = np.concatenate([points, np.repeat(points[:1], 200, axis=0), points[:40] * 30])
    tree = V.Tree(points)
    assert sorted(tree.order) == list(range(len(points))) and tree.high[-1] - tree.low[-1] == len(points)
    for ball in range(len(tree.left)):
        own = points[tree.order[tree.low[ball]:tree.high[ball]]]
        assert (tree.total[ball] == own.sum(axis=0)).all() and (np.sqrt(((own - tree.center[ball]) ** 2).sum(axis=1)) <= tree.radius[ball] + 1e-9).all()
    entries = points[rnd.integers(0, len(points), 7)]
    got, owned = np.full(len(points), -1), 0
    for what, entry in tree.settle_entries(entries, points):
        for ball, k in zip(what[what >= 0], entry[what >= 0]):
            rows = tree.order[tree.low[ball]:tree.high[ball]]
            assert (got[rows] == -1).all()
            got[rows], owned = k, owned + len(rows)
        assert (got[~what[what < 0]] == -1).all()
        got[~what[what < 0]] = entry[what < 0]
    want = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (got == want).all()


def test_balls_of_clusters_are_owned_whole():
    rnd = np.random.default_rng(1)
    centers = rnd.integers(-1000, 1000, (16, 4))
    points = centers[rnd.integers(0, 16, 4000)] + rnd.integers(-5, 5, (4000, 4))
    tree = V.Tree(points)
    balls = [b for what, _ in tree.settle_entries(centers, points) for b in what[what >= 0]]
    assert sum(tree.high[balls] - tree.low[balls]) > 3500 and len(balls) < 400


def test_digits_add_up():
    for x in (0, 5, -5, 1 << 40, -(1 << 90) - 3, 10**50):
        assert sum(d << 40 * j for j, d in enumerate(V.limbs(x))) == x


def test_the_query_equals_sql(spark):
    assert compare(V.op12_vector_codes(spark, FOLDER), V.OP12_SQL, duck(FOLDER)) == []
