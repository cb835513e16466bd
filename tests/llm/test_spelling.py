"""Operator 11 against brute force over all pairs of words."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from oracle import duck

from tapeworks.llm import spelling

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, word string, n int, form boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, True) for i, t in rows], SCHEMA)


def variants(n=400, seed=3):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(6, 9))) for _ in range(12)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 30)):
            word = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
                at = rnd.randrange(len(word))
                word[at:at + 1] = rnd.choice(["", "e", "É", "xa", "÷"])
            words.append("".join(word))
        out.append((i, rnd.choice([" ", "-", "1"]).join(words)))
    return out


LONG = "a" * 300
ODD = [
    (None, "Strasse strasses " * 2), (None, "strasse"), (900, None), (901, ""), (902, "12 34"), (903, "MÜLLERIN müllerin MÜllerin"), (904, LONG + " " + LONG), (905, LONG + " " + LONG + "b " + LONG + "b"),
    (906, "x" + LONG + " x" + LONG), (903, "MÜLLERIN müllerin MÜllerin"), (907, "aaaaaaa " * 20_000), (908, "aaaaaab aaaaaab aaaaaaaa aaaaaaaa"), (909, "listens silents enlists tinsels listens silents enlists tinsels"),
]


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in spelling.RUN.findall(text or ""):
            run = run.translate(spelling.UPPER)
            hashed = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if hashed % 31 == 0:
                at = hashed % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    holes, cut = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            holes[k, w[:k] + w[k + 1:]].add(w)
            cut[w[:k] + w[k + 1:]].add(w)
    near = defaultdict(set)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for w in counts:
        for v in cut.get(w, ()):
            near[w].add(v)
            near[v].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


@pytest.mark.parametrize("most", [50_000, 40, 2])
def test_groups_equal_brute_force(spark, most):
    rows = variants() + ODD
    got = spelling.spelling_groups(frame(spark, rows).repartition(5), most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(r[1] for r in want) and any(r[2] != r[0] and r[2] != r[1] for r in want + [("a", "b", "c")])


def test_the_query_on_the_smallest_tables(spark):
    rows = duck(FOLDER).execute("SELECT doc_id, text FROM documents").fetchall()
    assert sorted(tuple(r) for r in spelling.op11_spelling(spark, FOLDER).collect()) == brute(rows)


def test_a_table_without_rows_or_words(spark):
    assert spelling.spelling_groups(frame(spark, [])).count() == 0
    assert spelling.spelling_groups(frame(spark, [(1, None), (2, "a b")])).count() == 0


def test_chains_of_forms_end_at_the_last(spark):
    pairs = [(f"w{i}", f"w{i + 1}") for i in range(19)]
    ends = {r.word: r._end for r in spelling._ends(spark.createDataFrame(pairs, "word string, form string")).collect()}
    assert ends == {f"w{i}": "w19" for i in range(19)}


def test_one_edit():
    rnd = random.Random(1)
    words = ["", "a", "b", "ab", "ba", "aa", "aab", "aba", "abab", "baba", "aaaa", "aaaaa"] + ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    pairs = [(a, b) for a in words for b in words]
    want = [a != b and b in {a[:i] + x + a[i + k:] for i in range(len(a) + 1) for k in (0, 1) for x in ("", "a", "b") if x or k} for a, b in pairs]
    assert [spelling.one_edit(a, b) for a, b in pairs] == want
    (x, n), (y, m) = (spelling.letters_of([p[k] for p in pairs]) for k in (0, 1))
    at = [i for i in range(len(pairs)) if abs(n[i] - m[i]) <= 1]
    assert spelling.one_edit_rows(x[at], n[at], y[at], m[at]).tolist() == [want[i] for i in at]
