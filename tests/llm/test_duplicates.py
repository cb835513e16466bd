"""Operators 2, 4 and 5 against brute force, over odd rows, hot groups and every path of the large cases."""

import collections
import hashlib
import random

import numpy as np
import pytest
from oracle import duck

from tapeworks.llm import exact_heavy, linking, minhash, suffix_dedup
from tapeworks.llm.components import components
from tapeworks.llm.suffix_arrays import Strings

FOLDER = "/root/testdata/sf0.001"
ODD = [(None, "a b c d"), (9000, None), (9001, ""), (9002, " \n"), (9003, "a b"), (9004, "A  b"), (9005, "a"), (9003, "a b"), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, True) for i, t in rows], "doc_id long, text string, _id int, kept boolean")


def given():
    return duck(FOLDER).execute("SELECT doc_id, text FROM documents").fetchall()


def family(n=60, words=120, seed=5, edits=5):
    """Near copies of one text, many of them just under or over the threshold of each other."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"x{rnd.randrange(50)}"
        out.append((5000 + i, " ".join(own)))
    return out


# ---- exact copies


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_groups(spark, counters):
    rows = [(i, rnd) for i, rnd in enumerate(["Hot"] * 40 + ["hOT"] * 20 + ["cold", "Cold", "É", "é", "x" * 50_000] * 2)] + ODD
    got = exact_heavy.exact_groups(frame(spark, rows).repartition(4), counters=counters)
    got = sorted(((r._id, bytes(r._digest).hex(), r._keep, r._size) for r in got.collect()), key=str)
    norm = [(t or "").encode().lower() for _, t in rows]
    want = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        want.append((i, hashlib.sha256(n).hexdigest(), max((j for j in ids if j is not None), default=None), len(ids)))
    assert got == sorted(want, key=str)


def test_dropping_copies_keeps_one_row_and_all_columns(spark):
    rows = [(1, "a"), (2, "A"), (2, "A"), (3, "b"), (None, "b"), (4, None), (5, "")]
    kept = exact_heavy.drop_copies(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "_id", "kept"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "A"), (3, "b"), (5, "")]
    assert exact_heavy.drop_copies(frame(spark, [])).count() == 0


def test_summaries_keep_what_is_frequent():
    rnd = random.Random(1)
    stream = [b"hot"] * 400 + [bytes([rnd.randrange(256), rnd.randrange(256)]) for _ in range(600)]
    rnd.shuffle(stream)
    summary = collections.Counter()
    for at in range(0, 1000, 50):
        summary = exact_heavy.fold(summary, collections.Counter(stream[at:at + 50]), 4)
    assert len(summary) <= 4 and 400 - 1000 / 5 <= summary[b"hot"] <= 400


# ---- near copies


def brute_near(rows, words, percent):
    told = [(t or "").encode().lower().split() for _, t in rows]
    sets = [{tuple(w[j:j + words]) for j in range(max(1, len(w) - words + 1))} if w else set() for w in told]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, left in enumerate(sets):
        for b, right in enumerate(sets[:a]):
            both = len(left & right)
            if both and 100 * both >= percent * (len(left) + len(right) - both):
                root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)].append(i)
    return sorted(((i, len(s), min(least[find(a)], default=None)) for a, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("words,percent,docs_a_task", [(3, 85, 512), (5, 80, 7), (3, 85, 16)])
def test_near_groups(spark, monkeypatch, words, percent, docs_a_task):
    monkeypatch.setattr(linking, "GROUP_DOCS", docs_a_task)
    rows = given() + family() + ODD
    got = minhash.near_groups(frame(spark, rows), words, percent)
    assert sorted(((r._id, r._n, r._component) for r in got.collect()), key=str) == brute_near(rows, words, percent)


def test_near_groups_of_nothing(spark):
    assert minhash.near_groups(frame(spark, [])).count() == 0
    assert minhash.drop_near(frame(spark, [(1, ""), (2, None)])).count() == 2


def test_bands_find_pairs_at_the_threshold():
    for percent in (80, 85, 95):
        rows = minhash.rows_per_band(percent)
        assert (1 - (percent / 100) ** rows) ** (minhash.COORDINATES // rows) <= minhash.MISS


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 60, 60))
        one, two = (minhash.signature(np.concatenate([shared, x])) for x in (a, b))
        errors.append((one == two).mean() - 300 / 420)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_the_second_permutation_is_one_and_shifts_go_round():
    values = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65_537)
    assert len(np.unique(minhash._permute(values.copy()))) == len(values)
    zero = minhash.signature(np.array([0], np.uint64), 4)
    ranked = np.arange(4, dtype=np.uint32) * np.uint32(0xFFFFFFFF)  # 0 - k, round the end
    assert (zero == minhash._permute(ranked + np.uint32(0x9E3779B9))).all()


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300 + rnd.randrange(40), 300 + rnd.randrange(40)) for _ in range(30)]
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r._node: r._root for r in components(spark.createDataFrame(pairs, "_a long, _b long")).collect()}
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in pairs)}


def test_a_long_chain_takes_few_rounds(spark):
    rounds = []
    pairs = spark.range(1000).selectExpr("id AS _a", "id + 1 AS _b")
    assert components(pairs, rounds).filter("_root != 0").count() == 0
    assert len(rounds) + sum(rounds) < 15
    rounds.clear()
    zigzag = [(i, 2000 - i) for i in range(400)] + [(2000 - i, i + 1) for i in range(400)]
    assert components(spark.createDataFrame(zigzag, "_a long, _b long"), rounds).filter("_root != 0").count() == 0
    assert len(rounds) + sum(rounds) < 20


def test_texts_of_a_large_family_are_shipped_a_bounded_number_of_times(spark, monkeypatch):
    monkeypatch.setattr(linking, "GROUP_DOCS", 8)
    rows = family(n=200, edits=3)
    sent = []

    def watched(df, make, schema, **given):
        if make.__name__ in ("_settle_families", "_follow_leaders", "_link_blocks"):
            sent.append((make.__name__, df.count()))
        return map_batches(df, make, schema, **given)

    map_batches = linking.map_batches
    monkeypatch.setattr(linking, "map_batches", watched)
    got = minhash.near_groups(frame(spark, rows), 3, 85)
    assert sorted(((r._id, r._n, r._component) for r in got.collect()), key=str) == brute_near(rows, 3, 85)
    assert sum(n for _, n in sent) < 200 * 2, sent  # a text each, and the leaders'


# ---- repeated byte strings


def brute_spans(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(r[p:p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws):
        cover = np.zeros(len(r) + 1, int)
        for p in range(len(r) - length + 1):
            if seen[r[p:p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(r), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def passages(n=200, seed=4):
    rnd = random.Random(seed)

    def text(size):
        return "".join(rnd.choice("abcdé 漢") for _ in range(size))

    hot, shared = text(30), [text(rnd.randint(10, 60)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = (rnd.choice([text(rnd.randint(0, 40)), rnd.choice(shared), hot, rnd.choice(shared)[:20]]) for _ in range(rnd.randint(0, 5)))
        rows.append((i, "".join(parts)))
    return rows + [
        (500, rows[5][1]), (501, rows[5][1]), (600, None), (601, ""), (602, "a" * 200), (None, rows[7][1]), (5, rows[9][1]),
        (None, f"zz{hot}yyq"), (None, f"zz{hot}yyq"), (603, "ab" * 90 + hot),
    ]


@pytest.mark.parametrize("length,gram,shard,buffer", [(16, 8, 300, 1 << 20), (16, 8, 1 << 20, 1 << 20), (24, 16, 500, 50)])
def test_repeats(spark, monkeypatch, length, gram, shard, buffer):
    monkeypatch.setattr(suffix_dedup, "BUFFER_BYTES", buffer)
    rows = passages()
    got = suffix_dedup.remove_repeats(frame(spark, rows), length, gram, shard, with_text=True).collect()
    told = [(r._id, r._size, r._removed, len(r._spans), bytes(r._kept_sha).hex()) for r in got]
    assert sorted(told, key=str) == brute_spans(rows, length)
    for r in got:
        assert sum(s.end - s.start for s in r._spans) == r._removed
        assert r._kept is None or hashlib.sha256(bytes(r._kept)).hexdigest() == bytes(r._kept_sha).hex()


def test_repeats_of_the_given_documents(spark):
    rows = given()
    got = suffix_dedup.remove_repeats(frame(spark, rows), shard_bytes=4000).collect()
    assert sorted(((r._id, r._size, r._removed, len(r._spans), bytes(r._kept_sha).hex()) for r in got), key=str) == brute_spans(rows, 400)


def test_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(frame(spark, []), length=120, gram=16)


def test_suffix_arrays_and_common_prefixes():
    rnd = random.Random(2)
    for turn in range(120):
        strings = [bytes(rnd.choice(b"ab\x00\xf4" if turn % 2 else b"a") for _ in range(rnd.randint(1, 40))) for _ in range(rnd.randint(1, 12))]
        laid = Strings(strings)
        order, rank = laid.suffix_array()
        common = laid.common_prefixes(order, rank)
        plain = sorted(
            ([x + 1 for x in s[k:]] + [0], i, int(laid.starts[i]) + k) for i, s in enumerate(strings) for k in range(len(s) + 1)
        )
        assert [p[2] for p in plain] == order.tolist()
        for at in range(1, len(plain)):
            a, b = plain[at - 1][0][:-1], plain[at][0][:-1]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[at] == same


def test_merging_pieces_finds_what_two_have():
    rng = np.random.default_rng(3)
    pieces = []
    for number in range(5):
        piece = np.zeros(50, suffix_dedup._PIECE)
        values = rng.choice(80, 50, replace=False)
        piece["low"], piece["high"], piece["segment"], piece["at"] = values // 3, values % 3, number, values
        pieces.append(np.sort(piece, order=["low", "high"]))
    counts = collections.Counter(v for p in pieces for v in p["at"].tolist())
    rows = {"_a": [7] * 5, "_range": [0] * 5, "_piece": [p.tobytes() for p in pieces]}
    import pyarrow as pa

    out = list(suffix_dedup._merges(iter([{k: pa.array(v) for k, v in rows.items()}])))[0]
    got = sorted((h, a) for h, low, high in zip(out["_h"], out["_from"], out["_to"]) for a in range(low, high))
    assert got == sorted((n, v) for n, p in enumerate(pieces) for v in p["at"].tolist() if counts[v] > 1)
