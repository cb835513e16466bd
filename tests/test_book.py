import random

import pytest
from helpers import as_dicts, at

from tapeworks.functions.timecols import HOUR, MINUTE, SECOND, micros
from tapeworks.operators import book
from tapeworks.operators.chunks import measure
from pyspark.sql import functions as F

SCHEMA = "symbol string, ts timestamp, seq long, part int, kind string, side string, price double, size double"


def feed(spark, rows):
    """Rows of (seconds, seq, kind, side, price, size) for one symbol."""
    data = [("X", at(t), q, i, k, s, float(p), float(z)) for i, (t, q, k, s, p, z) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def levels(df):
    return {(r["bucket"] // SECOND % 60, r["side"], r["price"]): r["size"] for r in as_dicts(df, "bucket")}


def random_changes(n=300, prices=30, seed=4):
    rnd, rows, seq = random.Random(seed), [], 0
    while len(rows) < n:
        seq += 1
        t = round(seq * 17.3, 3)
        if rnd.random() < 0.02:
            rows += [(t, seq, "snapshot", s, rnd.randint(1, prices) + off * prices, rnd.randint(1, 5))
                     for off, s in ((0, "buy"), (1, "sell")) for _ in range(1)]
            rows.append((t, seq, "snapshot", "buy", prices + 0.5, 9))
        else:
            off, side = rnd.choice([(0, "buy"), (1, "sell")])
            rows.append((t, seq, "l2update", side, rnd.randint(1, prices) + off * prices, rnd.choice([0, 0, 1, 2, 3])))
    return rows


def by_hand(rows, step):
    """{bucket: {side: {price: size}}} after every bucket with changes."""
    sides, out, opened = {"buy": {}, "sell": {}}, {}, None
    base = int(at(0).timestamp() * SECOND)
    for t, seq, kind, side, price, size in rows:
        if kind == "snapshot" and seq != opened:
            opened, sides = seq, {"buy": {}, "sell": {}}
        book.apply_change(sides, kind, side, float(price), float(size))
        us = base + round(t * SECOND)
        out[us - us % step] = {s: dict(v) for s, v in sides.items()}
    return out


def test_upsert_delete_and_snapshot(spark):
    changes = feed(spark, [
        (0.1, 1, "l2update", "buy", 99, 1), (0.2, 2, "l2update", "sell", 101, 2), (1.1, 3, "l2update", "buy", 99, 0),
        (1.2, 4, "l2update", "buy", 98, 5), (3.0, 5, "snapshot", "buy", 90, 7), (3.0, 5, "snapshot", "sell", 110, 8),
        (4.0, 6, "l2update", "sell", 110, 9)])
    assert levels(book.books(changes, SECOND)) == {
        (0, "buy", 99): 1, (0, "sell", 101): 2, (1, "buy", 98): 5, (1, "sell", 101): 2,
        (2, "buy", 98): 5, (2, "sell", 101): 2, (3, "buy", 90): 7, (3, "sell", 110): 8,
        (4, "buy", 90): 7, (4, "sell", 110): 9}


@pytest.mark.parametrize("step, rows", [(MINUTE, 10_000), (MINUTE, 10), (7 * SECOND, 3)])
def test_folded_quotes_equal_a_plain_fold(spark, step, rows):
    changes = random_changes()
    df = feed(spark, changes)
    chunks = measure(df.withColumn("_us", micros(F.col("ts"))), ["symbol"], HOUR, rows=rows)
    got = {r["bucket"]: r for r in as_dicts(book.quotes(df, step, chunks), "bucket")}
    want = by_hand(changes, step)
    assert got.keys() == want.keys()
    for bucket, sides in want.items():
        row = got[bucket]
        assert [(x["price"], x["size"]) for x in row["bids"]] == sorted(sides["buy"].items(), reverse=True)
        assert [(x["price"], x["size"]) for x in row["asks"]] == sorted(sides["sell"].items())


def test_relational_books_equal_a_plain_fold(spark):
    changes = random_changes(seed=8)
    got = {}
    for r in book.books(feed(spark, changes), MINUTE).collect():
        got.setdefault(r.bucket, {"buy": {}, "sell": {}})[r.side][r.price] = r.size
    for bucket, sides in by_hand(changes, MINUTE).items():
        assert got.get(bucket, {"buy": {}, "sell": {}}) == sides


def test_top_levels_and_top_of_book(spark):
    changes = feed(spark, [(0, i, "l2update", s, p, 1) for i, (s, p) in enumerate(
        [("buy", 1), ("buy", 2), ("buy", 3), ("sell", 4), ("sell", 5), ("sell", 6)])])
    live = book.books(changes, SECOND)
    best = {(r.side, r.level): r.price for r in book.top_levels(live, 2).collect()}
    assert best == {("buy", 1): 3, ("buy", 2): 2, ("sell", 1): 4, ("sell", 2): 5}
    top = book.top_of_book(live).first()
    assert (top.best_bid, top.best_ask) == (3, 4)


@pytest.mark.parametrize("mid, want", [(100.0, (3.0, 1.0, 2.0)), (0.0, (0.0, 0.0, 0.0)), (200.0, (2.0, 0.0, 2.0))])
def test_depth(spark, mid, want):
    changes = feed(spark, [(0, 1, "l2update", "buy", 98, 1), (0, 2, "l2update", "buy", 97, 4),
                           (0, 3, "l2update", "sell", 102, 2)])
    live = book.books(changes, SECOND)
    mids = live.select("symbol", "bucket").distinct().withColumn("mid", F.lit(mid))
    row = book.depth(live, mids).first()
    assert (row.depth, row.bid_depth, row.ask_depth) == want


def test_depth_without_levels(spark):
    mids = spark.createDataFrame([("X", 0, 100.0)], "symbol string, bucket long, mid double")
    none = spark.createDataFrame([], "symbol string, bucket long, side string, price double, size double")
    row = book.depth(none, mids).first()
    assert (row.depth, row.bid_depth, row.ask_depth) == (0, 0, 0)


def test_changes_of_one_message_follow_their_place(spark):
    rows = [(0.1, 1, "l2update", "buy", 99, 1), (0.1, 1, "l2update", "buy", 99, 0), (1.1, 2, "l2update", "sell", 101, 0), (1.1, 2, "l2update", "sell", 101, 4)]
    for order in (F.asc("part"), F.desc("part")):
        changes = feed(spark, rows).orderBy(order)
        assert levels(book.books(changes, SECOND)) == {(1, "sell", 101): 4}
        last = as_dicts(book.quotes(changes), "bucket")[-1]
        assert (last["bids"], last["asks"]) == ([], [{"price": 101, "size": 4}])
