"""Ordered work under skew: one symbol and one instant of it hold most rows."""

import pytest
from helpers import as_dicts, random_trades, trades
from pyspark.sql import functions as F

from tapeworks.functions.timecols import HOUR, MINUTE, SECOND, micros
from tapeworks.operators import align, flow
from tapeworks.operators import chunks as C
from tapeworks.operators.chunks import CUT, measure
from tapeworks.operators.scan import last_known, own_rows, scan, with_preceding


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2]))


@pytest.fixture(scope="module")
def feed(spark):
    return trades(spark, random_trades()).withColumn("_us", micros(F.col("ts"))).cache()


@pytest.mark.parametrize("rows", [2, 20, 10_000])
def test_chunks_are_small_and_in_order(spark, feed, rows):
    chunks = measure(feed, ["symbol"], HOUR, rows=rows)
    labelled = chunks.label(feed)
    largest = labelled.groupBy(*chunks.group).count().agg(F.max("count")).first()[0]
    assert largest <= max(rows * 3, 1)
    assert labelled.count() == feed.count()
    # chunk order agrees with row order: no chunk reaches into the next one
    spans = labelled.groupBy(*chunks.group).agg(F.min(F.struct("_us", "seq")).alias("a"), F.max(F.struct("_us", "seq")).alias("z"))
    listed = as_dicts(spans, "symbol", *CUT)
    for one, two in zip(listed, listed[1:]):
        if one["symbol"] == two["symbol"]:
            assert tuple(one["z"].values()) < tuple(two["a"].values())


def test_many_full_buckets_use_a_shuffle_join(spark, feed, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    chunks = measure(feed, ["symbol"], MINUTE, rows=20)
    plan = chunks.label(feed)._jdf.queryExecution().toString()
    assert "ResolvedHint (strategy=broadcast)" not in plan
    assert chunks.label(feed).groupBy(*chunks.group).count().agg(F.max("count")).first()[0] <= 60


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_scan_equals_brute_force(spark, feed, rows):
    chunks = measure(feed, ["symbol"], HOUR, rows=rows)
    price = F.when(F.col("price") > 0, F.col("price"))
    made = scan(feed, chunks, last={"before": price},
                totals={"volume": ("sum", F.col("size")), "top": ("max", price), "bottom": ("min", price)})
    got = {r["seq"]: r for r in as_dicts(made, "seq")}
    state = {}
    for symbol, _, seq, p, z, _ in ordered(random_trades()):
        before, volume, top, bottom = state.get(symbol, (None, 0.0, None, None))
        volume += z
        if p > 0:
            top, bottom = max(p, top or p), min(p, bottom or p)
        row = got.pop(seq)
        assert (row["before"], row["top"], row["bottom"]) == (before, top, bottom)
        assert row["volume"] == pytest.approx(volume)
        state[symbol] = (p if p > 0 else before, volume, top, bottom)
    assert not got


def test_columns_of_the_feed_survive(spark, feed):
    made = last_known(feed, measure(feed, ["symbol"], rows=5), {"x": F.col("price")})
    assert set(made.columns) == {*feed.columns, "x"} and made.count() == feed.count()


@pytest.mark.parametrize("rows", [2, 10_000])
def test_as_of(spark, rows):
    left, right = random_trades(seed=2), random_trades(150, seed=3)
    quotes = trades(spark, right).select("symbol", "ts", "seq", F.col("price").alias("quote"))
    base = trades(spark, left).drop("size", "side")
    got = {r["seq"]: r["quote"] for r in as_dicts(align.as_of(base, quotes, ["quote"], rows=rows), "seq")}
    for symbol, when, seq, *_ in left:
        known = [(t, q, p) for s, t, q, p, *_ in right if s == symbol and t <= when]
        assert got[seq] == (max(known)[2] if known else None)
    assert len(got) == len(left)


def test_as_of_without_right_rows(spark):
    base = trades(spark, random_trades(10))
    quotes = base.limit(0).select("symbol", "ts", "seq", F.col("price").alias("quote"))
    made = align.as_of(base, quotes, ["quote"])
    assert made.count() == 10 and made.filter("quote is not null").count() == 0


def test_grid_has_no_gaps_and_carries_prices(spark):
    feed = trades(spark, [("X", 0.4, 0, 10.0, 1.0, "buy"), ("X", 3.2, 1, 12.0, 2.0, "sell"), ("Y", 1.0, 2, 5.0, 1.0, "buy")])
    made = flow.bucketed(feed, SECOND).groupBy("symbol", "bucket").agg(F.sum("size").alias("v"), F.max("price").alias("p"))
    rows = as_dicts(align.on_grid(feed, made, SECOND, ["v"], ["p"]), "symbol", "bucket")
    assert [(r["symbol"], r["v"], r["p"]) for r in rows] == [
        ("X", 1, 10), ("X", 0, 10), ("X", 0, 10), ("X", 2, 12), ("Y", 1, 5)]


def test_grid_over_days(spark):
    feed = trades(spark, [("X", 0, 0, 1.0, 1.0, "buy"), ("X", 3 * 86400 + 59, 1, 1.0, 1.0, "buy")])
    made = align.grid(feed, MINUTE)
    assert made.count() == made.distinct().count() == 3 * 1440 + 1


def test_with_preceding_borrows_across_empty_blocks(spark):
    rows = [("X", i) for i in (0, 1, 250, 251, 252, 999)]
    df = spark.createDataFrame(rows, "symbol string, pos long")
    made = with_preceding(df, "pos", 100, 2, [])
    borrowed = {(r._block, r.pos) for r in made.filter("not _own").collect()}
    assert borrowed == {(200, 0), (200, 1), (900, 251), (900, 252)}
    assert own_rows(made).count() == len(rows)


def test_volume_delta_restarts_with_the_session(spark):
    feed = trades(spark, [("X", i, i, 1.0, 1.0, "buy") for i in range(4)]).withColumn("feed_session", F.floor(F.col("seq") / 2))
    assert [r["cvd"] for r in as_dicts(flow.volume_delta(feed, "feed_session"), "seq")] == [1, 2, 1, 2]
    assert [r["cvd"] for r in as_dicts(flow.volume_delta(feed), "seq")] == [1, 2, 3, 4]


def test_vwap_ignores_missing_and_empty(spark):
    rows = [("A", 1.0, None), ("A", 1.0, 2.0), ("B", None, 1.0), ("B", 3.0, 0.0), ("C", 2.0, 1.0), ("C", 5.0, 2.0)]
    df = spark.createDataFrame(rows, "symbol string, price double, size double")
    assert {r.symbol: r.vwap for r in flow.vwap(df, ["symbol"]).collect()} == {"A": 1.0, "B": 0.0, "C": 4.0}


def test_price_impact_spans_seconds(spark):
    feed = trades(spark, [("X", 0, 0, 100.0, 1.0, "buy"), ("X", 5, 1, 102.0, 4.0, "buy"), ("X", 5.5, 2, 101.0, 2.0, "sell")])
    rows = as_dicts(flow.price_impact(feed), "bucket")
    assert [r["kyles_lambda"] for r in rows] == [0.5]  # (2 - 1) / (4 - 2); the first trade has no predecessor
