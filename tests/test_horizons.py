import pytest
from helpers import as_dicts, random_trades, trades
from pyspark.sql import functions as F

from tapeworks.functions.timecols import DAY, HOUR, MINUTE, SECOND
from tapeworks.operators.horizons import block_counts, horizons, horizons_by_frame

WIDTHS = {"1s": SECOND, "1min": MINUTE, "1h": HOUR, "24h": DAY}


def samples(spark, rows):
    buy = F.col("side") == "buy"
    return trades(spark, rows).select(
        "symbol", "ts", "seq", "price",
        F.when(buy, F.col("size")).otherwise(0.0).alias("buy_vol"), F.when(~buy, F.col("size")).otherwise(0.0).alias("sell_vol"))


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for name, v in x.items():
            assert y[name] == (pytest.approx(v, abs=1e-9) if isinstance(v, float) else v), name


@pytest.mark.parametrize("span, limit", [(7200, None), (7200, 5), (3 * 86400, 20), (400, 1_000_000)])
def test_blocks_equal_frames(spark, span, limit):
    feed = samples(spark, random_trades(300, span=span, seed=span))
    same(as_dicts(horizons(feed, WIDTHS, rows_per_block=limit), "seq"), as_dicts(horizons_by_frame(feed, WIDTHS), "seq"))


def test_full_blocks_are_divided(spark):
    feed = samples(spark, random_trades(300)).withColumn("_us", F.unix_micros("ts"))
    parts = block_counts(feed, "symbol", WIDTHS, 10)
    assert parts["24h"] > parts["1min"] >= 1 and all(WIDTHS[n] % m == 0 for n, m in parts.items())


def test_left_end_is_open(spark):
    feed = samples(spark, [("X", 0, 0, 100.0, 1.0, "buy"), ("X", 1, 1, 110.0, 2.0, "sell"), ("X", 1.9, 2, 120.0, 4.0, "buy")])
    rows = as_dicts(horizons(feed, {"1s": SECOND}), "seq")
    assert [r["volume_1s"] for r in rows] == [1, 2, 6]
    assert [r["price_change_1s"] for r in rows] == [0, 0, 10]
    assert [(r["buy_volume_1s"], r["sell_volume_1s"]) for r in rows] == [(1, 0), (0, 2), (4, 2)]


def test_without_a_positive_price_volumes_are_zero(spark):
    feed = samples(spark, [("X", 0, 0, 0.0, 5.0, "buy"), ("X", 0.5, 1, 10.0, 1.0, "buy")])
    rows = as_dicts(horizons(feed, {"1s": SECOND}), "seq")
    assert [(r["high_1s"], r["volume_1s"]) for r in rows] == [(0, 0), (10, 6)]


def test_other_columns_survive(spark):
    feed = samples(spark, random_trades(50)).withColumn("note", F.array(F.lit("x")))
    made = horizons(feed, {"1min": MINUTE})
    assert made.columns[:7] == [*feed.columns[:0], *made.columns[:7]] and set(feed.columns) <= set(made.columns)
    assert made.filter(F.col("note")[0] == "x").count() == 50
