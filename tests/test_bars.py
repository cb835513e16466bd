import math

import pytest
from helpers import as_dicts, at, random_trades, trades
from pyspark.sql import functions as F

from tapeworks.functions.timecols import HOUR, MINUTE, micros
from tapeworks.operators import bars as B
from tapeworks.operators import quality
from tapeworks.operators.chunks import measure
from tapeworks.schemas import BAR_SCHEMA

SCHEMA = "symbol string, ts timestamp, seq long, price double, volume_1s double, trade_count_1s long"


def ticks(spark, prices, gap=1.0, symbol="X"):
    rows = [(symbol, at(i * gap), i, p, 1.0, 1) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, SCHEMA)


def test_golden_two_ticks(spark):
    rows = [("X", at(0), 0, 100.0, 1.0, 1, 10.0, 110.0, 90.0), ("X", at(30), 1, 110.0, 2.0, 1, 10.0, 110.0, 90.0),
            ("X", at(60), 2, 105.0, 3.0, 1, 10.0, 110.0, 90.0)]
    feed = spark.createDataFrame(rows, SCHEMA + ", volume_24h double, high_24h double, low_24h double")
    first, second = as_dicts(B.bars(feed), "window_start")
    assert [first[c] for c in ("open", "high", "low", "close")] == [100, 110, 100, 110]
    assert (first["total_volume_1m"], first["trade_count_1m"], first["price_change_1m"]) == (3, 2, 10)
    assert first["price_change_percent_1m"] == pytest.approx(10)
    assert first["volatility_1m"] == pytest.approx(10) and first["volatility_regime"] == "high"
    assert first["order_imbalance_ratio_1m"] == 0 and first["volume_24h"] == 10
    assert second["open"] == 105 and second["window_start"] - first["window_start"] == 60_000


def test_schema_is_the_declared_one(spark):
    assert quality.schema_differences(B.bars(ticks(spark, [1.0])), BAR_SCHEMA).count() == 0


def test_empty_and_unpriced_windows_give_no_bar(spark):
    assert B.bars(ticks(spark, [])).count() == 0
    assert B.bars(ticks(spark, [0.0, 0.0, None])).count() == 0


def test_zero_and_missing_prices_are_skipped_but_counted(spark):
    bar = B.bars(ticks(spark, [1.0, 0.0, None, 1.0])).first()
    assert (bar.open, bar.close, bar.num_ticks, bar.total_volume_1m) == (1, 1, 4, 4)


def test_one_tick_has_range_volatility(spark):
    bar = B.bars(ticks(spark, [5.0])).first()
    assert (bar.volatility_1m, bar.volatility_regime, bar.open, bar.close) == (0, "low", 5, 5)


def test_three_ticks_use_population_deviation(spark):
    bar = B.bars(ticks(spark, [100.0, 110.0, 99.0])).first()
    returns = [10.0, -10.0]
    mean = sum(returns) / 2
    assert bar.volatility_1m == pytest.approx(math.sqrt(sum((r - mean) ** 2 for r in returns) / 2))


def test_sixty_ticks(spark):
    bar = B.bars(ticks(spark, [1.0 + i for i in range(60)])).first()
    assert (bar.open, bar.close, bar.high, bar.low) == (1, 60, 60, 1)
    assert (bar.total_volume_1m, bar.num_ticks) == (60, 60)


def test_cap_keeps_the_last_ticks(spark):
    bar = B.bars(ticks(spark, [float(i) for i in range(1, 101)], gap=0.5), max_ticks=60).first()
    assert (bar.num_ticks, bar.open, bar.close) == (60, 41, 100)


def test_equal_instants_follow_sequence(spark):
    rows = [("X", at(0), q, p, 1.0, 1) for q, p in ((2, 30.0), (0, 10.0), (1, 20.0))]
    bar = B.bars(spark.createDataFrame(rows, SCHEMA)).first()
    assert (bar.open, bar.close) == (10, 30)


def test_open_bar_can_be_held_back(spark):
    feed = ticks(spark, [1.0] * 90)
    done = B.bars(feed, complete_before=F.lit(at(89)).cast("timestamp"))
    assert done.count() == 1 and B.bars(feed).count() == 2


@pytest.mark.parametrize("rows", [1, 3, 40])
def test_cut_bars_equal_whole_bars(spark, rows):
    feed = trades(spark, random_trades()).withColumn("volume_1s", F.col("size"))
    marked = feed.withColumn("_us", micros(F.col("ts")))
    chunks = measure(marked, ["symbol"], HOUR, rows=rows)
    assert chunks.splits
    whole, cut = (as_dicts(B.bars(feed, HOUR, chunks=c), "symbol", "window_start") for c in (None, chunks))
    assert len(whole) == len(cut) > 3
    for a, b in zip(whole, cut):
        for name, x in a.items():
            assert b[name] == (pytest.approx(x, abs=1e-9) if isinstance(x, float) else x), name


def test_invariants_and_conservation(spark):
    feed = trades(spark, random_trades(seed=5)).withColumns({
        "volume_1s": F.col("size"),
        "buy_volume_1s": F.when(F.col("side") == "buy", F.col("size")).otherwise(0.0),
        "sell_volume_1s": F.when(F.col("side") == "sell", F.col("size")).otherwise(0.0),
    })
    made = B.bars(feed, MINUTE)
    wrong = made.filter(
        (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))
        | (F.abs("order_imbalance_ratio_1m") > 1) | (F.col("volatility_1m") < 0)
    )
    assert wrong.count() == 0
    priced = quality.conservation(feed.filter("price > 0"), B.bars(feed.filter("price > 0"), MINUTE))
    assert priced.filter((F.abs("volume_gap") > 1e-9) | (F.col("ticks_gap") != 0)).count() == 0


def test_hour_buffer(spark):
    made = B.bars(ticks(spark, [float(i + 1) for i in range(180)], gap=30.0))
    full, part = as_dicts(B.hour_buffer(made), "hour_start")
    assert (full["rows_in_hour"], full["complete"], part["rows_in_hour"], part["complete"]) == (60, True, 30, False)
    assert [b["window_start"] for b in full["bars"]] == sorted(b["window_start"] for b in full["bars"])
