import math

import pytest
from pyspark.sql import functions as F

from tapeworks.functions import scalars as S
from tapeworks.functions import timecols as T


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize("bid, ask, spread, mid", [
    (99.0, 101.0, 2.0, 100.0), (0.0, 0.0, 0.0, 0.0), (0.0, 5.0, 0.0, 0.0), (None, 5.0, 0.0, 0.0), (5.0, 4.0, -1.0, 4.5),
])
def test_spread_and_mid(spark, bid, ask, spread, mid):
    assert value(spark, S.spread(lit(bid), lit(ask))) == spread
    assert value(spark, S.mid_price(lit(bid), lit(ask))) == mid


@pytest.mark.parametrize("depth, spread, vol, want", [
    (10.0, 2.0, 0.5, 10.0), (10.0, 2.0, 0.0, 10.0), (10.0, 0.0, 0.5, 0.0), (10.0, -1.0, 0.5, 0.0), (10.0, 2.0, -3.0, 10.0),
])
def test_liquidity_health(spark, depth, spread, vol, want):
    assert value(spark, S.liquidity_health(lit(depth), lit(spread), lit(vol))) == want


def test_ratios_never_divide_by_zero(spark):
    zero, one = lit(0.0), lit(1.0)
    for column in (S.price_impact(one, zero), S.buy_sell_ratio(one, zero), S.imbalance_ratio(zero, zero),
                   S.change_percent(zero, one), S.micro_deviation(one, zero)):
        assert value(spark, column) == 0.0


@pytest.mark.parametrize("vol, regime", [(0.0, "low"), (0.0999, "low"), (0.1, "medium"), (0.4999, "medium"), (0.5, "high")])
def test_regime_borders(spark, vol, regime):
    assert value(spark, S.volatility_regime(lit(vol))) == regime


@pytest.mark.parametrize("utc, text, iso, hour", [
    ("2024-01-10 05:00:00", "2024-01-10 00:00:00", "2024-01-10T00:00:00.000000-05:00", "00"),
    ("2024-07-10 03:30:00", "2024-07-09 23:30:00", "2024-07-09T23:30:00.000000-04:00", "23"),
    ("2024-03-10 07:00:00", "2024-03-10 03:00:00", "2024-03-10T03:00:00.000000-04:00", "03"),  # clocks go forward
    ("2024-11-03 06:30:00", "2024-11-03 01:30:00", "2024-11-03T01:30:00.000000-05:00", "01"),  # second 01:30
])
def test_eastern_rendering(spark, utc, text, iso, hour):
    ts = F.lit(utc).cast("timestamp")
    row = spark.range(1).select(T.zone_text(ts).alias("t"), T.iso_text(ts).alias("i"), T.folder_keys(ts)["hour"].alias("h")).first()
    assert (row.t, row.i, row.h) == (text, iso, hour)


def test_floor_before_epoch(spark):
    assert value(spark, T.floor_to(F.lit(-1), T.MINUTE)) == -T.MINUTE


def test_zero_is_kept_apart_from_null(spark):
    assert value(spark, S.or_zero(lit(None))) == 0.0
    assert math.isnan(value(spark, S.or_zero(lit(float("nan")))))
