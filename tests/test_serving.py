import json

import pandas as pd
import pytest
from helpers import as_dicts
from pyspark.sql import functions as F

from tapeworks.operators import serving, sets
from tapeworks.plans import context

MIN, HOUR, DAY = 60_000, 3_600_000, 86_400_000
BASE = 1_709_294_400_000  # 2024-03-01 12:00 UTC


def bars(spark, starts, symbol="X", **columns):
    rows = [(symbol, s, s + MIN, 100.0 + i, 101.0 + i, 99.0 + i, 100.5 + i, float(i), i, 0.1 * i, float(-i), "2024")
            for i, s in enumerate(starts)]
    schema = ("symbol string, window_start long, window_end long, open double, high double, low double, close double, "
              "total_volume_1m double, trade_count_1m long, volatility_1m double, cvd_1m double, last_ingestion_time string")
    return spark.createDataFrame(rows, schema).withColumns({k: F.lit(v) for k, v in columns.items()})


def starts(df):
    return sorted(r.window_start for r in df.collect())


def test_timeline_and_its_fallback(spark):
    table = bars(spark, [BASE - k * MIN for k in range(100)])
    assert len(starts(serving.timeline(table, BASE, "5 Minutes"))) == 6
    assert len(starts(serving.timeline(table, BASE, "1 Hour"))) == 61
    assert len(starts(serving.timeline(table, BASE + DAY, "5 Minutes"))) == 100  # nothing recent: everything


def test_timeline_plan_has_no_cross_join(spark):
    plan = serving.timeline(bars(spark, [BASE]), BASE)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upsert_prefers_new_rows_and_is_idempotent(spark):
    old = bars(spark, [BASE, BASE + MIN, BASE - 2 * DAY], note="old")
    new = bars(spark, [BASE + MIN, BASE + 2 * MIN], note="new")
    once = sets.upsert(old, new, F.lit(BASE + HOUR))
    twice = sets.upsert(once, new, F.lit(BASE + HOUR))
    want = {BASE: "old", BASE + MIN: "new", BASE + 2 * MIN: "new"}
    assert {r.window_start: r.note for r in once.collect()} == want
    assert {r.window_start: r.note for r in twice.collect()} == want and twice.count() == 3


def test_union_fills_missing_columns(spark):
    both = sets.union_bars(bars(spark, [BASE]).drop("close"), bars(spark, [BASE]))
    assert both.filter("close is null").count() == 1


def test_reconcile(spark):
    left = bars(spark, [BASE, BASE + MIN, BASE + 2 * MIN])
    right = left.filter(F.col("window_start") > BASE).withColumn("close", F.col("close") + F.when(F.col("window_start") == BASE + MIN, 1).otherwise(0))
    row = sets.reconcile(left, right, ["close", "open"]).first()
    assert (row.in_both, row.left_only, row.right_only, row.diff_close, row.diff_open) == (2, 1, 0, 1, 0)


def test_reconcile_by_digest_joins_only_hours_that_differ(spark, monkeypatch):
    left = bars(spark, [BASE + k * HOUR + j * MIN for k in range(5) for j in range(4)])
    shuffled = left.repartition(7, "close")
    same = sets.reconcile_by_digest(left, shuffled, ["close", "open"]).first()
    assert (same.in_both, same.left_only, same.right_only, same.diff_close, same.hours_joined) == (20, 0, 0, 0, 0)
    at = F.col("window_start")
    right = shuffled.filter(at != BASE + MIN).withColumn("close", F.when(at == BASE + HOUR, 7e9).otherwise(F.col("close")))
    right = right.unionByName(bars(spark, [BASE + 9 * HOUR]))
    got, want = sets.reconcile_by_digest(left, right, ["close", "open"]).first(), sets.reconcile(left, right, ["close", "open"]).first()
    assert got.hours_joined == 3 and got.asDict() == {**want.asDict(), "hours_joined": 3}


@pytest.mark.parametrize("cell", ["CAST('NaN' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)", "CAST(NULL AS DOUBLE)", "0D"])
def test_digests_of_odd_values_and_missing_keys_agree_with_the_join(spark, cell):
    at = F.col("window_start")
    left = bars(spark, [BASE, BASE + MIN, BASE + HOUR, BASE + 2 * HOUR]).withColumn("close", F.when(at == BASE, F.expr(cell)).otherwise(F.col("close")))
    left = left.withColumn("symbol", F.when(at != BASE + HOUR, F.col("symbol"))).withColumn("window_start", F.when(at != BASE + 2 * HOUR, at))
    swapped = left.withColumns({"open": F.col("close"), "close": F.col("open")})  # a missing value in another place
    for right in (left, swapped, left.limit(0)):
        got, want = sets.reconcile_by_digest(left, right, ["close", "open"]).first(), sets.reconcile(left, right, ["close", "open"]).first()
        assert {**got.asDict(), "hours_joined": None} == {**want.asDict(), "hours_joined": None}


def test_moving_average_equals_pandas_over_gaps(spark):
    at = [BASE + k * MIN for k in (0, 1, 2, 900, 901, 5000, 9000, 9001, 9002, 9003, 9004, 9005, 30000)]
    made = as_dicts(serving.moving_average(bars(spark, at)), "window_start")
    want = pd.Series(range(len(at))).rolling(5, min_periods=1).mean()
    assert [r["trade_count_1m_ma5"] for r in made] == pytest.approx(list(want))


def test_divergence(spark):
    at = [BASE + k * 7 * HOUR for k in range(8)]
    rows = as_dicts(serving.divergence(bars(spark, at), 2), "window_start")
    assert [r["divergence"] for r in rows] == ["none"] * 2 + ["bearish"] * 6
    assert [r["momentum"] for r in rows][:3] == [None, None, 2.0]


def test_hourly_keeps_empty_hours(spark):
    rows = as_dicts(serving.hourly(bars(spark, [BASE, BASE + MIN, BASE + 3 * HOUR])), "hour_start")
    assert [(r["open"], r["close"], r["total_volume_1m"], r["trade_count_1m"]) for r in rows] == [
        (100, 101.5, 1, 1), (None, None, 0, 0), (None, None, 0, 0), (102, 102.5, 2, 2)]
    assert len(as_dicts(serving.hourly(bars(spark, [BASE, BASE + 100 * HOUR])), "hour_start")) == 30


def test_latest_tail_recent(spark):
    table = bars(spark, [BASE + k * MIN for k in range(30)]).unionByName(bars(spark, [BASE], symbol="Y"))
    assert {r.symbol: r.window_start for r in serving.latest(table).collect()} == {"X": BASE + 29 * MIN, "Y": BASE}
    assert serving.tail(table, 20).groupBy("symbol").count().orderBy("symbol").collect()[0][1] == 20
    assert [r.window_start for r in serving.recent(table, 2).collect()] == [BASE + 29 * MIN, BASE + 28 * MIN]


def test_regime_share(spark):
    table = bars(spark, [BASE, BASE + MIN], volatility_regime="low").unionByName(bars(spark, [BASE + 2 * MIN] * 2, volatility_regime="high"))
    rows = [(r.volatility_regime, r.bars, r.percent) for r in serving.regime_share(table).collect()]
    assert sorted(rows) == [("high", 2, 50.0), ("low", 2, 50.0)]


def document(df, symbol="X"):
    return json.loads(df.filter(F.col("symbol") == symbol).first().context)


def test_context_document(spark):
    at = [BASE + k * MIN for k in range(200)]
    table = bars(spark, at).withColumn("volatility_1m", F.when(F.col("window_start") == at[-1], F.lit(float("nan"))).otherwise(0.5))
    doc = document(context.market_context(table, "1 Day", BASE * 1000))
    assert doc["meta"] == {"timeline": "1 Day", "now_est": "2024-03-01T07:00:00.000000-05:00", "rows_window": 200, "rows_sent": 180}
    assert doc["latest"]["close"] == 299.5 and doc["latest"]["volatility_1m"] is None
    assert doc["latest"]["window_start"] == "2024-03-01T10:19:00.000000-05:00"
    assert doc["summary"]["window_rows"] == 200 and doc["summary"]["total_volume_1m_sum"] == sum(range(200))
    assert doc["summary"]["return_pct"] == pytest.approx((299.5 / 100 - 1) * 100)
    assert [h["window_start"][11:13] for h in doc["hourly"]] == ["07", "08", "09", "10"]
    assert len(doc["rows"]) == 180 and doc["rows"][-1] == doc["latest"]
    assert doc["rows"][0]["window_start"] < doc["rows"][1]["window_start"]


def test_context_respects_the_window(spark):
    doc = document(context.market_context(bars(spark, [BASE + k * MIN for k in range(50)]), "5 Minutes", BASE * 1000, rows_max=10))
    assert (doc["meta"]["rows_window"], doc["meta"]["rows_sent"], len(doc["rows"])) == (10, 10, 10)


def test_empty_context_is_complete(spark):
    assert context.market_context(bars(spark, []), "1 Day", BASE * 1000).count() == 0
    doc = json.loads(context.empty_context(spark, "1 Day", BASE * 1000).first().context)
    assert set(doc) == {"meta", "latest", "summary", "hourly", "rows"} and doc["meta"]["rows_sent"] == 0


def test_optional_columns(spark):
    table = bars(spark, [BASE])
    assert "last_ingestion_time" not in serving.present(table).columns and "cvd_1m" in serving.present(table).columns
    assert serving.present(table, ["close"]).columns == ["close"]


def test_a_quiet_symbol_falls_back_beside_a_live_one(spark):
    table = bars(spark, [BASE, BASE - MIN]).unionByName(bars(spark, [BASE - DAY, BASE - 2 * DAY], "Q"))
    got = {(r.symbol, r.window_start) for r in serving.timeline(table, BASE, "5 Minutes").collect()}
    assert got == {("X", BASE), ("X", BASE - MIN), ("Q", BASE - DAY), ("Q", BASE - 2 * DAY)}


def test_nan_counts_as_missing(spark):
    table = bars(spark, [BASE, BASE + MIN])
    spoilt = table.withColumns({c: F.when(F.col("window_start") == BASE, F.lit(float("nan"))).otherwise(F.col(c)) for c in ("high", "volatility_1m")})
    assert serving.window_summary(spoilt).first().high == 102.0
    assert serving.hourly(spoilt).first().volatility_1m == 0.1
    figures = {c: F.lit(1.0) for c in (
        "avg_bid_ask_spread_1m", "avg_bid_depth_2pct_1m", "avg_ask_depth_2pct_1m", "total_ofi_1m", "avg_micro_price_deviation_1m",
        "avg_kyles_lambda_1m", "avg_liquidity_health_1m")}
    assert serving.statistics(spoilt.withColumns(figures)).first().price_high == 102.0


def test_context_of_no_rows_sends_one(spark):
    text = context.market_context(bars(spark, [BASE, BASE + MIN]), "1 Day", BASE * 1000, rows_max=0).first().context
    meta = json.loads(text)["meta"]
    assert (meta["rows_window"], meta["rows_sent"]) == (1, 1)
    short = context.market_context(bars(spark, [BASE + i * HOUR for i in range(5)]), "1 Day", BASE * 1000, sent_max=2, hours=3).first().context
    assert (len(json.loads(short)["rows"]), len(json.loads(short)["hourly"])) == (2, 3)
