import random

import pytest
from helpers import as_dicts, at, trades
from pyspark.sql import types as T

from tapeworks.functions.timecols import DAY, HOUR, SECOND
from tapeworks.operators import health, quality


def alerts(spark, rows):
    data = [(k, at(t), i) for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(data, "alert_key string, ts timestamp, seq long")


def greedy(rows, period):
    last, sent = {}, set()
    for i, (k, t) in sorted(enumerate(rows), key=lambda x: (x[1][1], x[0])):
        if k not in last or t - last[k] >= period:
            last[k] = t
            sent.add(i)
    return sent


@pytest.mark.parametrize("seed, width", [(1, DAY), (2, HOUR), (3, 32 * 300 * SECOND), (4, 5 * HOUR)])
def test_cooldown_equals_the_greedy_rule(spark, seed, width):
    rnd = random.Random(seed)
    feed = [(rnd.choice("aaab"), rnd.choice([rnd.randint(0, 90_000), rnd.randint(40_000, 43_000), 50_000])) for _ in range(400)]
    made = health.cooldown(alerts(spark, feed), width=width)
    assert made.count() == len(feed)
    assert {r.seq for r in made.filter("sent").collect()} == greedy(feed, 300)


def test_cooldown_is_not_a_tumbling_window(spark):
    feed = [("a", t) for t in (0, 200, 299, 300, 500, 599, 600, 901)]
    assert [r["sent"] for r in as_dicts(health.cooldown(alerts(spark, feed)), "seq")] == [
        True, False, False, True, False, False, True, True]


def feed_of(spark, seconds):
    return trades(spark, [("X", t, i, 1.0, 1.0, "buy") for i, t in enumerate(seconds)])


def test_gaps_and_restarts(spark):
    # checks at multiples of 10 s; stale when the last trade is more than 30 s old
    rows = as_dicts(health.gaps(feed_of(spark, [0, 30, 61, 111.5, 175])), "seq")
    assert [r["gap_us"] and r["gap_us"] / SECOND for r in rows] == [None, 30, 31, 50.5, 63.5]
    assert [r["stale_checks"] for r in rows] == [0, 0, 0, 2, 3]
    assert [r["restart"] for r in rows] == [False, False, False, False, True]
    base = int(at(0).timestamp() * SECOND)
    assert rows[-1]["restart_us"] == base + 170 * SECOND


def test_sessions(spark):
    rows = as_dicts(health.sessions(feed_of(spark, [0, 10, 200, 210, 400])), "seq")
    assert [r["feed_session"] for r in rows] == [0, 0, 1, 1, 2]


def test_component_status(spark):
    log = spark.createDataFrame(
        [("producer", at(0), False), ("producer", at(80), False), ("consumer_ticks", at(0), False), ("other", at(5), True)],
        "component string, ts timestamp, is_error boolean")
    now = int(at(100).timestamp() * SECOND)
    rows = {r.component: r for r in health.component_status(log, now).collect()}
    assert {c: r.status for c, r in rows.items()} == {"Producer": "running", "Aggregator": "stale", "Writer": "not started"}
    assert rows["Producer"].messages == 2 and rows["Writer"].messages == 0
    assert all(r.degraded and r.total_errors == 1 for r in rows.values())
    calm = health.component_status(log.filter("component = 'producer'"), now)
    assert not any(r.degraded for r in calm.collect())


def test_lag_alerts(spark):
    lags = spark.createDataFrame([("t", 100), ("t", 101), ("t", 250), ("u", 999)], "topic string, lag long")
    assert sorted(r.alert_key for r in health.lag_alerts(lags).collect()) == ["t_lag_1", "t_lag_2", "u_lag_9"]


def test_duplicates(spark):
    rows = spark.createDataFrame([("X", 1000, 1.0), ("X", 1000, 1.0), ("X", 1001, 1.0)], "symbol string, timestamp long, price double")
    row = quality.duplicates(rows, ["timestamp", "price"]).first()
    assert (row.messages, row.distinct_messages, row.repeats) == (3, 2, 1)


def test_price_changes(spark):
    feed = trades(spark, [("X", i, i, float(p), 1.0, "buy") for i, p in enumerate((100, 100, 101, 101, 102))])
    assert [r["price"] for r in as_dicts(quality.price_changes(feed), "seq")] == [100, 101, 102]


def test_completeness(spark):
    rows = spark.createDataFrame([(30,), (53,), (54,), (60,)], "num_ticks long")
    assert [r.healthy for r in quality.completeness(rows).collect()] == [False, False, True, True]


def test_missing_and_negative(spark):
    rows = spark.createDataFrame([("X", 1.0, -100.0), ("X", None, 1.0), ("X", 1.0, None)], "symbol string, open double, volume double")
    named = {tuple(r.missing) for r in quality.missing_fields(rows, ["open", "high", "volume"]).collect()}
    assert named == {("high",), ("open", "high"), ("high", "volume")}
    row = quality.volume_validity(rows).first()
    assert (row.valid, row.invalid) == (1, 2)


def test_backward_steps(spark):
    feed = trades(spark, [("X", t, i, 1.0, 1.0, "buy") for i, t in enumerate((0, 1, 5, 4, 4, 6))])
    row = quality.backward_steps(feed).first()
    assert (row.backward, row.monotonic) == (1, False)


def test_gap_of_many_hours_counts_three_strikes(spark):
    row = as_dicts(health.gaps(feed_of(spark, [0, HOUR // SECOND * 30])), "seq")[1]
    assert (row["stale_checks"], row["restart"]) == (3, True)


def test_a_feed_that_died_is_told(spark):
    feed = trades(spark, [("X", 0, 0, 1.0, 1.0, "buy"), ("Y", 95, 1, 1.0, 1.0, "buy")])
    as_of = int(at(61).timestamp() * SECOND)
    rows = {r.symbol: r for r in health.silence(feed, as_of).collect()}
    assert (rows["X"].stale_checks, rows["X"].restart, rows["X"].restart_us - int(at(0).timestamp()) * SECOND) == (3, True, 60 * SECOND)
    assert rows["Y"].stale_checks == 0 and not rows["Y"].restart


def test_components_are_an_argument(spark):
    log = spark.createDataFrame([("mine", at(0), False)], "component string, ts timestamp, is_error boolean")
    rows = health.component_status(log, int(at(5).timestamp() * SECOND), [("Mine", "mine", 10)]).collect()
    assert [(r.component, r.status) for r in rows] == [("Mine", "running")]


def test_schema_differences_name_what_differs_only(spark):
    declared = T.StructType([T.StructField(n, T.LongType()) for n in "abcd"])
    found = spark.createDataFrame([(1, "x", 2, 3)], "a long, c string, d long, e long")
    rows = {r["column"]: r["difference"] for r in quality.schema_differences(found, declared).collect()}
    assert rows == {"b": "missing", "c": "type", "e": "extra"}
    report = {r["column"]: (r["filled"], r["unreadable"]) for r in quality.schema_report(found, declared).collect()}
    assert report == {"a": (1, 0), "b": (0, 0), "c": (1, 1), "d": (1, 0), "e": (1, 0)}
