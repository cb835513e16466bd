"""Queries: alignment, horizons, running state, gaps, alerts."""

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.aggregates import AS_OF_US, hour_bars, minute_bars
from tapeworks.catalog.registry import query
from tapeworks.functions.timecols import HOUR, MINUTE, SECOND, micros
from tapeworks.operators import align, flow, health, horizons, quality, serving
from tapeworks.operators.chunks import measure
from tapeworks.operators.scan import last_known


@query("j1_asof", f"""WITH {V.SQL_TRADES},
quotes AS (SELECT symbol, us, value + 100 AS mid, value + 100 - k::DOUBLE / 100 AS bid,
                  value + 100 + k::DOUBLE / 100 AS ask FROM feed WHERE event_type = 'view')
SELECT t.symbol, t.us, t.seq, round(t.price + 1.3e-9, 6) + 0.0 AS price, round(q.mid + 1.3e-9, 6) + 0.0 AS mid,
       round(q.bid + 1.3e-9, 6) + 0.0 AS bid, round(q.ask + 1.3e-9, 6) + 0.0 AS ask
FROM trades t ASOF LEFT JOIN quotes q ON t.symbol = q.symbol AND t.us >= q.us""")
def j1(spark, folder):
    trades = V.trades(spark, folder).select("symbol", "ts", "seq", "price")
    return V.rounded(V.with_us(align.as_of(trades, V.quotes(spark, folder), ["mid", "bid", "ask"])))


@query("j2_grid", f"""WITH {V.SQL_TRADES},
spans AS (SELECT symbol, min(us - us % {MINUTE}) AS lo, max(us - us % {MINUTE}) AS hi FROM trades GROUP BY 1),
grid AS (SELECT symbol, unnest(generate_series(lo, hi, {MINUTE})) AS bucket FROM spans),
made AS (SELECT symbol, us - us % {MINUTE} AS bucket, sum(size) AS volume, count(*) AS trade_count,
                arg_max(price, (us, seq)) AS price FROM trades GROUP BY 1, 2)
SELECT symbol, bucket, round(coalesce(volume, 0) + 1.3e-9, 6) + 0.0 AS volume, coalesce(trade_count, 0) AS trade_count,
       round(last_value(price IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY bucket) + 1.3e-9, 6) + 0.0 AS price
FROM grid LEFT JOIN made USING (symbol, bucket)""")
def j2(spark, folder):
    return grid_by(spark, folder, MINUTE)


def grid_by(spark, folder, step):
    trades = V.trades(spark, folder)
    made = flow.bucketed(trades, step).groupBy("symbol", "bucket").agg(
        F.sum("size").alias("volume"), F.count(F.lit(1)).alias("trade_count"),
        F.max_by("price", F.struct("ts", "seq")).alias("price"),
    )
    return V.rounded(align.on_grid(trades, made, step, ["volume", "trade_count"], ["price"]))


def _horizon_sql() -> str:
    frames, items = [], []
    for name, width in horizons.HORIZONS.items():
        frames.append(f"w_{name} AS (PARTITION BY symbol ORDER BY us RANGE BETWEEN {width - 1} PRECEDING AND CURRENT ROW)")
        first = f"arg_min(price, (us, seq)) FILTER (price > 0) OVER w_{name}"
        last = f"arg_max(price, (us, seq)) FILTER (price > 0) OVER w_{name}"
        figures = {
            "high": f"max(price) FILTER (price > 0) OVER w_{name}",
            "low": f"min(price) FILTER (price > 0) OVER w_{name}",
            "price_change": f"{last} - {first}",
            "price_change_percent": f"({last} - {first}) / {first} * 100",
            "volume": f"CASE WHEN {first} > 0 THEN sum(buy_volume_1s + sell_volume_1s) OVER w_{name} END",
            "buy_volume": f"CASE WHEN {first} > 0 THEN sum(buy_volume_1s) OVER w_{name} END",
            "sell_volume": f"CASE WHEN {first} > 0 THEN sum(sell_volume_1s) OVER w_{name} END",
        }
        items += [f"round(coalesce({v}, 0) + 1.3e-9, 6) + 0.0 AS {m}_{name}" for m, v in figures.items()]
    return f"WITH {V.SQL_TICKS}\nSELECT seq, {', '.join(items)}\nFROM ticks WINDOW {', '.join(frames)}"


def samples(spark, folder):
    return V.ticks(spark, folder).select(
        "symbol", "ts", "seq", "price", F.col("buy_volume_1s").alias("buy_vol"),
        F.col("sell_volume_1s").alias("sell_vol"),
    )


@query("w1_horizons", _horizon_sql())
def w1(spark, folder):
    made = horizons.horizons(samples(spark, folder))
    return V.rounded(made.drop("symbol", "ts", "price", "buy_vol", "sell_vol"))


@query("w2_ma5", f"""WITH {V.MINUTE_BARS}
SELECT symbol, window_start, round(avg(trade_count_1m) OVER (
         PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) + 1.3e-9, 6) + 0.0
       AS trade_count_1m_ma5 FROM bars""")
def w2(spark, folder):
    bars = minute_bars(spark, folder).select("symbol", "window_start", "trade_count_1m")
    return V.rounded(serving.moving_average(bars).drop("trade_count_1m"))


@query("w3_return", f"""WITH {V.SQL_TICKS}
SELECT seq, round((price - lag(price) OVER w) / lag(price) OVER w * 100 + 1.3e-9, 6) + 0.0 AS return_percent
FROM ticks WHERE price > 0 WINDOW w AS (PARTITION BY symbol ORDER BY us, seq)""")
def w3(spark, folder):
    feed = V.ticks(spark, folder).filter("price > 0").select(
        "symbol", micros(F.col("ts")).alias("_us"), "seq", "price"
    )
    linked = last_known(feed, measure(feed, ["symbol"]), {"before": F.col("price")})
    move = (F.col("price") - F.col("before")) / F.col("before") * 100
    return V.rounded(linked.select("seq", move.alias("return_percent")))


@query("w4_prev_trade", f"""WITH {V.SQL_TRADES}, linked AS (
  SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY us, seq) AS previous FROM trades)
SELECT seq, round(price - previous + 1.3e-9, 6) + 0.0 AS price_change,
       CASE WHEN side = 'buy' THEN size ELSE -size END + 0.0 AS signed_volume
FROM linked WHERE previous > 0""")
def w4(spark, folder):
    return V.rounded(flow.previous_trade(V.trades(spark, folder)).select("seq", "price_change", "signed_volume"))


@query("w5_cvd", f"""WITH {V.SQL_TRADES}
SELECT seq, round(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) OVER (
         PARTITION BY symbol ORDER BY us, seq ROWS UNBOUNDED PRECEDING) + 1.3e-9, 6) + 0.0 AS cvd FROM trades""")
def w5(spark, folder):
    return V.rounded(flow.volume_delta(V.trades(spark, folder)).select("seq", "cvd"))


@query("w6_extremes", f"""WITH {V.SQL_TICKS}
SELECT seq, round(max(high_24h) OVER w + 1.3e-9, 6) + 0.0 AS running_high,
       round(min(low_24h) FILTER (low_24h > 0) OVER w + 1.3e-9, 6) + 0.0 AS running_low
FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY us, seq ROWS UNBOUNDED PRECEDING)""")
def w6(spark, folder):
    return V.rounded(flow.extremes(V.ticks(spark, folder)).select("seq", "running_high", "running_low"))


STALE, EVERY = 30 * SECOND, 10 * SECOND
# the checks of a gap, laid out one by one
SQL_GAPS = V.SQL_TRADES + f""",
linked AS (SELECT *, lag(us) OVER (PARTITION BY symbol ORDER BY us, seq) AS before FROM trades),
checks AS (
  SELECT seq, list_filter(generate_series(before - before % {EVERY}, us, {EVERY}),
                          lambda c: c - before > {STALE} AND c < us) AS stale FROM linked),
gaps AS (
  SELECT symbol, us, seq, side, size, us - before AS gap_us, least(len(coalesce(stale, [])), 3) AS stale_checks,
         len(coalesce(stale, [])) >= 3 AS restart, stale[3] AS restart_us
  FROM linked JOIN checks USING (seq))"""


@query("w7_gaps", f"WITH {SQL_GAPS}\nSELECT seq, gap_us, stale_checks, restart, restart_us FROM gaps")
def w7(spark, folder):
    return health.gaps(V.trades(spark, folder)).select("seq", "gap_us", "stale_checks", "restart", "restart_us")


@query("w7_silence", f"""WITH {V.SQL_TRADES},
last AS (SELECT symbol, max(us) AS last_us FROM trades GROUP BY 1),
due AS (SELECT *, last_us + 30000000 - (last_us + 30000000) % 10000000 + 10000000 AS first FROM last),
found AS (SELECT *, least(3, greatest(0, floor(({AS_OF_US} - first) / 10000000.0) + 1))::BIGINT AS stale_checks FROM due)
SELECT symbol, last_us, {AS_OF_US} - last_us AS gap_us, stale_checks, stale_checks = 3 AS restart,
       CASE WHEN stale_checks = 3 THEN first + 20000000 END AS restart_us FROM found""")
def w7_silence(spark, folder):
    """What the checks found after each symbol's last trade."""
    return health.silence(V.trades(spark, folder), AS_OF_US)


SQL_SESSIONS = f"""WITH {SQL_GAPS}, numbered AS (
  SELECT *, sum(restart::BIGINT) OVER (PARTITION BY symbol ORDER BY us, seq ROWS UNBOUNDED PRECEDING)::BIGINT
    AS feed_session FROM gaps)
SELECT seq, feed_session, round(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) OVER (
         PARTITION BY symbol, feed_session ORDER BY us, seq ROWS UNBOUNDED PRECEDING) + 1.3e-9, 6) + 0.0 AS cvd
FROM numbered"""


@query("w8_sessions", SQL_SESSIONS)
def w8(spark, folder):
    numbered = health.sessions(V.trades(spark, folder))
    return V.rounded(flow.volume_delta(numbered, session="feed_session").select("seq", "feed_session", "cvd"))


@query("w9_divergence", f"""WITH {V.MINUTE_BARS}, drifts AS (
  SELECT symbol, window_start, close - lag(close, 5) OVER w AS momentum, cvd_1m - lag(cvd_1m, 5) OVER w AS drift
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY window_start))
SELECT symbol, window_start, round(momentum + 1.3e-9, 6) + 0.0 AS momentum, round(drift + 1.3e-9, 6) + 0.0 AS cvd_drift,
       CASE WHEN momentum > 0 AND drift < 0 THEN 'bearish' WHEN momentum < 0 AND drift > 0 THEN 'bullish'
            ELSE 'none' END AS divergence FROM drifts""")
def w9(spark, folder):
    bars = minute_bars(spark, folder).select("symbol", "window_start", "close", "cvd_1m")
    return V.rounded(serving.divergence(bars).drop("close", "cvd_1m"))


def alert_sql(source: str, period: int) -> str:
    """Follow the sent alerts of each key one after another (alerts: alert_key, us, seq)."""
    return f"""WITH RECURSIVE {source},
first AS (SELECT alert_key, us, arg_min(seq, seq) AS seq FROM alerts GROUP BY 1, 2),
sent AS (
  SELECT alert_key, min(us) AS us FROM first GROUP BY 1
  UNION ALL
  SELECT s.alert_key, min(f.us) FROM sent s JOIN first f ON f.alert_key = s.alert_key AND f.us >= s.us + {period}
  GROUP BY s.alert_key, s.us)"""


SQL_SYMBOL_ALERTS = V.SQL_FEED + ", alerts AS (SELECT symbol AS alert_key, us, seq FROM feed WHERE event_type = 'error')"


def symbol_alerts(feed):
    return feed.filter("event_type = 'error'").select(F.col("symbol").alias("alert_key"), "ts", "seq")


@query("t06_cooldown_batch", alert_sql(SQL_SYMBOL_ALERTS, HOUR)
       + "\nSELECT f.alert_key, f.us, f.seq, s.us IS NOT NULL AS sent FROM first f LEFT JOIN sent s USING (alert_key, us)")
def cooldown_batch(spark, folder):
    return V.with_us(health.cooldown(symbol_alerts(V.events_feed(spark, folder)), period=HOUR))


SQL_LAGS = V.SQL_FEED + """, alerts AS (
  SELECT symbol || '_lag_' || (floor(value)::BIGINT // 100)::VARCHAR AS alert_key, us, seq FROM feed
  WHERE floor(value)::BIGINT > 100)"""


def lag_readings(feed):
    return feed.select(F.col("symbol").alias("topic"), F.floor("value").alias("lag"), "ts", "seq")


@query("t07_lag_batch", f"WITH {SQL_LAGS}\nSELECT alert_key, us, seq FROM alerts")
def lag_batch(spark, folder):
    alerts = health.lag_alerts(lag_readings(V.events_feed(spark, folder)))
    return V.with_us(alerts).select("alert_key", "us", "seq")


@query("q_dup", f"""WITH {V.SQL_FEED},
copies AS (SELECT symbol, event_type, k, count(*) AS n FROM feed GROUP BY ALL)
SELECT symbol, sum(n)::BIGINT AS messages, count(*) AS distinct_messages, sum(n - 1)::BIGINT AS repeats
FROM copies GROUP BY 1""")
def q_dup(spark, folder):
    return quality.duplicates(V.events_feed(spark, folder), ["symbol", "event_type", "k"])


@query("q_change", f"""WITH {V.SQL_TICKS}
SELECT seq, price FROM (SELECT seq, price, lag(price) OVER (PARTITION BY symbol ORDER BY us, seq) AS before FROM ticks)
WHERE before IS DISTINCT FROM price""")
def q_change(spark, folder):
    return quality.price_changes(V.ticks(spark, folder)).select("seq", "price")


@query("q_volume", f"""WITH {V.HOUR_BARS}
SELECT symbol, window_start, num_ticks, round(num_ticks::DOUBLE / 5 + 1.3e-9, 6) + 0.0 AS completeness,
       num_ticks >= 4.5 AS healthy FROM bars""")
def q_volume(spark, folder):
    checked = quality.completeness(hour_bars(spark, folder).select("symbol", "window_start", "num_ticks"), 5)
    return V.rounded(checked)


def with_holes(feed):
    """The feed with fields blanked by kind of event, as messages lacking them would be."""
    return feed.select(
        "symbol", "seq",
        F.when(F.col("event_type") != "error", F.col("price")).alias("price"),
        F.when(~F.col("event_type").isin("error", "view"), F.col("k")).alias("volume"),
    )


@query("q_required", f"""WITH {V.SQL_FEED}
SELECT symbol, count(*) AS messages, count(*) FILTER (event_type = 'error') AS missing_price,
       count(*) FILTER (event_type IN ('error', 'view')) AS missing_volume, count(*) AS missing_side
FROM feed GROUP BY 1""")
def q_required(spark, folder):
    return quality.missing_counts(with_holes(V.events_feed(spark, folder)), ["price", "volume", "side"])


@query("q_required_rows", f"""WITH {V.SQL_FEED}
SELECT seq, CASE WHEN event_type = 'error' THEN 'price,volume' ELSE 'volume' END AS missing
FROM feed WHERE event_type IN ('error', 'view')""")
def q_required_rows(spark, folder):
    rows = quality.missing_fields(with_holes(V.events_feed(spark, folder)), ["price", "volume"])
    return rows.select("seq", F.concat_ws(",", "missing").alias("missing"))


@query("q_negative", f"""WITH {V.SQL_FEED}
SELECT symbol, count(*) FILTER (k - 10 > 0) AS valid, count(*) FILTER (k - 10 <= 0) AS invalid FROM feed GROUP BY 1""")
def q_negative(spark, folder):
    feed = V.events_feed(spark, folder).select("symbol", (F.col("k") - 10).alias("volume"))
    return quality.volume_validity(feed)


@query("q_conservation", f"""WITH {V.HOUR_BARS},
fed AS (SELECT symbol, sum(volume_1s) AS volume_in, count(*) AS ticks_in FROM ticks GROUP BY 1),
made AS (SELECT symbol, sum(total_volume_1m) AS volume_out, sum(num_ticks)::BIGINT AS ticks_out FROM bars GROUP BY 1)
SELECT symbol, round(volume_in + 1.3e-9, 6) + 0.0 AS volume_in, ticks_in, round(volume_out + 1.3e-9, 6) + 0.0 AS volume_out, ticks_out,
       round(volume_in - volume_out + 1.3e-9, 6) + 0.0 AS volume_gap, ticks_in - ticks_out AS ticks_gap
FROM fed JOIN made USING (symbol)""")
def q_conservation(spark, folder):
    return V.rounded(quality.conservation(V.ticks(spark, folder), hour_bars(spark, folder)))


@query("q_monotonic", f"""WITH {V.SQL_FEED},
linked AS (SELECT symbol, us, lag(us) OVER (PARTITION BY symbol ORDER BY arrival) AS before
           FROM (SELECT *, seq // 10 * 10 + (9 - seq % 10) AS arrival FROM feed))
SELECT symbol, count(*) AS messages, count(*) FILTER (before > us) AS backward,
       count(*) FILTER (before > us) = 0 AS monotonic FROM linked GROUP BY 1""")
def q_monotonic(spark, folder):
    # arrival order with every ten messages turned round
    seq = F.col("seq")
    turned = V.events_feed(spark, folder).withColumn("seq", seq - seq % 10 + (9 - seq % 10))
    return quality.backward_steps(turned.select("symbol", "ts", "seq"))
