"""Queries: streams drained over everything available."""

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.aggregates import DOUBLES, PLAIN, hour_bars, sql_books
from tapeworks.catalog.ordered import SQL_LAGS, SQL_SESSIONS, SQL_SYMBOL_ALERTS, alert_sql, lag_readings, symbol_alerts
from tapeworks.catalog.registry import query
from tapeworks.catalog.storage import HOUR_SPAN, NOW, stamp
from tapeworks.functions.timecols import DAY, HOUR, MINUTE, SECOND, micros
from tapeworks.plans import ticks as tick_plan
from tapeworks.schemas import BAR_SCHEMA, TICK_SCHEMA
from tapeworks.session import work_folder
from tapeworks.sources import tables, topics
from tapeworks.streaming import alerts, bars, book, state, ticks
from tapeworks.streaming.drain import drain, dropped_late
from tapeworks.streaming.upsert import upsert_stream


def feed(spark, folder):
    return V.feed(V.stream(spark, folder, "events"))


@query("t01_bars", V.sql(V.MINUTE_BARS, DOUBLES, PLAIN, "bars",
                         f"WHERE window_end * 1000 <= (SELECT max(us) FROM ticks) - {5 * MINUTE}"))
def t01(spark, folder):
    rows, _ = drain(bars.streaming_bars(V.as_ticks(feed(spark, folder))))
    return V.rounded(rows)


@query("t01_hour_bars", V.sql(V.HOUR_BARS, DOUBLES, PLAIN, "bars",
                              f"WHERE window_end * 1000 <= (SELECT max(us) FROM ticks) - {5 * MINUTE}"))
def t01_hours(spark, folder):
    made = bars.streaming_bars(V.as_ticks(feed(spark, folder)), "1 hour", HOUR, sub="10 minutes")
    return V.rounded(drain(made)[0])


@query("t02_book", f"""WITH {sql_books(DAY)},
seen AS (SELECT DISTINCT symbol, us - us % {DAY} AS bucket FROM changes),
sides AS (SELECT symbol, bucket, count(*) FILTER (side = 'buy') AS n_bids, count(*) FILTER (side = 'sell') AS n_asks,
                 max(price) FILTER (side = 'buy') AS best_bid, min(price) FILTER (side = 'sell') AS best_ask,
                 sum(size) AS total FROM books GROUP BY 1, 2)
SELECT symbol, bucket, coalesce(n_bids, 0) AS n_bids, coalesce(n_asks, 0) AS n_asks, best_bid, best_ask,
       round(coalesce(total, 0) + 1.3e-9, 6) + 0.0 AS total_size
FROM seen LEFT JOIN sides USING (symbol, bucket)
QUALIFY bucket < max(bucket) OVER (PARTITION BY symbol)""")
def t02(spark, folder):
    return book_by(spark, folder, DAY)


def book_by(spark, folder, step):
    rows, _ = drain(book.streaming_quotes(V.as_changes(feed(spark, folder)), step))

    def total(side):
        return F.aggregate(side, F.lit(0.0), lambda t, x: t + x["size"])

    return V.rounded(rows.select(
        "symbol", "bucket", F.size("bids").cast("long").alias("n_bids"), F.size("asks").cast("long").alias("n_asks"),
        F.get("bids", F.lit(0))["price"].alias("best_bid"), F.get("asks", F.lit(0))["price"].alias("best_ask"),
        (total("bids") + total("asks")).alias("total_size"),
    ))


@query("t04_state", f"""WITH {V.SQL_TRADES}
SELECT symbol, us, seq, price, lag(price) OVER w AS previous_price,
       round(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) OVER w + 1.3e-9, 6) + 0.0 AS cvd
FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY us, seq ROWS UNBOUNDED PRECEDING)""")
def t04(spark, folder):
    rows, _ = drain(state.streaming_trades(V.as_trades(feed(spark, folder))))
    return V.rounded(rows.drop("feed_session"))


# trades that the watermark, in milliseconds, has passed
@query("t04_ordered", f"""WITH {V.SQL_TRADES}
SELECT symbol, us, seq, price, lag(price) OVER w AS previous_price,
       round(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) OVER w + 1.3e-9, 6) + 0.0 AS cvd
FROM trades WHERE us < (SELECT max(us) // 1000 * 1000 FROM trades) - {DAY}
WINDOW w AS (PARTITION BY symbol ORDER BY us, seq ROWS UNBOUNDED PRECEDING)""")
def t04_ordered(spark, folder):
    """Four micro-batches by time; of the trades in the last 23 hours of each, every other one comes a batch late."""
    landed = work_folder(spark, "trades")
    rows = V.as_trades(V.feed(spark.read.parquet(f"{folder}/events.parquet")))
    us = micros(F.col("ts"))
    low, high = rows.agg(F.min(us), F.max(us)).first()
    seen_at = F.when(F.col("seq") % 2 == 0, us + 23 * HOUR).otherwise(us)
    batch = F.least(F.lit(3), F.floor((seen_at - (low or 0)) * 4 / ((high or 0) - (low or 0) + 1)))
    place = work_folder(spark, "stream")
    for number in range(4):  # the query goes on from its checkpoint with what has landed since
        rows.filter(batch == number).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(rows.schema).parquet(landed)
        made, _ = drain(state.ordered_trades(stream, "1 day"), place)
    return V.rounded(made.drop("feed_session"))


@query("t04_sessions", SQL_SESSIONS)
def t04_sessions(spark, folder):
    """The running delta of the stream, started again with each feed session."""
    rows, _ = drain(state.streaming_trades(V.as_trades(feed(spark, folder)), sessions=True))
    return V.rounded(rows.select("seq", "feed_session", "cvd"))


# every check after a message, up to the next message or, for the last one, the end of the feed
@query("t05_stale", f"""WITH {V.SQL_FEED},
linked AS (SELECT symbol AS component, us // 1000 AS ms, lead(us // 1000) OVER (PARTITION BY symbol ORDER BY us, seq) AS after
           FROM feed),
ends AS (SELECT component, ms, coalesce(after, (SELECT max(us) // 1000 FROM feed) + 1) AS until FROM linked),
listed AS (SELECT component, ms, list_filter(generate_series(ms - ms % 600000, until, 600000),
                                             lambda c: c - ms > 1800000 AND c < until)[1:3] AS checks FROM ends),
each AS (SELECT component, ms AS last_ms, unnest(checks) AS check_ms, generate_subscripts(checks, 1) AS strike FROM listed)
SELECT component, last_ms, check_ms, strike, strike = 3 AS restart FROM each""")
def t05(spark, folder):
    messages = feed(spark, folder).select(F.col("symbol").alias("component"), "ts")
    checks = alerts.stale_checks(messages, stale_after=1800 * SECOND, every=600 * SECOND)
    return drain(checks)[0].withColumn("strike", F.col("strike").cast("long"))


@query("t06_cooldown", alert_sql(SQL_SYMBOL_ALERTS, HOUR)
       + "\nSELECT alert_key, us, f.seq FROM first f JOIN sent s USING (alert_key, us)")
def t06(spark, folder):
    return drain(alerts.streaming_cooldown(symbol_alerts(feed(spark, folder)), HOUR))[0]


@query("t07_lag", alert_sql(SQL_LAGS, HOUR)
       + "\nSELECT alert_key, us, f.seq FROM first f JOIN sent s USING (alert_key, us)")
def t07(spark, folder):
    return drain(alerts.streaming_lag_alerts(lag_readings(feed(spark, folder)), HOUR))[0]


# Sells are not refused yet: the filter runs with the watermark of the batch before. Errors
# are, wherever their hour ended before the newest buy less the lateness.
@query("t08_late", f"""WITH {V.SQL_TICKS},
hours AS (SELECT symbol, side, price, us - us % {HOUR} + {HOUR} AS closes,
                 (SELECT max(us) FROM ticks WHERE side = 'buy' ) - {5 * MINUTE} AS mark,
                 (SELECT max(us) FROM ticks) - {5 * MINUTE} AS final FROM ticks),
judged AS (SELECT *, price = 0 AND closes <= mark AS late FROM hours)
SELECT count(*) FILTER (NOT late AND closes <= final) AS ticks_counted,
       count(DISTINCT (symbol, closes)) FILTER (late) AS groups_dropped FROM judged""")
def t08(spark, folder):
    """Buys arrive first, sells next, errors last: by then the watermark is past most of them."""
    landed = work_folder(spark, "late")
    rows = V.ticks(spark, folder).select("symbol", "ts", "seq", "price", "side")
    known = set()
    for hour, part in enumerate(("side = 'buy'", "side = 'sell' AND price > 0", "price = 0")):
        rows.filter(part).repartition(4).write.mode("append").parquet(landed)
        known |= stamp(spark, landed, NOW + hour * HOUR_SPAN, known)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(landed)
    hours = (
        stream.withWatermark("ts", "5 minutes").groupBy("symbol", F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("ticks"))
    )
    counted, done = drain(hours.select("symbol", F.col("w.start").alias("start"), "ticks"))
    return counted.agg(F.sum("ticks").alias("ticks_counted")).withColumn(
        "groups_dropped", F.lit(dropped_late(done)).cast("long")
    )


@query("t10_dedupe", f"""WITH {V.SQL_FEED} SELECT symbol, us, seq FROM feed""")
def t10(spark, folder):
    """The feed delivered twice; each message must come out once."""
    twice = feed(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = alerts.streaming_dedupe(twice, ["symbol", "seq", "price", "k"])
    return drain(V.with_us(once).select("symbol", "us", "seq"))[0]


@query("t09_chain", V.sql(V.MINUTE_BARS, DOUBLES, PLAIN, "bars",
                          f"WHERE window_end * 1000 <= (SELECT max(us) FROM ticks) - {5 * MINUTE}"))
def t09(spark, folder):
    """Ticks topic -> bar stream -> bars topic -> hour folders, each query with its own checkpoint."""
    place = work_folder(spark, "chain")
    made = V.ticks(spark, folder)
    topics.publish(made, format="text", path=f"{place}/ticks")
    read = topics.decoded(topics.read_topic(spark, "text", f"{place}/ticks"), made.schema)
    topics.write_topic(bars.streaming_bars(read), f"{place}/c1", "text", f"{place}/bars", available_now=True).awaitTermination()
    landed = topics.decoded(topics.read_topic(spark, "text", f"{place}/bars"), BAR_SCHEMA).select(*BAR_SCHEMA.names)
    tables.stream_bars(landed, f"{place}/table", f"{place}/c2", available_now=True).awaitTermination()
    return V.rounded(tables.bar_table(spark, f"{place}/table").drop(*tables.FOLDERS))


@query("u3_stream", f"""WITH {V.HOUR_BARS}
SELECT symbol, window_start, round(close + 1.3e-9, 6) + 0.0 AS close FROM bars""")
def u3_stream(spark, folder):
    """An early edition of some bars, then all of them, merged by micro-batches; no bar is doubled."""
    place, made = work_folder(spark, "upsert"), hour_bars(spark, folder)
    early = made.filter("symbol <> 'S1'").withColumn("close", F.col("close") + 1)
    known = set()
    for hour, edition in enumerate((early, made)):
        edition.repartition(2).write.mode("append").parquet(f"{place}/landed")
        known |= stamp(spark, f"{place}/landed", NOW + hour * HOUR_SPAN, known)
    landed = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 2).parquet(f"{place}/landed")
    upsert_stream(landed, f"{place}/table", f"{place}/checkpoint", available_now=True).awaitTermination()
    return V.rounded(tables.bar_table(spark, f"{place}/table").select("symbol", "window_start", "close"))


# The hours of the feed stand in for seconds, and the horizons are stretched alike.
SPANS = {"1s": HOUR, "1min": 6 * HOUR, "1h": DAY, "24h": 3 * DAY}


def _ticks_sql(step: int = HOUR, spans: dict[str, int] = SPANS) -> str:
    metrics = []
    for name, width in spans.items():
        label = "24h_calculated" if name == "24h" else name
        over = f"OVER (PARTITION BY symbol ORDER BY ts RANGE BETWEEN {width - 1} PRECEDING AND CURRENT ROW)"
        if name != "24h":
            first = f"first_value(price) {over}"
            metrics += [f"max(price) {over} AS high_{label}", f"min(price) {over} AS low_{label}",
                        f"price - {first} AS price_change_{label}",
                        f"(price - {first}) / {first} * 100 AS price_change_percent_{label}"]
        if name != "1s":
            metrics += [f"sum(buy + sell) {over} AS volume_{label}", f"sum(buy) {over} AS buy_volume_{label}",
                        f"sum(sell) {over} AS sell_volume_{label}"]
    doubles = [f.name for f in TICK_SCHEMA if f.dataType.simpleString() == "double"]
    plain = [f.name for f in TICK_SCHEMA if f.dataType.simpleString() != "double"]
    return f"""WITH {sql_books(step)},
trades AS (SELECT symbol, us, seq, price, k::DOUBLE AS size, side,
                  price - lag(price) OVER (PARTITION BY symbol ORDER BY us, seq) AS dp
           FROM feed WHERE event_type <> 'error'),
flow AS (
  SELECT symbol, us - us % {step} AS bucket, coalesce(sum(size) FILTER (side = 'buy'), 0) AS buy,
    coalesce(sum(size) FILTER (side = 'sell'), 0) AS sell, count(*) AS n, arg_max(price, (us, seq)) AS last_price,
    coalesce(sum(price * size) FILTER (size > 0) / sum(size) FILTER (size > 0), 0) AS vwap, avg(price) AS avg_price,
    sum(dp) AS dp, sum(CASE WHEN side = 'buy' THEN size ELSE -size END) FILTER (dp IS NOT NULL) AS sv
  FROM trades GROUP BY 1, 2),
orders AS (SELECT symbol, us - us % {step} AS bucket, sum(CASE WHEN side = 'buy' THEN size ELSE -size END) AS ofi
           FROM changes GROUP BY 1, 2),
shown AS (SELECT symbol, us - us % {step} AS bucket, arg_max(value, (us, seq)) AS v, arg_max(k, (us, seq)) AS k
          FROM feed WHERE event_type = 'view' GROUP BY 1, 2),
tops AS (SELECT symbol, bucket, max(price) FILTER (side = 'buy') AS bid, min(price) FILTER (side = 'sell') AS ask
         FROM books GROUP BY 1, 2),
state AS (
  SELECT i.symbol, i.bucket, coalesce(buy, 0) AS buy, coalesce(sell, 0) AS sell, coalesce(n, 0) AS n,
    coalesce(vwap, 0) AS vwap, avg_price, coalesce(ofi, 0) AS ofi, bid, ask,
    CASE WHEN sv <> 0 THEN dp / sv ELSE 0 END AS impact,
    last_value(last_price IGNORE NULLS) OVER w AS price, last_value(v IGNORE NULLS) OVER w AS v,
    last_value(k IGNORE NULLS) OVER w AS k, sum(coalesce(buy - sell, 0)) OVER w AS cvd
  FROM instants i LEFT JOIN flow USING (symbol, bucket) LEFT JOIN orders USING (symbol, bucket)
    LEFT JOIN shown USING (symbol, bucket) LEFT JOIN tops USING (symbol, bucket)
  WINDOW w AS (PARTITION BY i.symbol ORDER BY i.bucket)),
quoted AS (
  SELECT *, bucket + {step} AS ts, CASE WHEN bid > 0 AND ask > 0 THEN bid ELSE v + 100 - k::DOUBLE / 100 END AS best_bid,
    CASE WHEN bid > 0 AND ask > 0 THEN ask ELSE v + 100 + k::DOUBLE / 100 END AS best_ask
  FROM state WHERE v IS NOT NULL),
middle AS (SELECT *, (best_bid + best_ask) / 2 AS mid, best_ask - best_bid AS spread FROM quoted),
depths AS (
  SELECT m.symbol, m.bucket, sum(size) FILTER (side = 'buy' AND price_ >= mid * 0.98) AS bid_depth,
         sum(size) FILTER (side = 'sell' AND price_ <= mid * 1.02) AS ask_depth
  FROM middle m JOIN (SELECT symbol, bucket, side, price AS price_, size FROM books) b USING (symbol, bucket)
  GROUP BY 1, 2),
horizon AS (SELECT symbol, bucket, {', '.join(metrics)} FROM middle),
ticks_ AS (
  SELECT m.symbol, price, ts // 1000 AS "timestamp", v * 10 AS volume_24h, v + 105 AS high_24h, v + 95 AS low_24h,
    price - (v + 99) AS price_change_24h, (price - (v + 99)) / (v + 99) * 100 AS price_change_percent_24h,
    n AS number_of_trades, n AS trade_count_1s, h.*, buy + sell AS volume_1s, buy AS buy_volume_1s,
    sell AS sell_volume_1s, CASE WHEN sell > 0 THEN buy / sell ELSE 0 END AS buy_sell_volume_ratio_1s,
    CASE WHEN sell > 0 THEN buy / sell ELSE 0 END AS buy_sell_ratio, spread AS bid_ask_spread_1s,
    mid AS mid_price_1s, best_bid AS best_bid_1s, best_ask AS best_ask_1s,
    coalesce(bid_depth, 0) AS bid_depth_2pct_1s, coalesce(ask_depth, 0) AS ask_depth_2pct_1s,
    coalesce(bid_depth, 0) + coalesce(ask_depth, 0) AS depth_2pct_1s, vwap AS vwap_1s,
    CASE WHEN mid > 0 THEN coalesce(avg_price - mid, 0) ELSE 0 END AS micro_price_deviation_1s, cvd AS cvd_1s,
    ofi AS ofi_1s, impact AS kyles_lambda_1s,
    strftime(timezone('America/New_York', make_timestamptz(ts)), '%Y-%m-%dT%H:%M:%S.%f') || '-05:00' AS ingestion_time
  FROM middle m LEFT JOIN depths d USING (symbol, bucket)
    JOIN (SELECT * RENAME (symbol AS s_, bucket AS b_) FROM horizon) h ON h.s_ = m.symbol AND h.b_ = m.bucket),
healthy AS (
  SELECT *, CASE WHEN bid_ask_spread_1s > 0 THEN depth_2pct_1s / (bid_ask_spread_1s *
    CASE WHEN price_change_percent_1s <> 0 THEN abs(price_change_percent_1s) ELSE 1 END) ELSE 0 END AS liquidity_health_1s
  FROM ticks_)
SELECT {', '.join(plain)}, {', '.join(f'round({c} + 1.3e-9, 6) + 0.0 AS {c}' for c in doubles)} FROM healthy"""


@query("t03_ticks", _ticks_sql())
def t03(spark, folder):
    feeds = V.trades(spark, folder), V.tickers(spark, folder), V.changes(spark, folder)
    return V.rounded(tick_plan.ticks(*feeds, step=HOUR, widths=SPANS))


def streamed_ticks_sql(step: int, spans: dict[str, int]) -> str:
    """Up to the last closed step in which the symbol had messages: later ones are filled by the next."""
    return _ticks_sql(step, spans) + f"""
WHERE "timestamp" <= (SELECT max(us - us % {step} + {step}) // 1000 FROM feed f WHERE f.symbol = healthy.symbol
                      AND us - us % {step} + {step} <= (SELECT max(us) FROM feed) - {5 * MINUTE})"""


def streamed_ticks(feed_):
    """The tick table by the second, from a stream of the feed."""
    feeds = (as_(feed_) for as_ in (V.as_trades, V.as_tickers, V.as_changes))
    return V.rounded(drain(ticks.streaming_ticks(*feeds, lateness="5 minutes"))[0])


# The SQL lays out every level at every second, which the 30 days of the feed are too long for; it stands beside
# t03_ticks_stream_dense.
@query("t03_ticks_stream")
def t03_stream(spark, folder):
    return streamed_ticks(feed(spark, folder))
