"""How the given tables are read as market feeds, in Spark and in SQL.

``events`` plays the feed: three symbols, a price per event, `error` events with price 0, an
integer size in the JSON properties. Everything a tick carries is derived from those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.timecols import HOUR, MINUTE, micros
from tapeworks.session import prepare

BUYING = ["purchase", "signup"]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = load(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def feed(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        "user_id", "event_type", "value", k.alias("k"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value") + 100).alias("price"),
        F.when(F.col("event_type").isin(*BUYING), "buy").otherwise("sell").alias("side"),
    )


def as_ticks(feed_: DataFrame) -> DataFrame:
    value, k = F.col("value"), F.col("k").cast("double")
    buy, view = F.col("side") == "buy", F.col("event_type") == "view"
    mid = value + 100

    def only(condition, expr):
        return F.when(condition, expr).otherwise(F.lit(0.0))

    return feed_.select(
        "symbol", "ts", "seq", "price", "side", k.alias("size"),
        k.alias("volume_1s"),
        only(buy, k).alias("buy_volume_1s"),
        only(~buy, k).alias("sell_volume_1s"),
        F.lit(1).cast("long").alias("trade_count_1s"),
        (value * 10).alias("volume_24h"),
        (mid + 5).alias("high_24h"),
        (mid - 5).alias("low_24h"),
        only(buy, k / 10).alias("buy_sell_ratio"),
        only(view, k / 50).alias("bid_ask_spread_1s"),
        (value + k).alias("depth_2pct_1s"),
        value.alias("bid_depth_2pct_1s"),
        k.alias("ask_depth_2pct_1s"),
        F.col("price").alias("vwap_1s"),
        ((k - 50) / 10).alias("micro_price_deviation_1s"),
        (value - k).alias("cvd_1s"),
        (k - 50).alias("ofi_1s"),
        only(F.col("event_type") == "purchase", (k - 50) / (value + 1)).alias("kyles_lambda_1s"),
        (value / 10).alias("liquidity_health_1s"),
        only(view, mid).alias("mid_price_1s"),
        only(view, mid - k / 100).alias("best_bid_1s"),
        only(view, mid + k / 100).alias("best_ask_1s"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ingestion_time"),
    )


def as_trades(feed_: DataFrame) -> DataFrame:
    return feed_.filter(F.col("event_type") != "error").select(
        "symbol", "ts", "seq", "price", F.col("k").cast("double").alias("size"), "side"
    )


def as_quotes(feed_: DataFrame) -> DataFrame:
    mid, k = F.col("value") + 100, F.col("k").cast("double")
    return feed_.filter(F.col("event_type") == "view").select(
        "symbol", "ts", "seq", mid.alias("mid"), (mid - k / 100).alias("bid"), (mid + k / 100).alias("ask")
    )


def as_tickers(feed_: DataFrame) -> DataFrame:
    mid, k = F.col("value") + 100, F.col("k").cast("double")
    return feed_.filter(F.col("event_type") == "view").select(
        "symbol", "ts", "seq", mid.alias("price"), (F.col("value") * 10).alias("volume_24h"),
        (mid + 5).alias("high_24h"), (mid - 5).alias("low_24h"), (mid - 1).alias("open_24h"),
        (mid - k / 100).alias("best_bid"), (mid + k / 100).alias("best_ask"),
    )


def as_changes(feed_: DataFrame) -> DataFrame:
    return feed_.select(
        "symbol", "ts", "seq", F.lit("l2update").alias("kind"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        (F.lit(100.0) + F.col("k") % 40).alias("price"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")).alias("size"),
    )


def events_feed(spark, folder):
    return feed(load(spark, folder, "events"))


def ticks(spark, folder):
    return as_ticks(events_feed(spark, folder))


def trades(spark, folder):
    return as_trades(events_feed(spark, folder))


def quotes(spark, folder):
    return as_quotes(events_feed(spark, folder))


def tickers(spark, folder):
    return as_tickers(events_feed(spark, folder))


def changes(spark, folder):
    return as_changes(events_feed(spark, folder))


def raw_messages(feed_: DataFrame) -> DataFrame:
    """The same feed as JSON text records of the exchange, one topic, some of them broken."""
    text = {c: F.col(c).cast("string") for c in ("value", "k")}
    price = (F.col("value") + 100).cast("string")
    kind = F.col("event_type")
    stamp = [
        F.col("symbol"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), F.col("seq"),
    ]

    def message(label, *fields):
        return F.to_json(F.struct(F.lit(label).alias("type"), *stamp, *fields))

    side = F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell")
    level = (F.lit(100) + F.col("k") % 40).cast("string")
    ticker = message(
        "ticker", F.col("symbol").alias("product_id"), price.alias("price"), text["k"].alias("last_size"),
        (F.col("value") * 10).cast("string").alias("volume_24h"),
        (F.col("value") + 105).cast("string").alias("high_24h"),
        (F.col("value") + 95).cast("string").alias("low_24h"),
    )
    match = message("match", price.alias("price"), text["k"].alias("size"),
                    F.when(kind == "purchase", "buy").otherwise("sell").alias("side"))
    update = message("l2update", F.array(F.array(side, level, text["value"])).alias("changes"))
    record = (
        F.when(kind == "view", ticker)
        .when(kind.isin("purchase", "click"), match)
        .when(kind == "signup", update)
        .otherwise(F.lit("{invalid json}"))
    )
    return feed_.select(F.lit("feed").alias("topic"), record.alias("value"))


# The same views in SQL. All times are epoch microseconds (us).
SQL_FEED = """
feed AS (
  SELECT 'S' || (user_id % 3)::VARCHAR AS symbol, epoch_us(ts) AS us, event_id AS seq, user_id,
         event_type, value, json_extract_string(props, '$.k')::BIGINT AS k,
         CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE value + 100 END AS price,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'buy' ELSE 'sell' END AS side
  FROM events)"""
SQL_TICKS = SQL_FEED + """,
ticks AS (
  SELECT symbol, us, seq, price, side, k::DOUBLE AS size, event_type,
         k::DOUBLE AS volume_1s,
         CASE WHEN side = 'buy' THEN k::DOUBLE ELSE 0 END AS buy_volume_1s,
         CASE WHEN side = 'sell' THEN k::DOUBLE ELSE 0 END AS sell_volume_1s,
         value * 10 AS volume_24h, value + 100 + 5 AS high_24h, value + 100 - 5 AS low_24h,
         CASE WHEN side = 'buy' THEN k::DOUBLE / 10 ELSE 0 END AS buy_sell_ratio,
         CASE WHEN event_type = 'view' THEN k::DOUBLE / 50 ELSE 0 END AS bid_ask_spread_1s,
         value + k AS depth_2pct_1s, value AS bid_depth_2pct_1s, k::DOUBLE AS ask_depth_2pct_1s,
         price AS vwap_1s, (k::DOUBLE - 50) / 10 AS micro_price_deviation_1s,
         value - k AS cvd_1s, k::DOUBLE - 50 AS ofi_1s,
         CASE WHEN event_type = 'purchase' THEN (k::DOUBLE - 50) / (value + 1) ELSE 0 END AS kyles_lambda_1s,
         value / 10 AS liquidity_health_1s,
         CASE WHEN event_type = 'view' THEN value + 100 ELSE 0 END AS mid_price_1s,
         CASE WHEN event_type = 'view' THEN value + 100 - k::DOUBLE / 100 ELSE 0 END AS best_bid_1s,
         CASE WHEN event_type = 'view' THEN value + 100 + k::DOUBLE / 100 ELSE 0 END AS best_ask_1s,
         strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S') AS ingestion_time
  FROM feed)"""
SQL_TRADES = SQL_FEED + """,
trades AS (SELECT symbol, us, seq, price, k::DOUBLE AS size, side FROM feed WHERE event_type <> 'error')"""
SQL_QUOTES = SQL_FEED + """,
quotes AS (
  SELECT symbol, us, seq, value + 100 AS mid, value + 100 - k::DOUBLE / 100 AS bid,
         value + 100 + k::DOUBLE / 100 AS ask
  FROM feed WHERE event_type = 'view')"""
SQL_CHANGES = SQL_FEED + """,
changes AS (
  SELECT symbol, us, seq, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         100.0::DOUBLE + k % 40 AS price,
         CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE value END AS size
  FROM feed)"""


def sql_bars(width: int) -> str:
    """CTE chain that ends in ``bars``: the full bar record, by plain window functions."""

    def positive(src, out):
        return f"coalesce(avg({src}) FILTER ({src} > 0), 0) AS {out}"

    return SQL_TICKS + f""",
priced AS (
  SELECT *, us - us % {width} AS bar FROM ticks),
returned AS (
  SELECT symbol, bar, (price - lag(price) OVER w) / lag(price) OVER w * 100 AS r
  FROM priced WHERE price > 0 WINDOW w AS (PARTITION BY symbol, bar ORDER BY us, seq)),
moved AS (
  SELECT symbol, bar, count(r) AS n, stddev_pop(r) AS sd FROM returned GROUP BY symbol, bar),
grouped AS (
  SELECT symbol, bar,
    arg_min(price, (us, seq)) FILTER (price > 0) AS open, max(price) FILTER (price > 0) AS high,
    min(price) FILTER (price > 0) AS low, arg_max(price, (us, seq)) FILTER (price > 0) AS close,
    sum(volume_1s) AS total_volume_1m, sum(buy_volume_1s) AS total_buy_volume_1m,
    sum(sell_volume_1s) AS total_sell_volume_1m,
    arg_max(volume_24h, (us, seq)) AS volume_24h, arg_max(high_24h, (us, seq)) AS high_24h,
    arg_max(low_24h, (us, seq)) AS low_24h, count(*) AS trade_count_1m, count(*) AS num_ticks,
    arg_max(ingestion_time, (us, seq)) AS last_ingestion_time,
    {positive('buy_sell_ratio', 'avg_buy_sell_ratio_1m')},
    {positive('bid_ask_spread_1s', 'avg_bid_ask_spread_1m')},
    {positive('depth_2pct_1s', 'avg_depth_2pct_1m')},
    {positive('bid_depth_2pct_1s', 'avg_bid_depth_2pct_1m')},
    {positive('ask_depth_2pct_1s', 'avg_ask_depth_2pct_1m')},
    {positive('vwap_1s', 'avg_vwap_1m')},
    avg(micro_price_deviation_1s) AS avg_micro_price_deviation_1m,
    arg_max(cvd_1s, (us, seq)) AS cvd_1m, sum(ofi_1s) AS total_ofi_1m, avg(ofi_1s) AS avg_ofi_1m,
    coalesce(avg(kyles_lambda_1s) FILTER (kyles_lambda_1s <> 0), 0) AS avg_kyles_lambda_1m,
    {positive('liquidity_health_1s', 'avg_liquidity_health_1m')},
    {positive('mid_price_1s', 'avg_mid_price_1m')},
    arg_max(best_bid_1s, (us, seq)) AS latest_best_bid_1m,
    arg_max(best_ask_1s, (us, seq)) AS latest_best_ask_1m
  FROM priced GROUP BY symbol, bar),
valued AS (
  SELECT g.*, CASE WHEN m.n > 1 THEN m.sd ELSE (high - low) / open * 100 END AS volatility_1m
  FROM grouped g JOIN moved m USING (symbol, bar) WHERE open IS NOT NULL),
bars AS (
  SELECT symbol, bar // 1000 AS window_start, (bar + {width}) // 1000 AS window_end,
    strftime(timezone('America/New_York', make_timestamptz(bar)), '%Y-%m-%d %H:%M:%S') AS window_start_est,
    open, high, low, close, total_volume_1m, total_buy_volume_1m, total_sell_volume_1m, volume_24h,
    high_24h, low_24h, volatility_1m,
    CASE WHEN total_buy_volume_1m + total_sell_volume_1m > 0
         THEN (total_buy_volume_1m - total_sell_volume_1m) / (total_buy_volume_1m + total_sell_volume_1m)
         ELSE 0 END AS order_imbalance_ratio_1m,
    trade_count_1m, avg_buy_sell_ratio_1m, close - open AS price_change_1m,
    (close - open) / open * 100 AS price_change_percent_1m, num_ticks, last_ingestion_time,
    avg_bid_ask_spread_1m, avg_depth_2pct_1m, avg_bid_depth_2pct_1m, avg_ask_depth_2pct_1m, avg_vwap_1m,
    avg_micro_price_deviation_1m, cvd_1m, total_ofi_1m, avg_ofi_1m, avg_kyles_lambda_1m,
    avg_liquidity_health_1m, avg_mid_price_1m, latest_best_bid_1m, latest_best_ask_1m,
    CASE WHEN volatility_1m < 0.1 THEN 'low' WHEN volatility_1m < 0.5 THEN 'medium' ELSE 'high' END
      AS volatility_regime
  FROM valued)"""


HOUR_BARS, MINUTE_BARS = sql_bars(HOUR), sql_bars(MINUTE)


# Means of a few short decimals often end exactly half-way, where the two engines round
# differently. Both sides of a comparison add this much before rounding.
NUDGE = 1.3e-9


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison (adding 0 turns -0 into 0)."""
    return df.select([
        (F.round(F.col(f"`{n}`") + NUDGE, digits) + F.lit(0.0)).alias(n) if kind == "double" else F.col(f"`{n}`")
        for n, kind in df.dtypes
    ])


def with_us(df: DataFrame, name: str = "us") -> DataFrame:
    """Event time as epoch microseconds, which both engines write alike."""
    return df.withColumn(name, micros(F.col("ts"))).drop("ts")


def sql(ctes: str, doubles: str = "", plain: str = "", source: str = "", tail: str = "", digits: int = 6) -> str:
    """WITH ctes SELECT plain columns and rounded doubles FROM source."""
    columns = [c for c in plain.split() if c]
    columns += [f"round({c} + 1.3e-9, {digits}) + 0.0 AS {c}" for c in doubles.split()]
    return f"WITH {ctes.strip()}\nSELECT {', '.join(columns)}\nFROM {source} {tail}"


