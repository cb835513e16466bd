"""Queries: formulas and time columns, row by row."""

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.registry import query
from tapeworks.functions import scalars as S
from tapeworks.functions import timecols as T

TICKS = V.SQL_TICKS


def per_tick(spark, folder, digits=6, **columns):
    return V.rounded(V.ticks(spark, folder).select("seq", *[c.alias(n) for n, c in columns.items()]), digits)


def tick_sql(expression: str, name: str, digits: int = 6) -> str:
    return f"WITH {TICKS}\nSELECT seq, round({expression} + 1.3e-9, {digits}) + 0.0 AS {name} FROM ticks"


BID, ASK = "best_bid_1s", "best_ask_1s"


@query("p01_spread", tick_sql(f"CASE WHEN {BID} > 0 AND {ASK} > 0 THEN {ASK} - {BID} ELSE 0 END", "spread"))
def p01(spark, folder):
    return per_tick(spark, folder, spread=S.spread(F.col(BID), F.col(ASK)))


@query("p02_mid", tick_sql(f"CASE WHEN {BID} > 0 AND {ASK} > 0 THEN ({ASK} + {BID}) / 2 ELSE 0 END", "mid"))
def p02(spark, folder):
    return per_tick(spark, folder, mid=S.mid_price(F.col(BID), F.col(ASK)))


@query("p03_micro_dev", tick_sql("CASE WHEN mid_price_1s > 0 THEN high_24h - mid_price_1s ELSE 0 END", "deviation"))
def p03(spark, folder):
    return per_tick(spark, folder, deviation=S.micro_deviation(F.col("high_24h"), F.col("mid_price_1s")))


@query("p04_ofi", tick_sql("bid_depth_2pct_1s - ask_depth_2pct_1s", "ofi"))
def p04(spark, folder):
    flow = S.order_flow_imbalance(F.col("bid_depth_2pct_1s"), F.col("ask_depth_2pct_1s"))
    return per_tick(spark, folder, ofi=flow)


@query("p05_lambda", tick_sql("CASE WHEN ofi_1s <> 0 THEN cvd_1s / ofi_1s ELSE 0 END", "impact", 8))
def p05(spark, folder):
    return per_tick(spark, folder, 8, impact=S.price_impact(F.col("cvd_1s"), F.col("ofi_1s")))


@query("p06_health", tick_sql(
    """CASE WHEN bid_ask_spread_1s <= 0 THEN 0
            WHEN cvd_1s > 0 THEN depth_2pct_1s / (bid_ask_spread_1s * cvd_1s)
            ELSE depth_2pct_1s END""", "health"))
def p06(spark, folder):
    health = S.liquidity_health(F.col("depth_2pct_1s"), F.col("bid_ask_spread_1s"), F.col("cvd_1s"))
    return per_tick(spark, folder, health=health)


@query("p07_change", f"""WITH {TICKS}
SELECT seq, round(price - low_24h + 1.3e-9, 6) + 0.0 AS change,
       round(CASE WHEN price > 0 THEN (low_24h - price) / price * 100 ELSE 0 END + 1.3e-9, 6) + 0.0 AS change_percent
FROM ticks""")
def p07(spark, folder):
    price, low = F.col("price"), F.col("low_24h")
    return per_tick(spark, folder, change=S.change(low, price), change_percent=S.change_percent(price, low))


@query("p08_ratio", tick_sql(
    "CASE WHEN ask_depth_2pct_1s > 0 THEN bid_depth_2pct_1s / ask_depth_2pct_1s ELSE 0 END", "ratio", 8))
def p08(spark, folder):
    ratio = S.buy_sell_ratio(F.col("bid_depth_2pct_1s"), F.col("ask_depth_2pct_1s"))
    return per_tick(spark, folder, 8, ratio=ratio)


@query("p09_imbalance", f"""WITH {TICKS},
hours AS (SELECT symbol, us - us % {T.HOUR} AS bucket, sum(buy_volume_1s) AS b, sum(sell_volume_1s) AS s
          FROM ticks GROUP BY ALL)
SELECT symbol, bucket, round(CASE WHEN b + s > 0 THEN (b - s) / (b + s) ELSE 0 END + 1.3e-9, 6) + 0.0 AS imbalance
FROM hours""")
def p09(spark, folder):
    hours = V.ticks(spark, folder).groupBy(
        "symbol", T.floor_to(T.micros(F.col("ts")), T.HOUR).alias("bucket")
    ).agg(F.sum("buy_volume_1s").alias("b"), F.sum("sell_volume_1s").alias("s"))
    ratio = S.imbalance_ratio(F.col("b"), F.col("s"))
    return V.rounded(hours.select("symbol", "bucket", ratio.alias("imbalance")))


@query("p10_regime", f"""WITH {TICKS}
SELECT seq, CASE WHEN bid_ask_spread_1s < 0.1 THEN 'low' WHEN bid_ask_spread_1s < 0.5 THEN 'medium'
                 ELSE 'high' END AS regime FROM ticks""")
def p10(spark, folder):
    return per_tick(spark, folder, regime=S.volatility_regime(F.col("bid_ask_spread_1s")))


@query("p11_price_choice", f"""WITH {TICKS}
SELECT seq, round(CASE WHEN price > 0 THEN price ELSE high_24h END + 1.3e-9, 6) + 0.0 AS price
FROM ticks WHERE high_24h > 110""")
def p11(spark, folder):
    ticker = F.col("high_24h")
    shown = V.ticks(spark, folder).filter(ticker > 110)
    return V.rounded(shown.select("seq", S.current_price(F.col("price"), ticker).alias("price")))


@query("p12_quote_choice", tick_sql(
    f"""CASE WHEN {BID} > 0 AND {ASK} > 0 THEN {BID} WHEN price > 0 THEN low_24h ELSE 0 END""", "bid"))
def p12(spark, folder):
    book_ready = (F.col(BID) > 0) & (F.col(ASK) > 0)
    bid = S.choose_quote(F.col(BID), F.col("low_24h"), book_ready, F.col("price") > 0)
    return per_tick(spark, folder, bid=bid)


@query("p13_default_positive", f"""WITH {TICKS}
SELECT seq, round(price + 1.3e-9, 6) + 0.0 AS price, round(coalesce(CASE WHEN side = 'buy' THEN size END, 0) + 1.3e-9, 6) + 0.0 AS volume
FROM ticks WHERE price > 0""")
def p13(spark, folder):
    volume = S.or_zero(F.when(F.col("side") == "buy", F.col("size")))
    return V.rounded(V.ticks(spark, folder).filter("price > 0").select("seq", "price", volume.alias("volume")))


@query("p14_minute_floor", f"""WITH {TICKS}
SELECT seq, (us - us % 60000000) // 1000 AS window_start, (us - us % 60000000) // 1000 + 60000 AS window_end
FROM ticks""")
def p14(spark, folder):
    start = T.floor_to(T.micros(F.col("ts")), T.MINUTE)
    return per_tick(spark, folder, window_start=T.millis(start), window_end=T.millis(start + T.MINUTE))


@query("p15_epoch_to_ts", f"""WITH {TICKS}
SELECT seq, strftime(make_timestamp(us // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%g') AS utc_text,
       strftime(timezone('America/New_York', make_timestamptz(us // 1000 * 1000)), '%Y-%m-%d %H:%M:%S.%g') AS local_text
FROM ticks""")
def p15(spark, folder):
    back = F.timestamp_millis(T.millis(T.micros(F.col("ts"))))
    pattern = "yyyy-MM-dd HH:mm:ss.SSS"
    return per_tick(spark, folder, utc_text=F.date_format(back, pattern),
                    local_text=F.date_format(T.local_time(back), pattern))


@query("p16_zone_text", """
WITH days AS (SELECT l_shipdate AS ts, count(*) AS n,
                     timezone('America/New_York', make_timestamptz(epoch_us(l_shipdate))) AS local
              FROM lineitem GROUP BY 1)
SELECT epoch_us(ts) AS us, n, strftime(local, '%Y-%m-%d %H:%M:%S') AS window_start_est,
       strftime(local, '%Y-%m-%dT%H:%M:%S.%f') || CASE (epoch_us(ts) - epoch_us(local)) // 3600000000
         WHEN 5 THEN '-05:00' WHEN 4 THEN '-04:00' ELSE '?' END AS ingestion_time,
       strftime(local, '%Y') AS year, strftime(local, '%m') AS month, strftime(local, '%d') AS day,
       strftime(local, '%H') AS hour
FROM days""")
def p16(spark, folder):
    ts = F.col("l_shipdate").cast("timestamp")
    days = V.load(spark, folder, "lineitem").groupBy(ts.alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    at = F.col("ts")
    return days.select(
        T.micros(at).alias("us"), "n", T.zone_text(at).alias("window_start_est"),
        T.iso_text(at).alias("ingestion_time"), *[c.alias(n) for n, c in T.folder_keys(at).items()],
    )
