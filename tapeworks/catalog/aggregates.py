"""Queries: bars and their parts, trade flow, book aggregates."""

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.registry import query
from tapeworks.functions.timecols import DAY, HOUR, MINUTE, SECOND
from tapeworks.operators import bars as B
from tapeworks.operators import book, flow, health, serving
from tapeworks.schemas import BAR_SCHEMA

DOUBLES = " ".join(f.name for f in BAR_SCHEMA if f.dataType.simpleString() == "double")
PLAIN = " ".join(f.name for f in BAR_SCHEMA if f.dataType.simpleString() != "double")


def hour_bars(spark, folder):
    return B.bars(V.ticks(spark, folder), HOUR)


def minute_bars(spark, folder):
    return B.bars(V.ticks(spark, folder), MINUTE)


def part_of_bars(name: str, plain: str, doubles: str, width: int = HOUR):
    """Register a query for some columns of the bar; Catalyst drops what they do not need."""
    sql = V.sql(V.sql_bars(width), doubles, f"symbol window_start {plain}", "bars")

    @query(name, sql)
    def run(spark, folder):
        made = B.bars(V.ticks(spark, folder), width)
        return V.rounded(made.select("symbol", "window_start", *plain.split(), *doubles.split()))


part_of_bars("a01_ohlc", "", "open high low close", MINUTE)
part_of_bars("a02_volume", "trade_count_1m num_ticks", "total_volume_1m total_buy_volume_1m total_sell_volume_1m")
part_of_bars("a03_last", "last_ingestion_time",
             "volume_24h high_24h low_24h cvd_1m latest_best_bid_1m latest_best_ask_1m")
part_of_bars("a04_volatility", "volatility_regime", "volatility_1m")
part_of_bars("a05_pos_mean", "",
             "avg_buy_sell_ratio_1m avg_bid_ask_spread_1m avg_depth_2pct_1m avg_bid_depth_2pct_1m "
             "avg_ask_depth_2pct_1m avg_vwap_1m avg_liquidity_health_1m avg_mid_price_1m")
part_of_bars("a06_nonzero_mean", "", "avg_kyles_lambda_1m")
part_of_bars("a07_plain_mean", "", "avg_micro_price_deviation_1m total_ofi_1m avg_ofi_1m")


@query("a08_bar", V.sql(V.HOUR_BARS, DOUBLES, PLAIN, "bars"))
def a08(spark, folder):
    return V.rounded(hour_bars(spark, folder))


@query("a08_minute_bar", V.sql(V.MINUTE_BARS, DOUBLES, PLAIN, "bars"))
def a08_minute(spark, folder):
    return V.rounded(minute_bars(spark, folder))


# the cap filters the feed, so the rest of the chain is the ordinary one over 5 ticks per hour
_CAPPED = V.HOUR_BARS.replace(
    f"SELECT *, us - us % {HOUR} AS bar FROM ticks",
    f"""SELECT *, us - us % {HOUR} AS bar FROM ticks
  QUALIFY row_number() OVER (PARTITION BY symbol, us - us % {HOUR} ORDER BY us DESC, seq DESC) <= 5""",
)


@query("a09_cap", V.sql(_CAPPED, DOUBLES, PLAIN, "bars"))
def a09(spark, folder):
    return V.rounded(B.bars(V.ticks(spark, folder), HOUR, max_ticks=5))


@query("a10_hour_buffer", f"""WITH {V.MINUTE_BARS}
SELECT symbol, window_start - window_start % 3600000 AS hour_start, count(*) AS rows_in_hour,
       count(*) = 60 AS complete, min(window_start) AS first_start, max(window_start) AS last_start,
       round(sum(close) + 1.3e-9, 6) + 0.0 AS close_sum
FROM bars GROUP BY 1, 2""")
def a10(spark, folder):
    buffers = B.hour_buffer(minute_bars(spark, folder).select("symbol", "window_start", "close"))
    total = F.aggregate("bars", F.lit(0.0), lambda t, r: t + r["close"])
    return V.rounded(buffers.select(
        "symbol", "hour_start", "rows_in_hour", "complete",
        F.get("bars", F.lit(0))["window_start"].alias("first_start"),
        F.element_at("bars", -1)["window_start"].alias("last_start"), total.alias("close_sum"),
    ))


@query("a11_vwap", f"""WITH {V.SQL_TRADES}
SELECT symbol, us - us % {HOUR} AS bucket,
       round(coalesce(sum(price * size) FILTER (size > 0) / sum(size) FILTER (size > 0), 0) + 1.3e-9, 6) + 0.0 AS vwap
FROM trades GROUP BY 1, 2""")
def a11(spark, folder):
    made = flow.vwap(flow.bucketed(V.trades(spark, folder), HOUR), ["symbol", "bucket"])
    return V.rounded(made)


@query("a11_vwap_lineitem", """
SELECT l_returnflag, l_linestatus, l_shipmonth,
       round(sum(l_extendedprice * l_quantity) / sum(l_quantity) + 1.3e-9, 4) + 0.0 AS vwap
FROM (SELECT *, strftime(l_shipdate, '%Y-%m') AS l_shipmonth FROM lineitem) GROUP BY 1, 2, 3""")
def a11_lineitem(spark, folder):
    items = V.load(spark, folder, "lineitem").withColumn("l_shipmonth", F.date_format("l_shipdate", "yyyy-MM"))
    by = ["l_returnflag", "l_linestatus", "l_shipmonth"]
    return V.rounded(flow.vwap(items, by, "l_extendedprice", "l_quantity"), 4)


@query("a12_micro_mean", f"""WITH {V.SQL_TRADES},
mids AS (SELECT symbol, us - us % {HOUR} AS bucket, avg(value + 100) AS mid FROM feed
         WHERE event_type = 'view' GROUP BY 1, 2),
means AS (SELECT symbol, us - us % {HOUR} AS bucket, avg(price) AS price FROM trades GROUP BY 1, 2)
SELECT symbol, bucket, round(coalesce(price - mid, 0) + 1.3e-9, 6) + 0.0 AS micro_deviation
FROM means LEFT JOIN mids USING (symbol, bucket)""")
def a12(spark, folder):
    mids = flow.bucketed(V.quotes(spark, folder), HOUR).groupBy("symbol", "bucket").agg(F.avg("mid").alias("mid"))
    made = flow.micro_deviation(flow.trade_flow(V.trades(spark, folder), HOUR), mids)
    return V.rounded(made.select("symbol", "bucket", "micro_deviation"))


@query("a13_flow", f"""WITH {V.SQL_TRADES}
SELECT symbol, us - us % {SECOND} AS bucket, round(sum(size) + 1.3e-9, 6) + 0.0 AS volume,
       round(coalesce(sum(size) FILTER (side = 'buy'), 0) + 1.3e-9, 6) + 0.0 AS buy_volume,
       round(coalesce(sum(size) FILTER (side = 'sell'), 0) + 1.3e-9, 6) + 0.0 AS sell_volume, count(*) AS trade_count
FROM trades GROUP BY 1, 2""")
def a13(spark, folder):
    made = flow.trade_flow(V.trades(spark, folder), SECOND)
    return V.rounded(made.select("symbol", "bucket", "buy_volume", "sell_volume", "volume", "trade_count"))


@query("a14_ofi", f"""WITH {V.SQL_CHANGES}
SELECT symbol, us - us % {MINUTE} AS bucket,
       round(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) + 1.3e-9, 6) + 0.0 AS ofi
FROM changes GROUP BY 1, 2""")
def a14(spark, folder):
    return V.rounded(flow.order_flow(V.changes(spark, folder), MINUTE).select("symbol", "bucket", "ofi"))


def sql_books(every: int) -> str:
    """CTE chain that ends in ``books``: live levels at each bucket end, by brute force."""
    return V.SQL_CHANGES + f""",
spans AS (SELECT symbol, min(us - us % {every}) AS lo, max(us - us % {every}) AS hi FROM changes GROUP BY 1),
instants AS (SELECT symbol, unnest(generate_series(lo, hi, {every})) AS bucket FROM spans),
books AS (
  SELECT i.symbol, i.bucket, c.side, c.price, arg_max(c.size, (c.us, c.seq)) AS size
  FROM instants i JOIN changes c ON c.symbol = i.symbol AND c.us < i.bucket + {every}
  GROUP BY ALL HAVING arg_max(c.size, (c.us, c.seq)) > 0)"""


SQL_MIDS = f""",
mids AS (SELECT symbol, us - us % {DAY} AS bucket, avg(least(value, 40)) + 95 AS mid FROM feed GROUP BY 1, 2)"""


def mids(spark, folder, every=DAY):
    shown = flow.bucketed(V.events_feed(spark, folder), every)
    mid = F.avg(F.least(F.col("value"), F.lit(40.0))) + 95
    return shown.groupBy("symbol", "bucket").agg(mid.alias("mid"))


def day_books(spark, folder):
    return book.books(V.changes(spark, folder), DAY)


@query("j3_depth_filter", f"""WITH {sql_books(DAY)}{SQL_MIDS}
SELECT symbol, bucket, side, price, round(size + 1.3e-9, 6) + 0.0 AS size
FROM books JOIN mids USING (symbol, bucket)
WHERE CASE WHEN side = 'buy' THEN price >= mid * 0.98 ELSE price <= mid * 1.02 END""")
def j3(spark, folder):
    near = book.near_mid(day_books(spark, folder), mids(spark, folder))
    return V.rounded(near.select("symbol", "bucket", "side", "price", "size"))


@query("a15_depth", f"""WITH {sql_books(DAY)}{SQL_MIDS},
near AS (SELECT * FROM books JOIN mids USING (symbol, bucket)
         WHERE CASE WHEN side = 'buy' THEN price >= mid * 0.98 ELSE price <= mid * 1.02 END),
sums AS (SELECT symbol, bucket, sum(size) AS depth, sum(size) FILTER (side = 'buy') AS bid_depth,
                sum(size) FILTER (side = 'sell') AS ask_depth FROM near GROUP BY 1, 2)
SELECT symbol, bucket, round(coalesce(depth, 0) + 1.3e-9, 6) + 0.0 AS depth,
       round(coalesce(bid_depth, 0) + 1.3e-9, 6) + 0.0 AS bid_depth, round(coalesce(ask_depth, 0) + 1.3e-9, 6) + 0.0 AS ask_depth
FROM mids LEFT JOIN sums USING (symbol, bucket)""")
def a15(spark, folder):
    return V.rounded(book.depth(day_books(spark, folder), mids(spark, folder)).drop("mid"))


@query("a16_lambda", f"""WITH {V.SQL_TRADES},
linked AS (SELECT *, price - lag(price) OVER (PARTITION BY symbol ORDER BY us, seq) AS dp FROM trades)
SELECT symbol, us - us % {HOUR} AS bucket,
       round(CASE WHEN sum(CASE WHEN side = 'buy' THEN size ELSE -size END) <> 0
             THEN sum(dp) / sum(CASE WHEN side = 'buy' THEN size ELSE -size END) ELSE 0 END + 1.3e-9, 6) + 0.0 AS kyles_lambda
FROM linked WHERE dp IS NOT NULL GROUP BY 1, 2""")
def a16(spark, folder):
    return V.rounded(flow.price_impact(V.trades(spark, folder), HOUR))


@query("a17_top", f"""WITH {sql_books(DAY)}
SELECT symbol, bucket, max(price) FILTER (side = 'buy') AS best_bid, min(price) FILTER (side = 'sell') AS best_ask
FROM books GROUP BY 1, 2""")
def a17(spark, folder):
    return book.top_of_book(day_books(spark, folder))


@query("k1_levels", f"""WITH {sql_books(DAY)}
SELECT symbol, bucket, side, price, round(size + 1.3e-9, 6) + 0.0 AS size,
       row_number() OVER (PARTITION BY symbol, bucket, side
                          ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END) AS level
FROM books QUALIFY level <= 5""")
def k1(spark, folder):
    return V.rounded(book.top_levels(day_books(spark, folder), 5))


def _stats_sql() -> str:
    how = {"avg": "avg({c})", "max": "max({c})", "min": "min({c})", "sum": "sum({c})",
           "std": "stddev_samp({c})", "current": "arg_max({c}, window_start)", "range": "max({c}) - min({c})"}
    groups = [
        ("close", "price", "current"), ("total_volume_1m", "volume", "sum avg max min"),
        ("volatility_1m", "volatility", "avg max min current"),
        ("avg_bid_ask_spread_1m", "spread", "avg min max current"),
        ("avg_bid_depth_2pct_1m", "bid_depth", "avg min max current"),
        ("avg_ask_depth_2pct_1m", "ask_depth", "avg min max current"),
        ("cvd_1m", "cvd", "avg range current"), ("total_ofi_1m", "ofi", "avg sum current"),
        ("avg_micro_price_deviation_1m", "micro_deviation", "avg std current"),
        ("avg_kyles_lambda_1m", "kyles_lambda", "avg std current"),
        ("avg_liquidity_health_1m", "health", "avg min max current"),
    ]
    items = ["max(high) AS price_high", "min(low) AS price_low", "avg(close) AS price_avg",
             "max(high) - min(low) AS price_range"]
    items += [f"{how[kind].format(c=c)} AS {t}_{kind}" for c, t, kinds in groups for kind in kinds.split()]
    names = [i.split(" AS ")[1] for i in items]
    rows = " UNION ALL ".join(
        f"SELECT symbol, '{n}' AS statistic, round({n} + 1.3e-9, 5) + 0.0 AS value FROM wide" for n in names
    )
    return f"WITH {V.HOUR_BARS},\nwide AS (SELECT symbol, {', '.join(items)} FROM bars GROUP BY symbol)\n{rows}"


@query("a18_stats", _stats_sql())
def a18(spark, folder):
    return V.rounded(serving.statistics_long(hour_bars(spark, folder)), 5)


@query("a19_regime_share", f"""WITH {V.MINUTE_BARS}
SELECT symbol, volatility_regime, count(*) AS bars,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY symbol) + 1.3e-9, 6) + 0.0 AS percent
FROM bars GROUP BY 1, 2""")
def a19(spark, folder):
    return V.rounded(serving.regime_share(minute_bars(spark, folder)))


@query("a20_summary", f"""WITH {V.MINUTE_BARS}
SELECT symbol, count(*) AS window_rows, min(window_start) AS window_start,
  arg_max(window_end, window_start) AS window_end, arg_min(open, window_start) AS open, max(high) AS high,
  min(low) AS low, arg_max(close, window_start) AS close,
  round(sum(total_volume_1m) + 1.3e-9, 6) + 0.0 AS total_volume_1m_sum,
  round(sum(total_buy_volume_1m) + 1.3e-9, 6) + 0.0 AS total_buy_volume_1m_sum,
  round(sum(total_sell_volume_1m) + 1.3e-9, 6) + 0.0 AS total_sell_volume_1m_sum,
  sum(trade_count_1m)::BIGINT AS trade_count_1m_sum, round(avg(volatility_1m) + 1.3e-9, 6) + 0.0 AS volatility_1m_mean,
  round(avg(avg_bid_ask_spread_1m) + 1.3e-9, 6) + 0.0 AS avg_bid_ask_spread_1m_mean,
  round(avg(cvd_1m) + 1.3e-9, 6) + 0.0 AS cvd_1m_mean, round(avg(total_ofi_1m) + 1.3e-9, 6) + 0.0 AS total_ofi_1m_mean,
  round((arg_max(close, window_start) / arg_min(open, window_start) - 1) * 100 + 1.3e-9, 6) + 0.0 AS return_pct
FROM bars GROUP BY symbol""")
def a20(spark, folder):
    return V.rounded(serving.window_summary(minute_bars(spark, folder)))


@query("a21_hourly", f"""WITH {V.MINUTE_BARS},
spans AS (SELECT symbol, min(window_start - window_start % 3600000) AS lo,
                 max(window_start - window_start % 3600000) AS hi FROM bars GROUP BY 1),
hours AS (SELECT symbol, unnest(generate_series(lo, hi, 3600000)) AS hour_start FROM spans),
rolled AS (
  SELECT symbol, window_start - window_start % 3600000 AS hour_start, arg_min(open, window_start) AS open,
    max(high) AS high, min(low) AS low, arg_max(close, window_start) AS close,
    sum(total_volume_1m) AS v, sum(total_buy_volume_1m) AS b, sum(total_sell_volume_1m) AS s,
    sum(trade_count_1m) AS t, avg(volatility_1m) AS m1, avg(avg_bid_ask_spread_1m) AS m2,
    avg(order_imbalance_ratio_1m) AS m3, avg(cvd_1m) AS m4, avg(total_ofi_1m) AS m5
  FROM bars GROUP BY 1, 2)
SELECT symbol, hour_start, open, high, low, close, round(coalesce(v, 0) + 1.3e-9, 6) + 0.0 AS total_volume_1m,
  round(coalesce(b, 0) + 1.3e-9, 6) + 0.0 AS total_buy_volume_1m, round(coalesce(s, 0) + 1.3e-9, 6) + 0.0 AS total_sell_volume_1m,
  coalesce(t, 0)::BIGINT AS trade_count_1m, round(m1 + 1.3e-9, 6) + 0.0 AS volatility_1m,
  round(m2 + 1.3e-9, 6) + 0.0 AS avg_bid_ask_spread_1m, round(m3 + 1.3e-9, 6) + 0.0 AS order_imbalance_ratio_1m,
  round(m4 + 1.3e-9, 6) + 0.0 AS cvd_1m, round(m5 + 1.3e-9, 6) + 0.0 AS total_ofi_1m
FROM hours LEFT JOIN rolled USING (symbol, hour_start)""")
def a21(spark, folder):
    return V.rounded(serving.hourly(minute_bars(spark, folder), last=None))


AS_OF_US = 1_706_659_200_000_000  # the instant the serving and health queries look from


def component_log(spark, folder):
    source = F.when(F.col("user_id") % 4 == 0, "producer").when(F.col("user_id") % 4 == 1, "consumer_ticks")
    return V.events_feed(spark, folder).select(
        source.otherwise("other").alias("component"), "ts", (F.col("event_type") == "error").alias("is_error")
    )


@query("a22_status", f"""WITH {V.SQL_FEED},
log AS (SELECT CASE user_id % 4 WHEN 0 THEN 'producer' WHEN 1 THEN 'consumer_ticks' ELSE 'other' END AS source,
               us, event_type = 'error' AS is_error FROM feed),
known(component, source, stale_after) AS (
  VALUES ('Producer', 'producer', 30), ('Aggregator', 'consumer_ticks', 90), ('Writer', 'consumer_bars', 90)),
seen AS (SELECT source, max(us) FILTER (NOT is_error) AS last_us, count(*) FILTER (NOT is_error) AS messages,
                count(*) FILTER (is_error) AS errors FROM log GROUP BY 1),
state AS (
  SELECT component, ({AS_OF_US} - last_us) / 1000000.0::DOUBLE AS age, stale_after,
         coalesce(messages, 0) AS messages, coalesce(errors, 0) AS errors
  FROM known LEFT JOIN seen USING (source))
SELECT component, CASE WHEN age IS NULL THEN 'not started' WHEN age < stale_after THEN 'running' ELSE 'stale' END
         AS status, round(age + 1.3e-9, 6) + 0.0 AS age_seconds, messages, errors,
       (SELECT sum(errors) FROM seen)::BIGINT AS total_errors,
       (SELECT sum(errors) FROM seen) > 0 OR (SELECT count(*) FROM state WHERE age >= stale_after) > 0 AS degraded
FROM state""")
def a22(spark, folder):
    return V.rounded(health.component_status(component_log(spark, folder), AS_OF_US))
