"""Queries: timelines, recent rows, merges, the context document."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.catalog import views as V
from tapeworks.catalog.aggregates import AS_OF_US, DOUBLES, PLAIN, hour_bars, minute_bars
from tapeworks.catalog.registry import query
from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import HOUR
from tapeworks.operators import serving, sets
from tapeworks.operators.bars import bars
from tapeworks.plans import context
from tapeworks.schemas import BAR_SCHEMA
from tapeworks.session import settled

AS_OF_MS = AS_OF_US // 1000
LABELS = {"5 Minutes": 300_000, "1 Hour": 3_600_000, "1 Day": 86_400_000}


@query("p17_timeline", f"WITH {V.MINUTE_BARS}\n" + " UNION ALL ".join(
    f"""SELECT '{label}' AS timeline, symbol, window_start, close FROM bars
QUALIFY window_start >= {AS_OF_MS - span} OR max(window_start) OVER (PARTITION BY symbol) < {AS_OF_MS - span}"""
    for label, span in LABELS.items()))
def p17(spark, folder):
    made = minute_bars(spark, folder).select("symbol", "window_start", "close")
    parts = [serving.timeline(made, AS_OF_MS, label).withColumn("timeline", F.lit(label)) for label in LABELS]
    return sets.union_bars(*parts)


@query("p18_retention", V.sql(V.HOUR_BARS, "open close", "symbol window_start", "bars",
                              f"WHERE window_start >= {AS_OF_MS - 88_200_000}"))
def p18(spark, folder):
    kept = sets.retain(hour_bars(spark, folder), F.lit(AS_OF_MS))
    return V.rounded(kept.select("symbol", "window_start", "open", "close"))


@query("p19_optional_cols", V.sql(
    V.HOUR_BARS, "open high low close total_volume_1m volatility_1m", "window_start window_end trade_count_1m", "bars"))
def p19(spark, folder):
    narrow = hour_bars(spark, folder).select(
        "symbol", "window_start", "window_end", "open", "high", "low", "close", "total_volume_1m",
        "trade_count_1m", "volatility_1m", "num_ticks",
    )
    return V.rounded(serving.present(narrow))


@query("p20_rename", f"""WITH {V.HOUR_BARS}
SELECT symbol, window_start AS "Time", round(open + 1.3e-9, 6) + 0.0 AS "Open", round(high + 1.3e-9, 6) + 0.0 AS "High",
  round(low + 1.3e-9, 6) + 0.0 AS "Low", round(close + 1.3e-9, 6) + 0.0 AS "Close", round(total_volume_1m + 1.3e-9, 6) + 0.0 AS "Volume",
  round(volatility_1m + 1.3e-9, 6) + 0.0 AS "Volatility", round(order_imbalance_ratio_1m + 1.3e-9, 6) + 0.0 AS "Order Imbalance",
  round(price_change_percent_1m + 1.3e-9, 6) + 0.0 AS "Change %" FROM bars""")
def p20(spark, folder):
    return V.rounded(serving.titled(hour_bars(spark, folder)))


def _colour(column: str) -> str:
    return f"CASE WHEN {column} > 0 THEN 'green' ELSE 'red' END AS {column}_colour"


_COLOURED = ["order_imbalance_ratio_1m", "cvd_1m", "total_ofi_1m", "avg_micro_price_deviation_1m"]


@query("p21_labels", f"""WITH {V.HOUR_BARS}
SELECT symbol, window_start, CASE WHEN order_imbalance_ratio_1m > 0 THEN 'Buy' ELSE 'Sell' END AS imbalance_label,
  CASE WHEN cvd_1m > 0 THEN 'Buying Pressure' ELSE 'Selling Pressure' END AS cvd_label,
  CASE WHEN total_ofi_1m > 0 THEN 'Bid Pressure' ELSE 'Ask Pressure' END AS ofi_label,
  CASE WHEN abs(avg_kyles_lambda_1m) < 1000 THEN 'Low Impact' ELSE 'High Impact' END AS impact_label,
  {', '.join(_colour(c) for c in _COLOURED)} FROM bars""")
def p21(spark, folder):
    labelled = S.with_labels(hour_bars(spark, folder))
    names = [c for c in labelled.columns if c.endswith(("_label", "_colour"))]
    return labelled.select("symbol", "window_start", *names)


@query("p22_freshness", f"""WITH {V.MINUTE_BARS}
SELECT symbol, max(window_start) AS last_update, round(({AS_OF_MS} - max(window_start)) / 1000.0::DOUBLE + 1.3e-9, 6) + 0.0
       AS data_age_seconds, count(*) AS records FROM bars GROUP BY 1""")
def p22(spark, folder):
    return V.rounded(serving.freshness(minute_bars(spark, folder), AS_OF_MS))


@query("p23_json_context")
def p23(spark, folder):
    made = serving.present(hour_bars(spark, folder))
    return context.to_document(made.withColumn("key", F.col("window_start")), ["key"])


@query("p23_json_fields", f"""WITH {V.HOUR_BARS}
SELECT symbol, window_start,
       strftime(timezone('America/New_York', make_timestamptz(window_end * 1000)), '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'
         AS window_end, round(close + 1.3e-9, 6) + 0.0 AS close,
       CASE WHEN volatility_regime <> 'high' THEN round(volatility_1m + 1.3e-9, 6) + 0.0 END AS volatility, 5 AS fields
FROM bars""")
def p23_fields(spark, folder):
    """The same documents parsed again; high volatilities were made NaN and must come back null."""
    nan = F.when(F.col("volatility_regime") == "high", F.lit(float("nan"))).otherwise(F.col("volatility_1m"))
    made = hour_bars(spark, folder).select(
        "symbol", "window_start", "window_end", "close", nan.alias("volatility"), "num_ticks", "volatility_regime")
    text = context.to_document(made.withColumn("start", F.col("window_start")).drop("window_start"), ["symbol", "start"])

    def number(name):
        return F.get_json_object("document", f"$.{name}").cast("double").alias(name)

    return V.rounded(text.select(
        "symbol", F.col("start").alias("window_start"), F.get_json_object("document", "$.window_end").alias("window_end"),
        number("close"), number("volatility"),
        F.size(F.json_object_keys("document")).cast("long").alias("fields"),
    ))


@query("k2_latest", V.sql(V.MINUTE_BARS, DOUBLES, PLAIN, "bars",
                          "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1"))
def k2(spark, folder):
    return V.rounded(serving.latest(minute_bars(spark, folder)))


@query("k3_tail", V.sql(V.MINUTE_BARS, "close", "symbol window_start", "bars",
                        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) <= 180"))
def k3(spark, folder):
    return V.rounded(serving.tail(minute_bars(spark, folder).select("symbol", "window_start", "close"), 180))


@query("k4_recent", V.sql(V.MINUTE_BARS, "open high low close", "symbol window_start", "bars",
                          "ORDER BY window_start DESC, symbol LIMIT 20"))
def k4(spark, folder):
    made = minute_bars(spark, folder).select("symbol", "window_start", "open", "high", "low", "close")
    return V.rounded(serving.recent(made, 20))


@query("k5_sort", V.sql(V.MINUTE_BARS, "close", "symbol window_start", "bars", "ORDER BY window_start, symbol"))
def k5(spark, folder):
    return V.rounded(serving.sorted_bars(minute_bars(spark, folder).select("symbol", "window_start", "close")))


# Two overlapping editions of the bar table: one from all ticks, one without the sells.
SQL_EDITIONS = V.HOUR_BARS + """,
late AS (SELECT symbol, bar AS b, arg_max(price, (us, seq)) AS close, sum(size) AS volume
         FROM priced WHERE side = 'buy' AND price > 0 GROUP BY 1, 2),
fresh AS (SELECT symbol, b // 1000 AS window_start, close, volume AS total_volume_1m FROM late)"""


def editions(spark, folder):
    columns = ["symbol", "window_start", "close", "total_volume_1m", "last_ingestion_time"]
    ticks = V.ticks(spark, folder)
    bought = ticks.filter((F.col("side") == "buy") & (F.col("price") > 0))
    return bars(ticks, HOUR).select(*columns), bars(bought, HOUR).select(*columns)


@query("u1_union", f"""WITH {SQL_EDITIONS}
SELECT symbol, window_start, close, NULL::DOUBLE AS total_volume_1m FROM bars
UNION ALL BY NAME SELECT symbol, window_start, close, total_volume_1m + 0.0 AS total_volume_1m FROM fresh""")
def u1(spark, folder):
    old, new = editions(spark, folder)
    return sets.union_bars(old.select("symbol", "window_start", "close"), new.drop("last_ingestion_time"))


@query("u2_dedupe", f"""WITH {V.SQL_FEED}
SELECT symbol, us - us % {HOUR} AS window_start, arg_max(seq, (k, seq)) AS seq FROM feed GROUP BY 1, 2""")
def u2(spark, folder):
    from tapeworks.operators.flow import bucketed
    rows = bucketed(V.events_feed(spark, folder), HOUR, "window_start").select("symbol", "window_start", "k", "seq")
    return sets.keep_last(rows, ["k", "seq"]).drop("k")


@query("u3_upsert", f"""WITH {SQL_EDITIONS}, stacked AS (
  SELECT symbol, window_start, close, total_volume_1m, 0 AS priority FROM bars
  UNION ALL SELECT symbol, window_start, close, total_volume_1m, 1 FROM fresh)
SELECT symbol, window_start, round(close + 1.3e-9, 6) + 0.0 AS close, round(total_volume_1m + 1.3e-9, 6) + 0.0 AS total_volume_1m
FROM stacked WHERE window_start >= {AS_OF_MS - 20 * 86_400_000}
QUALIFY row_number() OVER (PARTITION BY symbol, window_start ORDER BY priority DESC) = 1""")
def u3(spark, folder):
    old, new = editions(spark, folder)
    merged = sets.upsert(old, new)
    return V.rounded(sets.retain(merged, F.lit(AS_OF_MS), 20 * 86_400_000).drop("last_ingestion_time"))


@query("u4_reconcile", f"""WITH {SQL_EDITIONS}
SELECT count(*) FILTER (b.symbol IS NOT NULL AND f.symbol IS NOT NULL) AS in_both,
       count(*) FILTER (f.symbol IS NULL) AS left_only, count(*) FILTER (b.symbol IS NULL) AS right_only,
       count(*) FILTER (abs(b.close - f.close) > 1e-9) AS diff_close,
       count(*) FILTER (abs(b.total_volume_1m - f.total_volume_1m) > 1e-9) AS diff_total_volume_1m
FROM bars b FULL JOIN fresh f ON b.symbol = f.symbol AND b.window_start = f.window_start""")
def u4(spark, folder):
    old, new = editions(spark, folder)
    return sets.reconcile(old, new, ["close", "total_volume_1m"])


SQL_DIGESTS = """SELECT coalesce(o.hour, n.hour) AS hour, o.rows IS NOT DISTINCT FROM n.rows AS same
FROM (SELECT hour, list(row(symbol, window_start, close, total_volume_1m) ORDER BY symbol, window_start) AS rows FROM bars_ GROUP BY 1) o
FULL JOIN (SELECT hour, list(row(symbol, window_start, close, total_volume_1m) ORDER BY symbol, window_start) AS rows FROM fresh_ GROUP BY 1) n
  ON o.hour = n.hour"""


# the second edition is the bars themselves but for those of every fifth day
@query("u4_digests", f"""WITH {V.HOUR_BARS},
bars_ AS (SELECT symbol, window_start, window_start AS hour, close, total_volume_1m FROM bars),
fresh_ AS (SELECT symbol, window_start, hour, CASE WHEN symbol = 'S1' AND hour // 86400000 % 5 = 0 THEN close + 1 ELSE close END AS close,
                  total_volume_1m FROM bars_ WHERE NOT (symbol = 'S2' AND hour // 86400000 % 5 = 0)),
hours AS ({SQL_DIGESTS})
SELECT count(*) FILTER (f.symbol IS NOT NULL) AS in_both, count(*) FILTER (f.symbol IS NULL) AS left_only, 0 AS right_only,
       count(*) FILTER (abs(b.close - f.close) > 1e-9) AS diff_close, 0 AS diff_total_volume_1m,
       (SELECT count(*) FROM hours WHERE NOT same) AS hours_joined
FROM bars_ b LEFT JOIN fresh_ f ON b.symbol = f.symbol AND b.window_start = f.window_start""")
def u4_digests(spark, folder):
    old = settled(hour_bars(spark, folder).select("symbol", "window_start", "close", "total_volume_1m"))
    other = F.floor(F.col("window_start") / 86_400_000) % 5 == 0
    new = old.filter(~((F.col("symbol") == "S2") & other)).withColumn(
        "close", F.when((F.col("symbol") == "S1") & other, F.col("close") + 1).otherwise(F.col("close"))
    )
    return sets.reconcile_by_digest(old, new, ["close", "total_volume_1m"])


@query("c1_context")
def c1(spark, folder):
    return context.market_context(minute_bars(spark, folder), "1 Day", AS_OF_US)


@query("c1_context_fields", f"""WITH {V.MINUTE_BARS},
span AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) <= 1440),
hours AS (SELECT symbol, (max(window_start) - max(window_start) % 3600000
                          - min(window_start) + min(window_start) % 3600000) // 3600000 + 1 AS n FROM span GROUP BY 1)
SELECT symbol, count(*) AS rows_window, least(count(*), 180) AS rows_sent,
  round(arg_max(close, window_start) + 1.3e-9, 6) + 0.0 AS close,
  round((arg_max(close, window_start) / arg_min(open, window_start) - 1) * 100 + 1.3e-9, 6) + 0.0 AS return_pct,
  round(sum(total_volume_1m) + 1.3e-9, 6) + 0.0 AS volume, least(any_value(n), 30) AS hours,
  strftime(timezone('America/New_York', make_timestamptz(min(window_start) * 1000)), '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'
    AS window_start
FROM span JOIN hours USING (symbol) GROUP BY symbol""")
def c1_fields(spark, folder):
    document = context.market_context(minute_bars(spark, folder), "1 Day", AS_OF_US)

    def at(path, kind, name):
        return F.get_json_object("context", f"$.{path}").cast(kind).alias(name)

    return V.rounded(document.select(
        "symbol", at("meta.rows_window", "long", "rows_window"), at("meta.rows_sent", "long", "rows_sent"),
        at("latest.close", "double", "close"), at("summary.return_pct", "double", "return_pct"),
        at("summary.total_volume_1m_sum", "double", "volume"), at("summary.window_start", "string", "window_start"),
        F.json_array_length(F.get_json_object("context", "$.hourly")).cast("long").alias("hours"),
    ))


# Minute bars with a column missing, one too many, two out of place and one of another type.
SCHEMA_NAMES = "symbol window_start window_end open high low close num_ticks trade_count_1m".split()


@query("q_schema", f"""WITH {V.MINUTE_BARS}, n AS (
  SELECT count(*) AS n, count(*) FILTER (trade_count_1m = 1) AS bad, count(*) FILTER (open > 0) AS opened,
         count(*) FILTER (high > 0) AS highs, count(*) FILTER (low > 0) AS lows FROM bars)
SELECT 'symbol' AS "column", NULL AS difference, n AS filled, 0 AS unreadable FROM n
UNION ALL SELECT 'window_start', NULL, n, 0 FROM n UNION ALL SELECT 'window_end', NULL, n, 0 FROM n
UNION ALL SELECT 'open', 'position', opened, 0 FROM n UNION ALL SELECT 'high', 'position', highs, 0 FROM n
UNION ALL SELECT 'low', NULL, lows, 0 FROM n UNION ALL SELECT 'close', 'missing', 0, 0 FROM n
UNION ALL SELECT 'num_ticks', NULL, n, 0 FROM n UNION ALL SELECT 'trade_count_1m', 'type', n, bad FROM n
UNION ALL SELECT 'extra', 'extra', n, 0 FROM n""")
def q_schema(spark, folder):
    from tapeworks.operators.quality import schema_report
    declared = T.StructType([BAR_SCHEMA[n] for n in SCHEMA_NAMES])
    count = F.when(F.col("trade_count_1m") == 1, "one").otherwise(F.col("trade_count_1m").cast("string"))
    made = minute_bars(spark, folder).select(
        "symbol", "window_start", "window_end", "high", "open", "low", "num_ticks", count.alias("trade_count_1m"), F.lit(1).alias("extra"))
    return schema_report(made, declared).select("column", "difference", "filled", "unreadable")
