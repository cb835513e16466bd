"""The market context: one bounded JSON document per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.timecols import EASTERN, iso_text
from tapeworks.operators.serving import hourly, latest, present, tail, window_summary
from tapeworks.session import settled

# Rows analysed, rows sent along, hour buckets sent along.
WINDOW_ROWS, SENT_ROWS, HOURS = 1440, 180, 30
TIMES = ["window_start", "window_end", "hour_start"]


def json_safe(table: DataFrame, zone: str = EASTERN) -> DataFrame:
    """NaN becomes null; epoch milliseconds of windows become ISO-8601 text with offset."""
    out = {}
    for name, kind in table.dtypes:
        if kind in ("double", "float"):
            out[name] = F.nullif(F.col(name), F.lit(float("nan")))
        elif name in TIMES:
            out[name] = iso_text(F.timestamp_millis(name), zone)
    return table.withColumns(out)


def to_document(table: DataFrame, keep: list[str], name: str = "document") -> DataFrame:
    """Rows as JSON objects, nulls spelled out, next to the ``keep`` columns."""
    fields = [c for c in table.columns if c not in keep]
    encoded = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return json_safe(table).select(*keep, encoded.alias(name))


def _record(table: DataFrame, name: str) -> DataFrame:
    safe = json_safe(table)
    return safe.select("symbol", F.struct(*[c for c in safe.columns if c != "symbol"]).alias(name))


def _records(table: DataFrame, order: str, name: str) -> DataFrame:
    """All rows of a symbol as one ordered list; callers bound their number."""
    safe = json_safe(table.withColumn("_order", F.col(order)))
    fields = [c for c in safe.columns if c not in ("symbol", "_order")]
    listed = F.array_sort(F.collect_list(F.struct("_order", F.struct(*fields).alias("_row"))))
    rows = F.transform(listed, lambda r: r["_row"])
    return safe.groupBy("symbol").agg(rows.alias(name))


def market_context(
    bars: DataFrame, timeline: str, as_of_us: int, rows_max: int = WINDOW_ROWS,
    columns: list[str] | None = None, zone: str = EASTERN, sent_max: int = SENT_ROWS, hours: int = HOURS,
) -> DataFrame:
    """(symbol, context): meta, latest row, summary, hour rollup and recent rows as JSON.

    ``rows_max`` bars are analysed, ``sent_max`` of them and ``hours`` hour buckets sent along;
    one bar at least.
    """
    rows_max = max(1, rows_max)
    wanted = columns or present(bars).columns
    window = settled(tail(bars.select("symbol", *wanted), rows_max))  # four parts read it
    now = iso_text(F.timestamp_micros(F.lit(as_of_us)), zone)
    sent = _records(tail(window, min(max(1, sent_max), rows_max)), "window_start", "rows")
    buckets = hourly(window, hours).withColumnRenamed("hour_start", "window_start")
    whole = (
        _record(window_summary(window), "summary")
        .join(_record(latest(window), "latest"), "symbol", "left")
        .join(_records(buckets, "window_start", "hourly"), "symbol", "left")
        .join(sent, "symbol", "left")
    )
    meta = F.struct(
        F.lit(timeline).alias("timeline"),
        now.alias("now_est"),
        F.col("summary.window_rows").alias("rows_window"),
        F.size("rows").cast("long").alias("rows_sent"),
    )
    document = F.struct(meta.alias("meta"), "latest", "summary", "hourly", "rows")
    return whole.select(
        "symbol", F.to_json(document, {"ignoreNullFields": "false"}).alias("context")
    )


def empty_context(spark, timeline: str, as_of_us: int, zone: str = EASTERN) -> DataFrame:
    """The document sent when there are no bars at all: every required part, empty."""
    meta = F.struct(
        F.lit(timeline).alias("timeline"),
        iso_text(F.timestamp_micros(F.lit(as_of_us)), zone).alias("now_est"),
        F.lit(0).alias("rows_window"),
        F.lit(0).alias("rows_sent"),
        F.lit("No data available.").alias("note"),
    )
    nothing = F.array().cast("array<string>")
    document = F.struct(
        meta.alias("meta"), F.lit(None).cast("string").alias("latest"),
        F.struct(F.lit(0).alias("window_rows")).alias("summary"),
        nothing.alias("hourly"), nothing.alias("rows"),
    )
    return spark.range(1).select(
        F.to_json(document, {"ignoreNullFields": "false"}).alias("context")
    )
