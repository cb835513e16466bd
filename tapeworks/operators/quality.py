"""Data-quality reports on ticks, bars and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.timecols import micros
from tapeworks.operators.chunks import Chunks, measure
from tapeworks.operators.scan import last_known

# Ticks expected per minute and the share that counts as healthy.
EXPECTED_TICKS, HEALTHY_SHARE = 60, 0.9


def content_hash(columns: list[str]):
    """64-bit hash of the listed fields, nulls included."""
    return F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def duplicates(messages: DataFrame, columns: list[str], by: str = "symbol") -> DataFrame:
    """Messages, distinct contents and repeats per ``by``; copies merge before the shuffle."""
    copies = messages.groupBy(by, F.to_json(F.struct(*columns)).alias("_content")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return copies.groupBy(by).agg(
        F.sum("_n").alias("messages"),
        F.count(F.lit(1)).alias("distinct_messages"),
        F.sum(F.col("_n") - 1).alias("repeats"),
    )


def price_changes(ticks: DataFrame, chunks: Chunks | None = None) -> DataFrame:
    """Ticks whose price differs from the one before; the first tick always stays."""
    feed = ticks.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"])
    linked = last_known(feed, chunks, {"_before": F.struct("price")})
    same = F.col("_before").isNotNull() & F.col("_before.price").eqNullSafe(F.col("price"))
    return linked.filter(~same).drop("_us", "_before")


def completeness(
    bars: DataFrame, expected: int = EXPECTED_TICKS, share: float = HEALTHY_SHARE
) -> DataFrame:
    return bars.withColumns({
        "completeness": F.col("num_ticks") / expected,
        "healthy": F.col("num_ticks") >= expected * share,
    })


def missing_fields(messages: DataFrame, required: list[str]) -> DataFrame:
    """Rows lacking required fields, with the names of those fields."""
    absent = [
        F.when(F.col(c).isNull(), F.lit(c)) if c in messages.columns else F.lit(c) for c in required
    ]
    listed = messages.withColumn("missing", F.array_compact(F.array(*absent)))
    return listed.filter(F.size("missing") > 0)


def missing_counts(messages: DataFrame, required: list[str], by: str = "symbol") -> DataFrame:
    """Rows per ``by`` and how many of them lack each required field."""
    counts = [
        (F.count(F.when(F.col(c).isNull(), 1)) if c in messages.columns else F.count(F.lit(1)))
        .alias(f"missing_{c}")
        for c in required
    ]
    return messages.groupBy(by).agg(F.count(F.lit(1)).alias("messages"), *counts)


def volume_validity(messages: DataFrame, column: str = "volume", by: str = "symbol") -> DataFrame:
    """Rows per ``by`` with a positive volume, and those without."""
    good = F.col(column) > 0
    return messages.groupBy(by).agg(
        F.count(F.when(good, 1)).alias("valid"),
        F.count(F.when(~F.coalesce(good, F.lit(False)), 1)).alias("invalid"),
    )


def conservation(ticks: DataFrame, bars: DataFrame, volume: str = "volume_1s") -> DataFrame:
    """Volume and tick counts that went into bars against what came out, per symbol."""
    fed = ticks.groupBy("symbol").agg(
        F.sum(F.coalesce(F.col(volume), F.lit(0.0))).alias("volume_in"),
        F.count(F.lit(1)).alias("ticks_in"),
    )
    made = bars.groupBy("symbol").agg(
        F.sum("total_volume_1m").alias("volume_out"), F.sum("num_ticks").alias("ticks_out")
    )
    return fed.join(made, "symbol", "full_outer").withColumns({
        "volume_gap": F.coalesce("volume_in", F.lit(0.0)) - F.coalesce("volume_out", F.lit(0.0)),
        "ticks_gap": F.coalesce("ticks_in", F.lit(0)) - F.coalesce("ticks_out", F.lit(0)),
    })


def backward_steps(messages: DataFrame, chunks: Chunks | None = None) -> DataFrame:
    """Per symbol, messages in arrival order (seq) whose event time lies before their predecessor's."""
    feed = messages.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"], width=1 << 20, pos="seq", seq="_us")
    linked = last_known(feed, chunks, {"_before": F.col("_us")})
    return linked.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count(F.when(F.col("_before") > F.col("_us"), 1)).alias("backward"),
    ).withColumn("monotonic", F.col("backward") == 0)


def schema_differences(df: DataFrame, declared: T.StructType) -> DataFrame:
    """One row per column that is missing, extra, of another type or out of place."""
    have = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)}
    want = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(declared.fields)}
    rows = [(n, "missing", want[n][1], None) for n in want if n not in have]
    rows += [(n, "extra", None, have[n][1]) for n in have if n not in want]
    # places are compared among the columns both sides have: one absent column moves no other
    common = [n for n in want if n in have]
    found = {n: i for i, n in enumerate(n for n in have if n in want)}
    for place, name in enumerate(common):
        if want[name][1] != have[name][1]:
            rows.append((name, "type", want[name][1], have[name][1]))
        elif place != found[name]:
            rows.append((name, "position", str(place), str(found[name])))
    return df.sparkSession.createDataFrame(
        rows, "column string, difference string, declared string, found string"
    )


def schema_report(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Every declared or found column: its difference if any, filled rows, and rows unreadable as declared."""
    told = {r["column"]: r["difference"] for r in schema_differences(df, declared).collect()}  # a row per column at most
    kinds = {f.name: f.dataType for f in declared.fields}
    names = [*kinds, *(c for c in df.columns if c not in kinds)]

    def row(name: str) -> Column:
        if name not in df.columns:
            filled = unreadable = F.lit(0).cast("long")
        else:
            cell = F.col(name)
            broken = cell.isNotNull() & cell.try_cast(kinds.get(name, df.schema[name].dataType)).isNull()
            filled, unreadable = F.count(cell), F.count(F.when(broken, 1))
        return F.struct(
            F.lit(name).alias("column"), F.lit(told.get(name)).cast("string").alias("difference"),
            filled.alias("filled"), unreadable.alias("unreadable"),
        )

    counted = df.agg(*(row(n).alias(f"_{i}") for i, n in enumerate(names)))
    return counted.select(F.inline(F.array(*(F.col(f"_{i}") for i in range(len(names))))))
