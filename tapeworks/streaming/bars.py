"""Streaming bars: the batch record from an unbounded feed, closed by the watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.timecols import EASTERN, micros
from tapeworks.operators import bars as B


def _neighbours(items: Column, combine) -> Column:
    """``combine(earlier, later)`` for each pair of neighbours."""
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, 2, n), F.slice(items, 1, n), lambda later, earlier: combine(earlier, later))


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda total, x: total + x)


def _percent(earlier: Column, later: Column) -> Column:
    return (later - earlier) / earlier * 100


def grouped_pieces(ticks: DataFrame, key: Column) -> DataFrame:
    """Per symbol and ``key``: the piece aggregates of a bar but for returns, and the positive prices in order."""
    feed = B.with_defaults(ticks).withColumns({
        "_us": micros(F.col("ts")), "_return": F.lit(None).cast("double"),
    })
    point = F.when(F.col("price") > 0, F.struct("_us", "seq", "price"))
    moments = ("_returns", "_return_mean", "_return_var")
    return feed.groupBy("symbol", key).agg(
        F.array_sort(F.collect_list(point)).alias("_points"), *B._piece_aggregates()
    ).drop(*moments)


def with_moments(grouped: DataFrame) -> DataFrame:
    """Count, mean and variance of the returns within each piece, from its prices."""
    returns = _neighbours(F.transform("_points", lambda p: p["price"]), _percent)
    return (
        grouped.withColumn("_r", returns)
        .withColumn("_returns", F.size("_r").cast("long"))
        .withColumn("_return_mean", _total(F.col("_r")) / F.nullif(F.col("_returns"), F.lit(0)))
        .withColumn(
            "_return_var",
            F.aggregate("_r", F.lit(0.0), lambda s, r: s + (r - F.col("_return_mean")) ** 2)
            / F.nullif(F.col("_returns"), F.lit(0)),
        )
        .drop("_r", "_points")
    )


def merged_sums() -> list[Column]:
    """The aggregates of pieces that merge whichever way the ticks were dealt to them."""
    sums = [*B.SUMS, "num_ticks", *[f"_{p}_{out}" for out in B.MEANS for p in ("sum", "n")]]
    return [
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.max("_latest").alias("_latest"),
        *[F.sum(c).alias(c) for c in sums],
    ]


def close_bars(pieces: DataFrame, at: Column, bar: Column, start: Column, width_us: int, zone: str) -> DataFrame:
    """One bar per symbol and ``bar`` (named _bar_key) from its pieces, put in order by ``at``; it opens at ``start``."""
    summary = F.struct(at.alias("at"), "_first", "_last", "_returns", "_return_mean", "_return_var")
    listed = F.array_sort(F.collect_list(F.when(F.col("_first").isNotNull(), summary)))
    merged = pieces.groupBy("symbol", bar.alias("_bar_key")).agg(listed.alias("_list"), *merged_sums())
    edges = _neighbours(F.col("_list"), lambda a, b: _percent(a["_last"]["price"], b["_first"]["price"]))

    def over_pieces(value) -> Column:
        moving = F.filter("_list", lambda p: p["_returns"] > 0)
        return _total(F.transform(moving, value))

    count = F.aggregate("_list", F.lit(0).cast("long"), lambda n, p: n + p["_returns"]) + F.size("_edges")
    divisor = F.nullif(F.col("_returns"), F.lit(0))
    centre = (
        over_pieces(lambda p: p["_returns"] * p["_return_mean"]) + _total(F.col("_edges"))
    ) / divisor
    squares = over_pieces(
        lambda p: p["_returns"] * (p["_return_var"] + p["_return_mean"] * p["_return_mean"])
    ) + _total(F.transform("_edges", lambda e: e * e))
    done = (
        merged.withColumn("_edges", edges)
        .withColumn("_returns", count)
        .withColumn("_return_var", F.greatest(squares / divisor - centre * centre, F.lit(0.0)))
        .withColumn("_bar", start)
    )
    return B._finish(done, width_us, zone)


def streaming_bars(
    ticks: DataFrame,
    width: str = "1 minute",
    width_us: int = 60_000_000,
    sub: str = "1 second",
    lateness: str = "5 minutes",
    zone: str = EASTERN,
) -> DataFrame:
    """Bars in append mode. Ticks later than ``lateness`` are dropped and counted by Spark.

    Prices are listed per ``sub`` window only; a bar then merges one summary per sub-window,
    so no state row holds all ticks of a bar.
    """
    feed = ticks.withWatermark("ts", lateness)
    pieces = with_moments(grouped_pieces(feed, F.window("ts", sub).alias("_window")))
    return close_bars(
        pieces, F.col("_window.start"), F.window(F.window_time("_window"), width), micros(F.col("_bar_key.start")), width_us, zone
    )
