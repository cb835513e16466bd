"""Time bars from ticks.

A bar is built from pieces: every aggregate of a bar is first formed per (symbol, bar,
chunk), then merged per bar. Ordinary bars are one piece, and then the merge is skipped;
a bar too large for one task is cut into several, and only piece summaries meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import EASTERN, MINUTE, floor_to, iso_text, micros, millis, zone_text
from tapeworks.operators.chunks import CUT, Chunks, measure
from tapeworks.schemas import BAR_SCHEMA

# Which tick field feeds which bar column, by rule of aggregation.
SUMS = {
    "total_volume_1m": "volume_1s",
    "total_buy_volume_1m": "buy_volume_1s",
    "total_sell_volume_1m": "sell_volume_1s",
    "trade_count_1m": "trade_count_1s",
    "total_ofi_1m": "ofi_1s",
}
POSITIVE_MEANS = {
    "avg_buy_sell_ratio_1m": "buy_sell_ratio",
    "avg_bid_ask_spread_1m": "bid_ask_spread_1s",
    "avg_depth_2pct_1m": "depth_2pct_1s",
    "avg_bid_depth_2pct_1m": "bid_depth_2pct_1s",
    "avg_ask_depth_2pct_1m": "ask_depth_2pct_1s",
    "avg_vwap_1m": "vwap_1s",
    "avg_liquidity_health_1m": "liquidity_health_1s",
    "avg_mid_price_1m": "mid_price_1s",
}
NONZERO_MEANS = {"avg_kyles_lambda_1m": "kyles_lambda_1s"}
PLAIN_MEANS = {
    "avg_micro_price_deviation_1m": "micro_price_deviation_1s",
    "avg_ofi_1m": "ofi_1s",
}
LATEST = {
    "volume_24h": "volume_24h",
    "high_24h": "high_24h",
    "low_24h": "low_24h",
    "cvd_1m": "cvd_1s",
    "latest_best_bid_1m": "best_bid_1s",
    "latest_best_ask_1m": "best_ask_1s",
}
MEANS = {
    **{out: (src, lambda c: c > 0) for out, src in POSITIVE_MEANS.items()},
    **{out: (src, lambda c: c != 0) for out, src in NONZERO_MEANS.items()},
    **{out: (src, lambda c: F.lit(True)) for out, src in PLAIN_MEANS.items()},
}
MAX_TICKS = 60


def with_defaults(ticks: DataFrame) -> DataFrame:
    """Absent or null figures become 0, as every aggregate expects."""
    wanted = {"price", *SUMS.values(), *LATEST.values(), *(src for src, _ in MEANS.values())}
    present = set(ticks.columns)
    filled = {
        name: S.or_zero(F.col(name).cast("double")) if name in present else F.lit(0.0)
        for name in sorted(wanted)
    }
    if "ingestion_time" not in present:
        filled["ingestion_time"] = iso_text(F.col("ts").cast("timestamp"))
    return ticks.withColumns(filled)


def cap_ticks(ticks: DataFrame, width: int = MINUTE, max_ticks: int = MAX_TICKS) -> DataFrame:
    """Only the last ``max_ticks`` ticks of each bar; the rank limit also runs before the shuffle."""
    newest = W.partitionBy("symbol", "_bar").orderBy(F.desc("_us"), F.desc("seq"))
    return (
        ticks.withColumns({"_us": micros(F.col("ts"))})
        .withColumn("_bar", floor_to(F.col("_us"), width))
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= max_ticks)
        .drop("_us", "_bar", "_rank")
    )


def with_returns(ticks: DataFrame, within: list[str]) -> DataFrame:
    """Percent return against the previous positive price among rows equal in ``within``."""
    earlier = W.partitionBy(*within).orderBy("_us", "seq").rowsBetween(W.unboundedPreceding, -1)
    price = F.when(F.col("price") > 0, F.col("price"))
    known = ticks.withColumn("_previous", F.last(price, ignorenulls=True).over(earlier))
    previous = F.col("_previous")
    return known.withColumn("_return", (price - previous) / previous * 100).drop("_previous")


def _piece_aggregates() -> list[Column]:
    price = F.col("price")
    positive = price > 0
    point = F.struct("_us", "seq", "price")
    latest = F.struct(
        "_us", "seq", *[F.col(src).alias(out) for out, src in LATEST.items()],
        F.col("ingestion_time").alias("last_ingestion_time"),
    )
    columns = [
        F.min(F.when(positive, point)).alias("_first"),
        F.max(F.when(positive, point)).alias("_last"),
        F.max(F.when(positive, price)).alias("high"),
        F.min(F.when(positive, price)).alias("low"),
        F.max(latest).alias("_latest"),
        F.count(F.lit(1)).alias("num_ticks"),
        F.count("_return").alias("_returns"),
        F.avg("_return").alias("_return_mean"),
        F.var_pop("_return").alias("_return_var"),
    ]
    columns += [F.sum(src).alias(out) for out, src in SUMS.items()]
    for out, (src, keep) in MEANS.items():
        columns.append(F.sum(F.when(keep(F.col(src)), F.col(src))).alias(f"_sum_{out}"))
        columns.append(F.count(F.when(keep(F.col(src)), F.lit(1))).alias(f"_n_{out}"))
    return columns


def _merge(pieces: DataFrame) -> DataFrame:
    """Merge the pieces of each bar; the return across a cut belongs to the later piece."""
    earlier = W.partitionBy("symbol", "_bar").orderBy(*CUT).rowsBetween(W.unboundedPreceding, -1)
    linked = pieces.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)["price"])
    before = F.col("_before")
    linked = linked.withColumn("_edge", (F.col("_first")["price"] - before) / before * 100)
    n, mean, var, edge = (F.col(c) for c in ("_returns", "_return_mean", "_return_var", "_edge"))
    count = F.sum(n) + F.count(edge)
    centre = (S.or_zero(F.sum(n * mean)) + S.or_zero(F.sum(edge))) / F.nullif(count, F.lit(0))
    squares = S.or_zero(F.sum(n * (var + mean * mean))) + S.or_zero(F.sum(edge * edge))
    spread = squares / F.nullif(count, F.lit(0)) - centre * centre
    columns = [
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("_latest").alias("_latest"),
        F.sum("num_ticks").alias("num_ticks"),
        count.alias("_returns"),
        F.greatest(spread, F.lit(0.0)).alias("_return_var"),
    ]
    columns += [F.sum(out).alias(out) for out in SUMS]
    columns += [F.sum(f"_{part}_{out}").alias(f"_{part}_{out}") for out in MEANS for part in ("sum", "n")]
    return linked.groupBy("symbol", "_bar").agg(*columns)


def _finish(merged: DataFrame, width: int, zone: str) -> DataFrame:
    start = F.timestamp_micros("_bar")
    opened, closed = F.col("_first")["price"], F.col("_last")["price"]
    columns = {
        "window_start": millis(F.col("_bar")),
        "window_end": millis(F.col("_bar") + width),
        "window_start_est": zone_text(start, zone),
        "open": opened,
        "close": closed,
        "volatility_1m": F.when(F.col("_returns") > 1, F.sqrt("_return_var")).otherwise(
            S.when_or_zero(opened > 0, (F.col("high") - F.col("low")) / opened * 100)
        ),
        "order_imbalance_ratio_1m": S.imbalance_ratio(
            F.col("total_buy_volume_1m"), F.col("total_sell_volume_1m")
        ),
        "price_change_1m": S.change(opened, closed),
        "price_change_percent_1m": S.change_percent(opened, closed),
        "last_ingestion_time": F.col("_latest")["last_ingestion_time"],
        **{out: F.col("_latest")[out] for out in LATEST},
        **{out: S.or_zero(F.try_divide(F.col(f"_sum_{out}"), F.col(f"_n_{out}"))) for out in MEANS},
    }
    done = merged.filter(F.col("_first").isNotNull()).withColumns(columns)
    done = done.withColumn("volatility_regime", S.volatility_regime(F.col("volatility_1m")))
    return done.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in BAR_SCHEMA])


def bars(
    ticks: DataFrame,
    width: int = MINUTE,
    max_ticks: int | None = None,
    chunks: Chunks | None = None,
    complete_before: Column | None = None,
    zone: str = EASTERN,
) -> DataFrame:
    """The full bar record per (symbol, ``width`` microseconds) from ticks(symbol, ts, seq, ...).

    ``complete_before`` drops bars that end after that instant (the one still open). Ticks
    without a time belong to no bar.
    """
    if max_ticks is not None:
        ticks = cap_ticks(ticks, width, max_ticks)
    feed = with_defaults(ticks.filter(F.col("ts").isNotNull())).withColumn("_us", micros(F.col("ts")))
    feed = feed.withColumn("_bar", floor_to(F.col("_us"), width))
    if chunks is None:
        chunks = measure(feed, ["symbol"], width)
    if chunks.splits or chunks.width != width:
        keys = ["symbol", "_bar", *CUT]
        pieces = with_returns(chunks.label(feed), keys).groupBy(*keys).agg(*_piece_aggregates())
        merged = _merge(pieces)
    else:
        keys = ["symbol", "_bar"]
        merged = with_returns(feed, keys).groupBy(*keys).agg(*_piece_aggregates())
    if complete_before is not None:
        merged = merged.filter(F.col("_bar") + width <= micros(complete_before))
    return _finish(merged, width, zone)


def hour_buffer(bars_: DataFrame, expected: int = 60) -> DataFrame:
    """The minute bars of each hour as one ordered list, with its completeness."""
    hour = floor_to(F.col("window_start"), 3_600_000)
    return (
        bars_.groupBy("symbol", hour.alias("hour_start"))
        .agg(F.array_sort(F.collect_list(F.struct("window_start", *[
            c for c in bars_.columns if c not in ("symbol", "window_start")
        ]))).alias("bars"))
        .withColumns({
            "rows_in_hour": F.size("bars").cast("long"),
            "complete": F.size("bars") == expected,
        })
    )
