"""Views a reader of bars asks for: timelines, latest rows, statistics, rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.operators.scan import own_rows, with_preceding

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
# Selectable timelines, in milliseconds.
TIMELINES = {
    "5 Minutes": 5 * 60_000,
    "15 Minutes": 15 * 60_000,
    "30 Minutes": 30 * 60_000,
    "1 Hour": HOUR_MS,
    "1 Day": 24 * HOUR_MS,
}
# Columns of the recent-rows table and their titles.
RECENT_TITLES = {
    "window_start": "Time",
    "open": "Open",
    "high": "High",
    "low": "Low",
    "close": "Close",
    "total_volume_1m": "Volume",
    "volatility_1m": "Volatility",
    "order_imbalance_ratio_1m": "Order Imbalance",
    "price_change_percent_1m": "Change %",
}
# Columns of the context document.
CONTEXT_COLUMNS = [
    "window_start", "window_end", "open", "high", "low", "close", "total_volume_1m",
    "total_buy_volume_1m", "total_sell_volume_1m", "trade_count_1m", "volatility_1m",
    "price_change_percent_1m", "order_imbalance_ratio_1m", "avg_bid_ask_spread_1m", "cvd_1m",
    "total_ofi_1m", "avg_kyles_lambda_1m", "avg_liquidity_health_1m",
]


def timeline(bars: DataFrame, as_of_ms: int, label: str = "1 Day") -> DataFrame:
    """Bars of the last ``label``; of a symbol without any in that span, all it has.

    Symbols that fall back are found first (one row each), so live ones are only filtered.
    """
    cutoff = as_of_ms - TIMELINES[label]
    quiet = bars.groupBy(F.col("symbol").alias("_quiet")).agg(F.max("window_start").alias("_newest")).filter(F.col("_newest") < cutoff)
    old = bars.filter(F.col("window_start") < cutoff)
    fallen = old.join(quiet, F.col("symbol").eqNullSafe(F.col("_quiet")), "left_semi")
    return bars.filter(F.col("window_start") >= cutoff).unionByName(fallen)


def without_nan(bars: DataFrame) -> DataFrame:
    """NaN as null, which aggregates skip."""
    figures = [name for name, kind in bars.dtypes if kind in ("double", "float")]
    return bars.withColumns({c: F.nullif(F.col(c), F.lit(float("nan")).cast(dict(bars.dtypes)[c])) for c in figures})


def present(bars: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """The wanted columns that exist; an explicit list must exist in full."""
    if wanted is not None:
        return bars.select(*wanted)
    return bars.select([c for c in CONTEXT_COLUMNS if c in bars.columns])


def titled(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", *RECENT_TITLES).withColumnsRenamed(RECENT_TITLES)


def freshness(bars: DataFrame, as_of_ms: int) -> DataFrame:
    """Last update, age of the data in seconds, and number of records per symbol."""
    return bars.groupBy("symbol").agg(
        F.max("window_start").alias("last_update"),
        ((F.lit(as_of_ms) - F.max("window_start")) / 1000).alias("data_age_seconds"),
        F.count(F.lit(1)).alias("records"),
    )


def latest(bars: DataFrame) -> DataFrame:
    """Newest bar of each symbol."""
    rest = [c for c in bars.columns if c != "symbol"]
    return (
        bars.groupBy("symbol")
        .agg(F.max_by(F.struct(*rest), F.col("window_start")).alias("_row"))
        .select("symbol", "_row.*")
    )


def tail(bars: DataFrame, n: int) -> DataFrame:
    """Last ``n`` bars of each symbol; the rank limit also runs before the shuffle."""
    newest = W.partitionBy("symbol").orderBy(F.desc("window_start"))
    return bars.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def recent(bars: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` rows over all symbols, newest first."""
    return bars.orderBy(F.desc("window_start"), "symbol").limit(n)


def sorted_bars(bars: DataFrame) -> DataFrame:
    return bars.orderBy("window_start", "symbol")


def moving_average(bars: DataFrame, column: str = "trade_count_1m", rows: int = 5) -> DataFrame:
    """Mean of the last ``rows`` bars of a symbol, fewer at the start."""
    frame = W.partitionBy("symbol", "_block").orderBy("window_start").rowsBetween(1 - rows, 0)
    return own_rows(
        with_preceding(bars, "window_start", DAY_MS, rows - 1, [column])
        .withColumn(f"{column}_ma{rows}", F.avg(column).over(frame))
    )


def statistics(bars: DataFrame) -> DataFrame:
    """One row per symbol with the summary figures of all statistics tabs; NaN counts as null."""
    bars = without_nan(bars)

    def figures(column: str, title: str, *kinds: str) -> list[Column]:
        how = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "std": F.stddev_samp}
        c = F.col(column)
        out = []
        for kind in kinds:
            if kind == "current":
                value = F.max_by(c, F.col("window_start"))
            elif kind == "range":
                value = F.max(c) - F.min(c)
            else:
                value = how[kind](c)
            out.append(value.alias(f"{title}_{kind}"))
        return out

    return bars.groupBy("symbol").agg(
        F.max("high").alias("price_high"),
        F.min("low").alias("price_low"),
        F.avg("close").alias("price_avg"),
        (F.max("high") - F.min("low")).alias("price_range"),
        *figures("close", "price", "current"),
        *figures("total_volume_1m", "volume", "sum", "avg", "max", "min"),
        *figures("volatility_1m", "volatility", "avg", "max", "min", "current"),
        *figures("avg_bid_ask_spread_1m", "spread", "avg", "min", "max", "current"),
        *figures("avg_bid_depth_2pct_1m", "bid_depth", "avg", "min", "max", "current"),
        *figures("avg_ask_depth_2pct_1m", "ask_depth", "avg", "min", "max", "current"),
        *figures("cvd_1m", "cvd", "avg", "range", "current"),
        *figures("total_ofi_1m", "ofi", "avg", "sum", "current"),
        *figures("avg_micro_price_deviation_1m", "micro_deviation", "avg", "std", "current"),
        *figures("avg_kyles_lambda_1m", "kyles_lambda", "avg", "std", "current"),
        *figures("avg_liquidity_health_1m", "health", "avg", "min", "max", "current"),
    )


def statistics_long(bars: DataFrame) -> DataFrame:
    """The same figures as (symbol, statistic, value) rows."""
    wide = statistics(bars)
    names = [c for c in wide.columns if c != "symbol"]
    return wide.select("symbol", *[F.col(c).cast("double") for c in names]).unpivot(
        "symbol", names, "statistic", "value"
    )


def regime_share(bars: DataFrame) -> DataFrame:
    """Count and percentage per volatility regime of each symbol."""
    counts = bars.groupBy("symbol", "volatility_regime").agg(F.count(F.lit(1)).alias("bars"))
    whole = F.sum("bars").over(W.partitionBy("symbol"))
    return counts.withColumn("percent", F.col("bars") / whole * 100).orderBy("symbol", F.desc("bars"))


# Figures that a summary adds up or averages.
SUMMARY_SUMS = ["total_volume_1m", "total_buy_volume_1m", "total_sell_volume_1m", "trade_count_1m"]
SUMMARY_MEANS = ["volatility_1m", "avg_bid_ask_spread_1m", "cvd_1m", "total_ofi_1m"]
HOURLY_MEANS = ["volatility_1m", "avg_bid_ask_spread_1m", "order_imbalance_ratio_1m", "cvd_1m", "total_ofi_1m"]


def _first_to_last(columns: list[str]) -> dict[str, Column]:
    """Open, high, low, close of a group of bars, for the columns that exist."""
    kinds = {
        "open": F.min_by("open", "window_start") if "open" in columns else None,
        "high": F.max("high") if "high" in columns else None,
        "low": F.min("low") if "low" in columns else None,
        "close": F.max_by("close", "window_start") if "close" in columns else None,
    }
    return {name: value for name, value in kinds.items() if value is not None}


def window_summary(bars: DataFrame) -> DataFrame:
    """Rows, span, first open, last close, return, extremes, sums and means per symbol; NaN counts as null."""
    bars, columns = without_nan(bars), bars.columns
    end = "window_end" if "window_end" in columns else "window_start"
    figures = {
        "window_rows": F.count(F.lit(1)),
        "window_start": F.min("window_start"),
        "window_end": F.max_by(end, "window_start"),
        **_first_to_last(columns),
        **{f"{c}_sum": F.sum(c) for c in SUMMARY_SUMS if c in columns},
        **{f"{c}_mean": F.avg(c) for c in SUMMARY_MEANS if c in columns},
    }
    out = bars.groupBy("symbol").agg(*[v.alias(f"_{n}") for n, v in figures.items()])
    out = out.select("symbol", *[F.col(f"_{n}").alias(n) for n in figures])
    if "open" in columns and "close" in columns:
        ratio = F.try_divide(F.nullif("close", F.lit(0.0)), F.nullif("open", F.lit(0.0)))
        out = out.withColumn("return_pct", (ratio - 1) * 100)
    return out


def hourly(bars: DataFrame, last: int | None = 30) -> DataFrame:
    """Hour rollup per symbol, empty hours inside the range included (sums 0, the rest null).

    NaN counts as null.
    """
    bars, columns = without_nan(bars), bars.columns
    hour = F.col("window_start") - F.pmod(F.col("window_start"), F.lit(HOUR_MS))
    sums = [c for c in SUMMARY_SUMS if c in columns]
    figures = {
        **_first_to_last(columns),
        **{c: F.sum(c) for c in sums},
        **{c: F.avg(c) for c in HOURLY_MEANS if c in columns},
    }
    rolled = (
        bars.withColumn("_hour", hour).groupBy("symbol", "_hour")
        .agg(*[v.alias(f"_{n}") for n, v in figures.items()])
        .select("symbol", F.col("_hour").alias("hour_start"), *[F.col(f"_{n}").alias(n) for n in figures])
    )
    # every hour also lays out the empty hours up to the next one
    following = F.lead("hour_start").over(W.partitionBy("symbol").orderBy("hour_start"))
    until = F.coalesce(following - HOUR_MS, F.col("hour_start"))
    laid = rolled.withColumn("_until", until).withColumn(
        "_hour", F.explode(F.sequence("hour_start", "_until", F.lit(HOUR_MS)))
    )
    filled = F.col("_hour") == F.col("hour_start")
    full = laid.select("symbol", F.col("_hour").alias("hour_start"), *[
        F.when(filled, F.col(n)).otherwise(F.lit(0) if n in sums else F.lit(None)).alias(n) for n in figures
    ])
    if last is None:
        return full
    newest = W.partitionBy("symbol").orderBy(F.desc("hour_start"))
    return full.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= last).drop("_rank")


def divergence(bars: DataFrame, n: int = 5) -> DataFrame:
    """Momentum over ``n`` bars, and bars where price and volume delta move apart."""
    order = W.partitionBy("symbol", "_block").orderBy("window_start")
    momentum = F.col("close") - F.lag("close", n).over(order)
    drift = F.col("cvd_1m") - F.lag("cvd_1m", n).over(order)
    moved = own_rows(
        with_preceding(bars, "window_start", DAY_MS, n, ["close", "cvd_1m"])
        .withColumns({"momentum": momentum, "cvd_drift": drift})
    )
    rising, falling = F.col("momentum") > 0, F.col("momentum") < 0
    return moved.withColumn(
        "divergence",
        F.when(rising & (F.col("cvd_drift") < 0), "bearish")
        .when(falling & (F.col("cvd_drift") > 0), "bullish")
        .otherwise("none"),
    )
