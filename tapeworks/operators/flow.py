"""Trade flow, price impact and volume delta from trades and book changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import SECOND, floor_to, micros
from tapeworks.operators.chunks import Chunks, measure
from tapeworks.operators.scan import last_known, running


def bucketed(feed: DataFrame, width: int, name: str = "bucket") -> DataFrame:
    return feed.withColumn(name, floor_to(micros(F.col("ts")), width))


def trade_aggregates() -> list:
    """Flow and volume-weighted price of a group of trades(price, size, side)."""
    size = S.or_zero(F.col("size"))
    price = F.col("price")
    traded = (size > 0) & price.isNotNull()
    buy = F.col("side").eqNullSafe("buy")
    return [
        F.sum(F.when(buy, size).otherwise(0.0)).alias("buy_volume"),
        F.sum(F.when(buy, 0.0).otherwise(size)).alias("sell_volume"),
        F.sum(size).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        S.or_zero(F.try_divide(
            F.sum(F.when(traded, price * size)), F.sum(F.when(traded, size))
        )).alias("vwap"),
        F.avg("price").alias("avg_price"),
    ]


def trade_flow(trades: DataFrame, width: int = SECOND) -> DataFrame:
    """Buy, sell and total volume, count, VWAP and mean price per symbol and bucket."""
    return bucketed(trades, width).groupBy("symbol", "bucket").agg(*trade_aggregates())


def vwap(trades: DataFrame, by: list[str], price: str = "price", size: str = "size") -> DataFrame:
    """Volume-weighted price over rows with a price and a positive volume; 0 without any."""
    volume, paid = F.col(size), F.col(price)
    traded = (volume > 0) & paid.isNotNull()
    weighted = F.sum(F.when(traded, paid * volume))
    total = F.sum(F.when(traded, volume))
    return trades.groupBy(*by).agg(S.or_zero(F.try_divide(weighted, total)).alias("vwap"))


def micro_deviation(flow: DataFrame, mids: DataFrame) -> DataFrame:
    """Mean deviation of a bucket's trades from its mid price (mids: symbol, bucket, mid)."""
    mid = F.col("mid")
    return flow.join(mids, ["symbol", "bucket"], "left").withColumn(
        "micro_deviation", S.micro_deviation(F.col("avg_price"), mid)
    )


def order_flow(changes: DataFrame, width: int = SECOND) -> DataFrame:
    """Sizes quoted by bid changes minus sizes quoted by ask changes; snapshots do not count."""
    bid = F.col("side") == "buy"
    return (
        bucketed(changes.filter(F.col("kind") == "l2update"), width)
        .groupBy("symbol", "bucket")
        .agg(
            S.or_zero(F.sum(F.when(bid, F.col("size")))).alias("bid_delta"),
            S.or_zero(F.sum(F.when(~bid, F.col("size")))).alias("ask_delta"),
        )
        .withColumn("ofi", S.order_flow_imbalance(F.col("bid_delta"), F.col("ask_delta")))
    )


def previous_trade(trades: DataFrame, chunks: Chunks | None = None) -> DataFrame:
    """Price change against the previous trade and signed volume; rows without one drop out."""
    feed = trades.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"])
    linked = last_known(feed, chunks, {"previous_price": F.col("price")})
    return (
        linked.filter(F.col("previous_price") > 0)
        .withColumns({
            "price_change": F.col("price") - F.col("previous_price"),
            "signed_volume": F.when(F.col("side") == "buy", F.col("size")).otherwise(-F.col("size")),
        })
        .drop("_us")
    )


def price_impact(trades: DataFrame, width: int = SECOND, chunks: Chunks | None = None) -> DataFrame:
    """Summed price change over summed signed volume, per symbol and bucket."""
    return (
        bucketed(previous_trade(trades, chunks), width)
        .groupBy("symbol", "bucket")
        .agg(F.sum("price_change").alias("_dp"), F.sum("signed_volume").alias("_sv"))
        .select("symbol", "bucket", S.price_impact(F.col("_dp"), F.col("_sv")).alias("kyles_lambda"))
    )


def volume_delta(trades: DataFrame, session: str | None = None, chunks: Chunks | None = None) -> DataFrame:
    """Running buy minus sell volume per symbol, restarting with each feed session if named."""
    keys = ["symbol", session] if session else ["symbol"]
    feed = trades.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, keys)
    size = S.or_zero(F.col("size"))
    signed = F.when(F.col("side") == "buy", size).otherwise(-size)
    return running(feed, chunks, {"cvd": ("sum", signed)}).drop("_us")


def extremes(tickers: DataFrame, chunks: Chunks | None = None) -> DataFrame:
    """Running maximum of the 24 h high and minimum of the positive 24 h low."""
    feed = tickers.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"])
    low = F.when(F.col("low_24h") > 0, F.col("low_24h"))
    totals = {"running_high": ("max", F.col("high_24h")), "running_low": ("min", low)}
    return running(feed, chunks, totals).drop("_us")
