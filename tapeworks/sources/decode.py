"""Decoding the mixed JSON feed into typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.schemas import CORRUPT, RAW_SCHEMA


def number(name: str) -> Column:
    """Numeric string as double; a missing or unreadable one counts as 0."""
    return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))


def parse(records: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse a JSON text column, other columns kept; ``_corrupt`` holds what did not parse."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(column).cast("string"), full, options)
    return records.withColumn("_json", parsed).select(
        *[c for c in records.columns if c != column and c not in schema.names], "_json.*"
    )


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, quarantined) records."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad)


KINDS = ("snapshot", "l2update", "ticker", "match")


def event_time() -> Column:
    """Time of a message: stamped by whoever landed it, or else the exchange's own."""
    return F.coalesce(F.col("ts").try_cast("timestamp"), F.col("time").try_cast("timestamp"))


def reason() -> Column:
    """Why a parsed record is set aside: unreadable, or a message without time, symbol or price; else null."""
    priced = F.col("type").isin("ticker", "match")
    return (
        F.when(F.col(CORRUPT).isNotNull(), "unreadable")
        .when(~F.coalesce(F.col("type").isin(*KINDS), F.lit(False)), None)
        .when(event_time().isNull(), "no time")
        .when(F.coalesce("symbol", "product_id").isNull(), "no symbol")
        .when(priced & F.col("price").isNull(), "no price")
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """The records set aside, with their ``reason``."""
    return parsed.withColumn("reason", reason()).filter("reason IS NOT NULL")


def quarantine_counts(parsed: DataFrame, by: str = "topic") -> DataFrame:
    """Records per topic that go on and that are set aside."""
    bad = reason().isNotNull()
    return parsed.groupBy(by).agg(
        F.count(F.when(~bad, 1)).alias("good"), F.count(F.when(bad, 1)).alias("bad")
    )


def quarantine_reasons(parsed: DataFrame, by: str = "topic") -> DataFrame:
    """Records set aside per topic and reason."""
    return quarantine(parsed).groupBy(by, "reason").agg(F.count(F.lit(1)).alias("records"))


def messages(records: DataFrame, column: str = "value") -> DataFrame:
    """Messages of the mixed feed with ``ts`` as timestamp; confirmations are ignored.

    Records that ``reason`` sets aside do not come through.
    """
    parsed = parse(records, RAW_SCHEMA, column)
    return parsed.filter(reason().isNull() & F.col("type").isin(*KINDS)).withColumns({
        "ts": event_time(),
        "seq": F.coalesce("seq", "sequence"),
        "symbol": F.coalesce("symbol", "product_id"),
    }).drop(CORRUPT, "sequence")


def trades(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("type") == "match").select(
        "symbol", "ts", "seq", number("price").alias("price"), number("size").alias("size"),
        F.when(F.col("side") == "buy", "buy").otherwise("sell").alias("side"),
    )


def tickers(feed: DataFrame) -> DataFrame:
    figures = ["price", "volume_24h", "high_24h", "low_24h", "open_24h"]
    return feed.filter(F.col("type") == "ticker").select(
        "symbol", "ts", "seq", *[number(c).alias(c) for c in figures],
        *[F.col(c).try_cast("double").alias(c) for c in ("best_bid", "best_ask")],
    )


def book_changes(feed: DataFrame, levels: int | None = None) -> DataFrame:
    """One row per level of a snapshot or per change of an update.

    All levels of a snapshot, or the ``levels`` best of each side.
    """

    def side(name: str, label: str) -> Column:
        pairs = F.coalesce(name, F.array().cast("array<array<string>>"))
        if levels is not None:
            sign = -1 if label == "buy" else 1
            ranked = F.array_sort(F.transform(pairs, lambda p: F.struct((p[0].try_cast("double") * sign).alias("at"), p.alias("p"))))
            pairs = F.transform(F.slice(ranked, 1, levels), lambda r: r["p"])
        return F.transform(pairs, lambda p: F.array(F.lit(label), p[0], p[1]))

    both = F.concat(side("bids", "buy"), side("asks", "sell"))
    changed = F.when(F.col("type") == "snapshot", both).otherwise(F.col("changes"))
    return (
        feed.filter(F.col("type").isin("snapshot", "l2update"))
        .select("symbol", "ts", "seq", F.col("type").alias("kind"),
                F.posexplode(changed).alias("part", "_c"))
        .select(
            "symbol", "ts", "seq", "kind", "part",
            F.when(F.col("_c")[0] == "buy", "buy").otherwise("sell").alias("side"),
            F.col("_c")[1].try_cast("double").alias("price"),
            F.col("_c")[2].try_cast("double").alias("size"),
        )
    )


# Figures a ticker message cannot supply; they are 0 in ticks made from tickers.
_ABSENT = [
    "buy_volume_1s", "sell_volume_1s", "bid_ask_spread_1s", "depth_2pct_1s", "bid_depth_2pct_1s",
    "ask_depth_2pct_1s", "vwap_1s", "micro_price_deviation_1s", "cvd_1s", "ofi_1s",
    "kyles_lambda_1s", "liquidity_health_1s", "mid_price_1s", "best_bid_1s", "best_ask_1s",
    "buy_sell_ratio",
]


def ticker_ticks(feed: DataFrame) -> DataFrame:
    """Ticks of the batch layer: one per ticker message, its last size as volume."""
    return feed.filter(F.col("type") == "ticker").select(
        "symbol", "ts", "seq",
        number("price").alias("price"),
        number("last_size").alias("volume_1s"),
        F.lit(1).cast("long").alias("trade_count_1s"),
        *[number(c).alias(c) for c in ("volume_24h", "high_24h", "low_24h")],
        F.coalesce("time", F.lit("")).alias("trade_time"),
        *[F.lit(0.0).alias(c) for c in _ABSENT],
    )
