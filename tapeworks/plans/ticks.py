"""The tick table: one enriched row per symbol and step, from trades, tickers and book changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import SECOND, iso_text, micros, millis
from tapeworks.operators.align import grid, grid_chunks
from tapeworks.operators.book import DEPTH_BAND, quotes
from tapeworks.operators.chunks import measure
from tapeworks.operators.flow import bucketed, order_flow, trade_aggregates
from tapeworks.operators.horizons import HORIZONS, horizons
from tapeworks.operators.scan import last_known, scan
from tapeworks.schemas import TICK_SCHEMA
from tapeworks.session import settled


def side_depth(levels: Column, mid: Column, bid: bool, band: float = DEPTH_BAND) -> Column:
    """Size of an array of levels within ``band`` of the mid, 0 without a mid."""
    if bid:
        near = F.filter(levels, lambda x: x["price"] >= mid * (1 - band))
    else:
        near = F.filter(levels, lambda x: x["price"] <= mid * (1 + band))
    total = F.aggregate(near, F.lit(0.0), lambda total, x: total + x["size"])
    return S.or_zero(F.when(mid > 0, total))


def narrow_book(bids: Column, asks: Column, band: float = DEPTH_BAND) -> Column:
    """What a tick needs of a book: best prices, and the depth around their middle.

    With one side empty the middle comes from the ticker, so only then the levels themselves go on.
    """
    bid, ask = F.get(bids, F.lit(0))["price"], F.get(asks, F.lit(0))["price"]
    both = (F.size(bids) > 0) & (F.size(asks) > 0)
    mid = S.mid_price(bid, ask)
    return F.struct(
        bid.alias("bid"), ask.alias("ask"), both.alias("both"),
        F.when(both, side_depth(bids, mid, bid=True, band=band)).alias("bid_depth"),
        F.when(both, side_depth(asks, mid, bid=False, band=band)).alias("ask_depth"),
        F.when(~both, bids).alias("bids"), F.when(~both, asks).alias("asks"),
    )


def per_bucket(trades: DataFrame, tickers: DataFrame, changes: DataFrame, step: int) -> DataFrame:
    """What each bucket brings: flow, impact, order flow, and the last price, ticker and book."""
    by, point = ["symbol", "bucket"], F.struct(micros(F.col("ts")), "seq")

    feed = trades.withColumn("_us", micros(F.col("ts")))
    linked = last_known(feed, measure(feed, ["symbol"]), {"_before": F.col("price")})
    signed = F.when(F.col("side") == "buy", F.col("size")).otherwise(-F.col("size"))
    known = F.col("_before") > 0
    flow = bucketed(linked, step).groupBy(*by).agg(
        *trade_aggregates(),
        F.sum(F.when(known, F.col("price") - F.col("_before"))).alias("_move"),
        F.sum(F.when(known, signed)).alias("_signed"),
        F.max(F.struct("_us", "seq", "price")).alias("_traded"),
    )
    # a ticker without both quotes leaves the quotes of an earlier one standing
    shown = [c for c in tickers.columns if c not in ("symbol", "ts", "seq")]
    quoted = F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull()
    told = bucketed(tickers, step).groupBy(*by).agg(
        F.max_by(F.struct(*shown), point).alias("ticker"),
        F.max_by(F.struct("best_bid", "best_ask"), F.when(quoted, point)).alias("quote"),
        F.max(F.struct(micros(F.col("ts")).alias("_us"), "seq", "price")).alias("_told"),
    )
    feeds = [df.select("symbol", "ts") for df in (trades, tickers, changes)]
    whole = grid(feeds[0].unionByName(feeds[1]).unionByName(feeds[2]), step)
    for part in (
        flow, told, order_flow(changes, step).select(*by, "ofi"),
        quotes(changes, step).select(*by, narrow_book(F.col("bids"), F.col("asks")).alias("book")),
    ):
        whole = whole.join(part, by, "left")
    return whole.withColumns({
        "latest_price": F.greatest("_traded", "_told")["price"],
        "kyles_lambda": S.price_impact(F.col("_move"), F.col("_signed")),
    })


def ticks(
    trades: DataFrame,
    tickers: DataFrame,
    changes: DataFrame,
    step: int = SECOND,
    widths: dict[str, int] | None = None,
) -> DataFrame:
    """Ticks emitted at the end of each ``step``, from the first ticker with a price on.

    ``widths`` overrides the lengths of the four horizons, whose names stay.
    """
    whole = settled(per_bucket(trades, tickers, changes, step))
    buy, sell = S.or_zero(F.col("buy_volume")), S.or_zero(F.col("sell_volume"))
    kept = ["latest_price", "ticker", "quote", "book"]
    state = scan(
        whole, grid_chunks(step), last={c: F.col(c) for c in kept},
        totals={"cvd_1s": ("sum", buy - sell)}, inclusive=True,
    )
    has_book = F.coalesce("book.both", F.lit(False))
    has_quote = F.col("quote").isNotNull()
    ask_top, bid_top = F.col("book.ask"), F.col("book.bid")
    at = F.col("bucket") + step
    emitted = state.filter(F.col("ticker.price") > 0).select(
        "symbol",
        F.timestamp_micros(at).alias("ts"),
        F.col("bucket").alias("seq"),
        S.current_price(F.col("latest_price"), F.col("ticker.price")).alias("price"),
        buy.alias("buy_vol"),
        sell.alias("sell_vol"),
        *[F.col(f"ticker.{c}").alias(c) for c in ("volume_24h", "high_24h", "low_24h", "open_24h")],
        F.coalesce("trade_count", F.lit(0)).alias("trade_count_1s"),
        S.choose_quote(bid_top, F.col("quote.best_bid"), has_book, has_quote).alias("best_bid_1s"),
        S.choose_quote(ask_top, F.col("quote.best_ask"), has_book, has_quote).alias("best_ask_1s"),
        "book",
        S.or_zero(F.col("vwap")).alias("vwap_1s"),
        "avg_price",
        "cvd_1s",
        S.or_zero(F.col("ofi")).alias("ofi_1s"),
        S.or_zero(F.col("kyles_lambda")).alias("kyles_lambda_1s"),
    )
    spans = {("24h_calculated" if n == "24h" else n): w for n, w in (widths or HORIZONS).items()}
    # the grid sets the pace of the samples, so blocks need no counting
    return finish_ticks(horizons(with_depth(emitted, narrow=True), spans, rows_per_block=None))


def with_depth(samples: DataFrame, narrow: bool = False, summed: bool = False) -> DataFrame:
    """Mid price, spread and depth; the book itself, whole or ``narrow``, is not carried any further.

    A ``summed`` book is no more than the depth of its sides around that mid price.
    """
    bid, ask, mid = F.col("best_bid_1s"), F.col("best_ask_1s"), F.col("mid_price_1s")
    return samples.withColumns({
        "mid_price_1s": S.mid_price(bid, ask),
        "bid_ask_spread_1s": S.spread(bid, ask),
    }).withColumns({
        f"{side}_depth_2pct_1s": F.col(f"book.{side}_depth") if summed else F.coalesce(
            *([F.when(F.col("book.both"), F.col(f"book.{side}_depth"))] if narrow else []),
            side_depth(F.col(f"book.{levels}"), mid, bid=side == "bid"),
        ) for side, levels in (("bid", "bids"), ("ask", "asks"))
    }).drop("book")


def finish_ticks(samples: DataFrame) -> DataFrame:
    """Derive the remaining figures of a tick and put them in the declared order."""
    price, mid = F.col("price"), F.col("mid_price_1s")
    ratio = S.buy_sell_ratio(F.col("buy_vol"), F.col("sell_vol"))
    moved = F.abs(F.col("price_change_percent_1s"))
    out = samples.withColumn("depth_2pct_1s", F.col("bid_depth_2pct_1s") + F.col("ask_depth_2pct_1s"))
    out = out.withColumns({
        "timestamp": millis(micros(F.col("ts"))),
        "number_of_trades": F.col("trade_count_1s"),
        "volume_1s": F.col("buy_vol") + F.col("sell_vol"),
        "buy_volume_1s": F.col("buy_vol"),
        "sell_volume_1s": F.col("sell_vol"),
        "buy_sell_volume_ratio_1s": ratio,
        "buy_sell_ratio": ratio,
        "price_change_24h": price - F.col("open_24h"),
        "price_change_percent_24h": S.change_percent(F.col("open_24h"), price),
        "micro_price_deviation_1s": S.micro_deviation(F.col("avg_price"), mid),
        "liquidity_health_1s": S.liquidity_health(
            F.col("depth_2pct_1s"), F.col("bid_ask_spread_1s"),
            F.when(moved != 0, moved).otherwise(F.lit(1.0)),
        ),
        "ingestion_time": iso_text(F.col("ts")),
    })
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TICK_SCHEMA])
