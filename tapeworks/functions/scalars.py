"""Microstructure formulas as Column expressions. A missing input yields 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the volatility regimes, in percent.
REGIME_LOW, REGIME_MEDIUM = 0.1, 0.5
# Fixed value: |lambda| from which the price impact is called high.
HIGH_IMPACT = 1000.0


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def when_or_zero(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(0.0))


def spread(bid: Column, ask: Column) -> Column:
    return when_or_zero((bid > 0) & (ask > 0), ask - bid)


def mid_price(bid: Column, ask: Column) -> Column:
    return when_or_zero((bid > 0) & (ask > 0), (bid + ask) / 2)


def micro_deviation(price: Column, mid: Column) -> Column:
    return or_zero(when_or_zero(mid > 0, price - mid))


def order_flow_imbalance(bid_delta: Column, ask_delta: Column) -> Column:
    return or_zero(bid_delta) - or_zero(ask_delta)


def price_impact(price_change: Column, signed_volume: Column) -> Column:
    return or_zero(F.try_divide(price_change, signed_volume))


def liquidity_health(depth: Column, spread_: Column, volatility: Column) -> Column:
    divisor = F.when(volatility > 0, spread_ * volatility).otherwise(F.lit(1.0))
    return or_zero(when_or_zero((spread_ > 0) & (divisor > 0), F.try_divide(depth, divisor)))


def change(first: Column, last: Column) -> Column:
    return last - first


def change_percent(first: Column, last: Column) -> Column:
    return when_or_zero(first > 0, F.try_divide(last - first, first) * 100)


def buy_sell_ratio(buy: Column, sell: Column) -> Column:
    return when_or_zero(sell > 0, F.try_divide(buy, sell))


def imbalance_ratio(buy: Column, sell: Column) -> Column:
    return when_or_zero(buy + sell > 0, F.try_divide(buy - sell, buy + sell))


def volatility_regime(volatility: Column) -> Column:
    return (
        F.when(volatility < REGIME_LOW, "low")
        .when(volatility < REGIME_MEDIUM, "medium")
        .otherwise("high")
    )


def current_price(latest: Column, ticker: Column) -> Column:
    """Last trade or ticker price; rows without a positive ticker are not emitted at all."""
    return F.when(latest > 0, latest).otherwise(ticker)


def choose_quote(book: Column, ticker: Column, book_ready: Column, ticker_ready: Column) -> Column:
    return F.when(book_ready, book).when(ticker_ready, ticker).otherwise(F.lit(0.0))


def with_labels(df: DataFrame) -> DataFrame:
    """Direction words and sign colours shown next to the figures of a bar."""

    def sign(name, up, down):
        return F.when(F.col(name) > 0, up).otherwise(down)

    labels = {
        "imbalance_label": sign("order_imbalance_ratio_1m", "Buy", "Sell"),
        "cvd_label": sign("cvd_1m", "Buying Pressure", "Selling Pressure"),
        "ofi_label": sign("total_ofi_1m", "Bid Pressure", "Ask Pressure"),
        "impact_label": F.when(F.abs(F.col("avg_kyles_lambda_1m")) < HIGH_IMPACT, "Low Impact")
        .otherwise("High Impact"),
    }
    for name in ("order_imbalance_ratio_1m", "cvd_1m", "total_ofi_1m", "avg_micro_price_deviation_1m"):
        labels[f"{name}_colour"] = sign(name, "green", "red")
    return df.withColumns(labels)
