"""Declared schemas of ticks, bars and raw feed messages."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*groups: tuple[str, T.DataType]) -> T.StructType:
    fields = []
    for names, kind in groups:
        fields += [T.StructField(name, kind, True) for name in names.split()]
    return T.StructType(fields)


# Field names and order of the two published records.
TICK_SCHEMA = _struct(
    ("symbol", T.StringType()),
    ("price", T.DoubleType()),
    ("timestamp", T.LongType()),
    ("volume_24h high_24h low_24h price_change_24h price_change_percent_24h", T.DoubleType()),
    ("number_of_trades", T.LongType()),
    ("high_1s low_1s price_change_1s price_change_percent_1s volume_1s buy_volume_1s "
     "sell_volume_1s buy_sell_volume_ratio_1s buy_sell_ratio", T.DoubleType()),
    ("trade_count_1s", T.LongType()),
    ("high_1min low_1min price_change_1min price_change_percent_1min volume_1min "
     "buy_volume_1min sell_volume_1min", T.DoubleType()),
    ("high_1h low_1h price_change_1h price_change_percent_1h volume_1h buy_volume_1h "
     "sell_volume_1h", T.DoubleType()),
    ("volume_24h_calculated buy_volume_24h_calculated sell_volume_24h_calculated", T.DoubleType()),
    ("bid_ask_spread_1s mid_price_1s best_bid_1s best_ask_1s depth_2pct_1s bid_depth_2pct_1s "
     "ask_depth_2pct_1s vwap_1s micro_price_deviation_1s cvd_1s ofi_1s kyles_lambda_1s "
     "liquidity_health_1s", T.DoubleType()),
    ("ingestion_time", T.StringType()),
)

BAR_SCHEMA = _struct(
    ("symbol", T.StringType()),
    ("window_start window_end", T.LongType()),
    ("window_start_est", T.StringType()),
    ("open high low close total_volume_1m total_buy_volume_1m total_sell_volume_1m "
     "volume_24h high_24h low_24h volatility_1m order_imbalance_ratio_1m", T.DoubleType()),
    ("trade_count_1m", T.LongType()),
    ("avg_buy_sell_ratio_1m price_change_1m price_change_percent_1m", T.DoubleType()),
    ("num_ticks", T.LongType()),
    ("last_ingestion_time", T.StringType()),
    ("avg_bid_ask_spread_1m avg_depth_2pct_1m avg_bid_depth_2pct_1m avg_ask_depth_2pct_1m "
     "avg_vwap_1m avg_micro_price_deviation_1m cvd_1m total_ofi_1m avg_ofi_1m "
     "avg_kyles_lambda_1m avg_liquidity_health_1m avg_mid_price_1m latest_best_bid_1m "
     "latest_best_ask_1m", T.DoubleType()),
    ("volatility_regime", T.StringType()),
)

# One superset schema decodes every message kind of the mixed feed; the fields
# symbol, ts (ISO-8601) and seq are stamped by whoever lands the messages.
_PAIRS = T.ArrayType(T.ArrayType(T.StringType()))
RAW_SCHEMA = _struct(
    ("type product_id symbol ts", T.StringType()),
    ("seq sequence", T.LongType()),
    ("bids asks changes", _PAIRS),
    ("price size side last_size time volume_24h high_24h low_24h open_24h best_bid best_ask",
     T.StringType()),
)
CORRUPT = "_corrupt"
