"""Streaming ticks: per-second aggregates of the joined feeds, then state per symbol."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import SECOND, micros
from tapeworks.operators.book import DEPTH_BAND, LEVELS, MAX_LEVELS, best_levels
from tapeworks.operators.flow import trade_aggregates
from tapeworks.operators.horizons import HORIZONS, METRICS
from tapeworks.plans.ticks import finish_ticks, with_depth
from tapeworks.streaming.book import KINDS, SIDES, fold, pack, unpack
from tapeworks.streaming.drain import use_rocksdb
from tapeworks.streaming.packed import gather, pieces

FIGURES = ["price", "volume_24h", "high_24h", "low_24h", "open_24h"]
PER_TICK = ["price", "buy_vol", "sell_vol", *FIGURES[1:], "best_bid_1s", "best_ask_1s", "vwap_1s",
            "avg_price", "cvd_1s", "ofi_1s", "kyles_lambda_1s"]
# What a step's book changes carry, each an array of numbers: kinds and sides by their codes.
CHANGES = ["_us", "seq", "kind_code", "side_code", "price", "size"]
# A step's own figures, those of its last ticker and quote, and which of these it has.
STEP = ["bucket", "trade_count", "buy_volume", "sell_volume", "vwap", "avg_price", "signed", "ofi", "first_price",
        "first_signed", "last_trade", "last_price"]
TICKER, QUOTE = ["price", *FIGURES[1:]], ["best_bid", "best_ask"]
STEP_COLUMNS = [*STEP, "ticker_there", *[f"ticker_{c}" for c in TICKER], "quote_there", *[f"quote_{c}" for c in QUOTE],
                "n_changes", "first_change"]
Step = namedtuple("Step", STEP_COLUMNS)
# Figures of a tick that only its own messages give, with their values in a quiet step, and those it hands on.
BROUGHT = ["trade_count_1s", "buy_vol", "sell_vol", "vwap_1s", "avg_price", "ofi_1s", "kyles_lambda_1s"]
QUIET = (0, 0.0, 0.0, 0.0, np.nan, 0.0, 0.0)
CARRIED = ["price", *FIGURES[1:], "best_bid_1s", "best_ask_1s", "cvd_1s", "bid_depth", "ask_depth"]
# Fixed value: ticks made, and handed on, at a time.
BATCH_TICKS = 20_000
STATE = (
    f"bucket long, cvd double, previous double, latest double, ticker array<double>, "
    f"quote array<double>, bids {LEVELS}, asks {LEVELS}, history binary"
)


def combined(trades: DataFrame, tickers: DataFrame, changes: DataFrame) -> DataFrame:
    """One stream of all three feeds, so that one watermark and one grouping serve them."""
    shown = [c for c in tickers.columns if c not in ("symbol", "ts", "seq", "price")]
    part = F.col("part") if "part" in changes.columns else F.lit(0)
    return (
        trades.select("symbol", "ts", "seq", F.lit("trade").alias("source"), "price", "size", "side")
        .unionByName(tickers.select("symbol", "ts", "seq", F.lit("ticker").alias("source"), "price", *shown),
                     allowMissingColumns=True)
        .unionByName(changes.select("symbol", "ts", "seq", F.lit("book").alias("source"), part.cast("int").alias("part"),
                                    "kind", "price", "size", "side"), allowMissingColumns=True)
    )


def per_step(feed: DataFrame, step: str, lateness: str) -> DataFrame:
    """What each step brings per symbol; closed by the watermark."""
    marked = feed.withWatermark("ts", lateness).withColumn("_us", micros(F.col("ts")))
    trade, ticker, change = (F.col("source") == s for s in ("trade", "ticker", "book"))
    at = [F.col("_us"), F.col("seq")]
    bid = F.col("side") == "buy"
    quoted = ticker & F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull()
    # trade aggregates see trades only: other rows get nulls in their columns
    names = ["buy_volume", "sell_volume", "volume", "trade_count", "vwap", "avg_price"]
    flow = marked.withColumns({
        "_price": F.col("price"), "_size": F.col("size"), "_side": F.col("side"),
        "price": F.when(trade, F.col("price")), "size": F.when(trade, F.col("size")),
    })
    price, size, side = F.col("_price"), F.col("_size"), F.col("_side")
    signed = F.when(side == "buy", size).otherwise(-size)
    kind_code = F.when(F.col("kind") == KINDS[1], 1).otherwise(0).cast("byte")
    side_code = F.when(side == SIDES[1], 1).when(side == SIDES[0], 0).cast("byte")
    grouped = flow.groupBy("symbol", F.window("ts", step).alias("w")).agg(
        *[a for a, n in zip(trade_aggregates(), names) if n != "trade_count"],
        F.count(F.when(trade, 1)).alias("trade_count"),
        F.min(F.when(trade, F.struct(*at, price.alias("price"), signed.alias("signed")))).alias("first_trade"),
        F.max(F.when(trade, F.struct(*at, price.alias("price")))).alias("last_trade"),
        F.sum(F.when(trade, signed)).alias("signed"),
        F.max(F.when(trade | ticker, F.struct(*at, price.alias("price")))).alias("last_price"),
        F.max(F.when(ticker, F.struct(*at, F.array(price, *FIGURES[1:]).alias("figures")))).alias("ticker"),
        F.max(F.when(quoted, F.struct(*at, F.array("best_bid", "best_ask").alias("quote")))).alias("quote"),
        S.or_zero(F.sum(F.when(change & (F.col("kind") == "l2update"), F.when(bid, size).otherwise(-size)))).alias("ofi"),
        F.array_sort(F.collect_list(F.when(change, F.struct(
            *at, "part", "kind", side.alias("_of"), price.alias("price"), size.alias("size"),
            kind_code.alias("kind_code"), side_code.alias("side_code"))))).alias("changes"),
    )
    return grouped.select(
        "symbol", F.window_time("w").alias("closed"), micros(F.col("w.start")).alias("bucket"),
        "buy_volume", "sell_volume", "trade_count", "vwap", "avg_price", "signed", "ofi",
        *[F.col("changes")[c].alias(f"change_{c}") for c in CHANGES],
        F.col("first_trade.price").alias("first_price"), F.col("first_trade.signed").alias("first_signed"),
        F.col("last_trade.price").alias("last_trade"), F.col("last_price.price").alias("last_price"),
        F.col("ticker.figures").alias("ticker"), F.col("quote.quote").alias("quote"),
    )


def _flat(lists) -> np.ndarray:
    """The numbers of many arrays, one behind the other."""
    held = [x for x in lists if len(x)]
    return np.concatenate(held) if held else np.empty(0)


def _figures(lists, names: list[str]) -> dict[str, np.ndarray]:
    """Arrays of figures, some of them missing, as a column per name; a column more tells which are there."""
    there = np.array([x is not None for x in lists], bool)
    table = np.full((len(there), len(names)), np.nan)
    if there.any():
        table[there] = np.array([x for x in lists if x is not None], dtype="float64")
    return dict(zip(["there", *names], [there, *table.T]))


def packed(frames: Iterable[pd.DataFrame]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The steps of a symbol, and their book changes, as columns of numbers; each step knows where its changes stand."""
    changes, n = {c: [] for c in CHANGES}, 0

    def slim() -> Iterator[pd.DataFrame]:
        nonlocal n
        for frame in frames:
            for c in CHANGES:
                changes[c].append(_flat(frame[f"change_{c}"]))
            counts = np.array([len(x) for x in frame[f"change_{CHANGES[0]}"]], "int64")
            columns = {c: frame[c].to_numpy() for c in STEP}
            for name, parts in (("ticker", TICKER), ("quote", QUOTE)):
                columns |= {f"{name}_{c}": x for c, x in _figures(frame[name], parts).items()}
            yield pd.DataFrame({**columns, "n_changes": counts, "first_change": n + np.cumsum(counts) - counts})
            n += counts.sum()

    steps = gather(slim(), STEP_COLUMNS)
    return steps, {c: _flat(changes.pop(c)) for c in CHANGES}


def _changes(changes: dict[str, np.ndarray], start: int, n: int) -> Iterator[tuple]:
    """The book changes of one step, in order, as (us, seq, kind, side, price, size)."""
    columns = [changes[c][start:start + n].tolist() for c in CHANGES]
    for us, seq, kind, side, price, size in zip(*columns):
        if price == price:  # a change without a price names no level
            yield us, seq, KINDS[kind], SIDES[side], price, None if size != size else size


def _or(value, default):
    return default if value is None or value != value else value


def _depth(levels: list[dict], mid: float, bid: bool) -> float:
    """``plans.ticks.side_depth`` of the levels of one side."""
    if not mid > 0:
        return 0.0
    end = mid * (1 - DEPTH_BAND) if bid else mid * (1 + DEPTH_BAND)
    near = [x["size"] for x in levels if (x["price"] >= end if bid else x["price"] <= end)]
    return 0.0 if None in near else float(sum(near))


def _sliding(values: np.ndarray, combine: np.ufunc, none: float, m: int, past: int, start: int) -> np.ndarray:
    """Each of the ``values`` behind the first ``past``, combined with the m - 1 before it.

    ``start`` is the place of the first value. Places are cut into blocks of m: a span is the end of one block and the
    start of the next, both running aggregates, so a value costs the same whatever m, and sums subtract nothing.
    """
    if m == 1:
        return values[past:]
    gone = max(0, past - m + 1)
    values, past, front = values[gone:], past - gone, (start + gone) % m
    blocks = np.full(-(-(front + len(values)) // m) * m, none)
    blocks[front:front + len(values)] = values
    blocks = blocks.reshape(-1, m)
    heads = combine.accumulate(blocks, axis=1).ravel()
    tails = combine.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.arange(front + past, front + len(values))
    out = heads[at]
    two = (at % m != m - 1) & (at >= m)  # a span that fills its block, or has none before it, is the block's start alone
    out[two] = combine(tails[at[two] - m + 1], out[two])
    return out


class LookBack:
    """The metrics of every horizon at each step of a symbol, from the steps before it.

    ``history`` holds the ticks of the longest horizon as (time, price, buy, sell). Steps without a tick have no price.
    """

    def __init__(self, step: int, widths: dict[str, int], history: bytes, last: int | None):
        self.step, self.sizes = step, [max(1, -(-w // step)) for w in widths.values()]
        ticks = np.frombuffer(history, dtype="float64").reshape(-1, 4) if history else np.empty((0, 4))
        back = ((last - ticks[:, 0]) // step).astype("int64") if len(ticks) else np.empty(0, "int64")
        self.past = np.zeros((3, min(max(self.sizes) - 1, int(back.max(initial=-1)) + 1)))
        self.past[0] = np.nan
        kept = back < self.past.shape[1]
        self.past[:, self.past.shape[1] - 1 - back[kept]] = ticks[kept, 1:].T

    def add(self, at: np.ndarray, *values: np.ndarray) -> np.ndarray:
        """The metrics, a column each, of the steps that end ``at``; they follow those of the call before without a gap."""
        n = self.past.shape[1]
        price, buy, sell = whole = np.hstack([self.past, values])
        ticked, places = ~np.isnan(price), np.arange(len(price))
        # the first price of a span is that of the next tick from its start on
        following = np.minimum.accumulate(np.where(ticked, places, len(price) - 1)[::-1])[::-1]
        start, made = int(at[0]) // self.step - n, []
        for m in self.sizes:
            high = _sliding(np.where(ticked, price, -np.inf), np.maximum, -np.inf, m, n, start)
            low = _sliding(np.where(ticked, price, np.inf), np.minimum, np.inf, m, n, start)
            first = price[following[np.maximum(places[n:] - m + 1, 0)]]
            move = price[n:] - first
            b, s = (_sliding(x, np.add, 0.0, m, n, start) for x in (buy, sell))
            made += [high, low, move, move / first * 100, b + s, b, s]
        self.past = whole[:, max(0, len(price) - max(self.sizes) + 1):].copy()
        return np.column_stack(made)

    def history(self, last: int) -> bytes:
        at = last - self.step * np.arange(self.past.shape[1] - 1, -1, -1, dtype="float64")
        return np.column_stack([at, *self.past])[~np.isnan(self.past[0])].tobytes()


class TickMaker(StatefulProcessor):
    """Carries prices, quotes, book and volume delta from step to step, filling quiet steps.

    The steps of a micro-batch are held as numbers. A stretch is a step, or what the state holds, with the quiet steps
    behind it: it is kept as one row and laid out when its ticks are handed on.
    """

    def __init__(self, step: int, widths: dict[str, int], k: int):
        self.step, self.widths, self.k = step, widths, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        steps, changes = packed(rows)
        bucket, cvd, previous, latest, ticker, quote, bids, asks, history = (
            self.state.get() or (None, 0.0, None, None, None, None, [], [], b"")
        )
        sides = unpack((bids, asks))
        back = LookBack(self.step, self.widths, history, None if bucket is None else bucket + self.step)
        # stretches whose end is known, the ticks they make, and the stretch still open: its start and its figures
        closed, n = [], 0
        start, figures = (None, None) if bucket is None else (bucket + self.step, self._carried(cvd, latest, ticker, quote, sides))
        brought = QUIET
        for piece in pieces(steps, np.argsort(steps["bucket"], kind="stable")):
            for step in map(Step._make, zip(*(piece[c].tolist() for c in STEP_COLUMNS))):
                if start is not None and step.bucket > start:
                    closed.append((start, (step.bucket - start) // self.step, *brought, *figures))
                    n += closed[-1][1]
                    if n >= BATCH_TICKS:
                        yield from self._ticks(key, closed, back)
                        closed, n = [], 0
                bucket = start = step.bucket
                opened = None
                for us, seq, kind, side, price, size in _changes(changes, step.first_change, step.n_changes):
                    if kind == "snapshot" and (us, seq) != opened:
                        opened, sides = (us, seq), {"buy": {}, "sell": {}}
                    fold(sides, [(kind, side, price, size)], self.k)
                impact = 0.0
                if step.trade_count:
                    linked = previous is not None and previous > 0
                    first = previous if linked else step.first_price
                    volume = step.signed - (0.0 if linked else step.first_signed)
                    impact = (step.last_trade - first) / volume if volume else 0.0
                    previous = step.last_trade
                buy, sell = _or(step.buy_volume, 0.0), _or(step.sell_volume, 0.0)
                cvd += buy - sell
                latest = _or(step.last_price, latest)
                ticker = [getattr(step, f"ticker_{c}") for c in TICKER] if step.ticker_there else ticker
                quote = [getattr(step, f"quote_{c}") for c in QUOTE] if step.quote_there else quote
                brought = (_or(step.trade_count, 0), buy, sell, _or(step.vwap, 0.0), step.avg_price, _or(step.ofi, 0.0), impact)
                figures = self._carried(cvd, latest, ticker, quote, sides)
        closed.append((start, 1, *brought, *figures))
        yield from self._ticks(key, closed, back)
        self.state.update((bucket, cvd, previous, latest, ticker, quote, *pack(sides), back.history(bucket + self.step)))

    def columns(self) -> list[str]:
        metrics = [f"{m}_{n}" for n in self.widths for m in METRICS]
        return ["symbol", "ts", "seq", "trade_count_1s", "bid_depth", "ask_depth", *PER_TICK, *metrics]

    def _carried(self, cvd, latest, ticker, quote, sides) -> tuple:
        """What a step shows and hands on to the quiet ones behind it, in the order of CARRIED; no price without a ticker."""
        if ticker is None or not ticker[0] > 0:
            return (np.nan,) * len(CARRIED)
        price = latest if latest is not None and latest > 0 else ticker[0]
        bids, asks = (best_levels(sides[s], s, self.k) for s in ("buy", "sell"))
        bid, ask = (bids[0]["price"], asks[0]["price"]) if bids and asks else quote or (0.0, 0.0)
        mid = (bid + ask) / 2 if bid > 0 and ask > 0 else 0.0
        return (price, *ticker[1:], bid, ask, cvd, _depth(bids, mid, bid=True), _depth(asks, mid, bid=False))

    def _ticks(self, key, stretches: list[tuple], back: LookBack) -> Iterator[pd.DataFrame]:
        """The ticks of stretches, laid out so many at a time."""
        start, length = np.array([x[:2] for x in stretches], dtype="int64").T
        figures = np.array([x[2:] for x in stretches], dtype="float64")
        ends = np.cumsum(length)
        for low in range(0, int(ends[-1]), BATCH_TICKS):
            place = np.arange(low, min(low + BATCH_TICKS, int(ends[-1])))
            of = np.searchsorted(ends, place, "right")
            behind = place - (ends[of] - length[of])
            bucket, rows = start[of] + behind * self.step, figures[of]
            rows[behind > 0, :len(BROUGHT)] = QUIET
            made = dict(zip([*BROUGHT, *CARRIED], rows.T))
            at = bucket + self.step
            shown = ~np.isnan(made["price"])
            metrics = back.add(at, made["price"], *(np.where(shown, made[c], 0.0) for c in ("buy_vol", "sell_vol")))
            made |= dict(zip([f"{m}_{n}" for n in self.widths for m in METRICS], metrics.T))
            made |= {"symbol": key[0], "ts": pd.to_datetime(at, unit="us"), "seq": bucket}
            made["trade_count_1s"] = made["trade_count_1s"].astype("int64")
            yield pd.DataFrame(made, columns=self.columns())[shown]

    def close(self) -> None:
        pass


def streaming_ticks(
    trades: DataFrame, tickers: DataFrame, changes: DataFrame, step: str = "1 second",
    step_us: int = SECOND, widths: dict[str, int] | None = None, lateness: str = "10 seconds",
    k: int = MAX_LEVELS,
) -> DataFrame:
    """The batch tick record from streams. A step is emitted once the watermark has passed it;
    steps without messages are filled in when the next message of the symbol arrives."""
    use_rocksdb(trades.sparkSession)
    spans = {("24h_calculated" if n == "24h" else n): w for n, w in (widths or HORIZONS).items()}
    maker = TickMaker(step_us, spans, k)
    kinds = {"symbol": "string", "ts": "timestamp", "seq": "long", "trade_count_1s": "long"}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in maker.columns())
    made = per_step(combined(trades, tickers, changes), step, lateness).groupBy("symbol")
    rows = made.transformWithStateInPandas(maker, schema, outputMode="append", timeMode="none")
    book = F.struct("bid_depth", "ask_depth").alias("book")
    return finish_ticks(with_depth(rows.select("*", book).drop("bid_depth", "ask_depth"), summed=True))
