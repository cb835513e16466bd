"""Keyed running state: volume delta and previous price that outlive a micro-batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tapeworks.functions.timecols import micros
from tapeworks.operators.health import CHECK_EVERY, STALE_AFTER, STRIKES
from tapeworks.streaming.drain import use_rocksdb
from tapeworks.streaming.packed import PIECE_ROWS, gather, pieces

OUT = "symbol string, us long, seq long, price double, previous_price double, cvd double, feed_session long"
WAITING = "us long, seq long, price double, size double, side string"
HELD = [c.strip().split()[0] for c in WAITING.split(",")]
STATE = "cvd double, previous_price double, last_us long, feed_session long"


def restarts(us: np.ndarray, before: int | None) -> np.ndarray:
    """Which trades follow a restart: the health checks in the gap before them struck out.

    ``before`` is the time of the trade before the first, None if there is none.
    """
    earlier = np.append([us[0] if before is None else before], us[:-1])
    first = earlier + STALE_AFTER
    first = first - first % CHECK_EVERY + CHECK_EVERY
    return -(-(us - first) // CHECK_EVERY) >= STRIKES


NOTHING = (0.0, None, None, 0)


def _run(symbol: str, rows: dict[str, np.ndarray], before: tuple, sessions: bool) -> tuple[tuple, pd.DataFrame]:
    """The state after the trades of ``rows``, in order and following those ``before`` tells of, and their rows."""
    cvd, previous, last_us, session = before
    us, price, size = rows["us"], rows["price"], np.where(np.isnan(rows["size"]), 0.0, rows["size"])
    opens = restarts(us, last_us) if sessions else np.zeros(len(us), bool)
    moved = np.cumsum(np.where(rows["buys"], size, -size))
    number = np.cumsum(opens)
    at = np.flatnonzero(opens)  # a session starts from nothing
    base = np.append([-cvd], np.where(at > 0, moved[at - 1], 0.0))
    totals = moved - base[number]
    # a missing size moves nothing, and the price before is the last one known
    known = pd.Series(np.append([np.nan if previous is None else previous], price)).ffill().to_numpy()
    before, last = known[:-1], known[-1]
    after = (float(totals[-1]), None if np.isnan(last) else float(last), int(us[-1]), int(session + number[-1]))
    # a missing price is NaN here, which Spark takes for null
    return after, pd.DataFrame({
        "symbol": symbol, "us": us, "seq": rows["seq"], "price": price, "previous_price": before,
        "cvd": totals, "feed_session": session + number,
    })


def _numbers(frames: Iterable[pd.DataFrame]) -> dict[str, np.ndarray]:
    """The trades of all frames as columns of numbers."""
    return gather((pd.DataFrame({
        "us": pdf["us"], "seq": pdf["seq"], "price": pdf["price"].astype(float), "size": pdf["size"].astype(float),
        "buys": (pdf["side"] == "buy").astype(bool),
    }) for pdf in frames), ["us", "seq", "price", "size", "buys"])


def _follow(key, batches: Iterator[pd.DataFrame], state: GroupState, sessions: bool) -> Iterator[pd.DataFrame]:
    held, before = _numbers(batches), state.get if state.exists else NOTHING
    for piece in pieces(held, np.lexsort((held["seq"], held["us"]))):
        before, rows = _run(key[0], piece, before, sessions)
        yield rows
    state.update(before)


def streaming_trades(trades: DataFrame, sessions: bool = False) -> DataFrame:
    """Each trade with the price before it and the volume delta so far, in event-time order
    within a micro-batch.

    With ``sessions`` the delta starts again with each feed session, as ``health.sessions`` numbers them.
    """
    slim = trades.select("symbol", micros(F.col("ts")).alias("us"), "seq", "price", "size", "side")
    return slim.groupBy("symbol").applyInPandasWithState(
        partial(_follow, sessions=sessions), OUT, STATE, "append", GroupStateTimeout.NoTimeout
    )


class TradesInOrder(StatefulProcessor):
    """Holds trades back until the watermark has passed them, then follows them in the order of their times.

    A timer per symbol stands at its first trade held back, so that a symbol is released though it has no more messages.
    With ``forget_ms`` a symbol starts from nothing after a longer silence, however the batches fall, and its state
    goes when the watermark is so long past its last trade.
    """

    def __init__(self, sessions: bool, forget_ms: int | None):
        self.sessions, self.forget_ms = sessions, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.running = handle.getValueState("running", STATE)
        self.waiting = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._release(key, rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, None, timerValues)

    def _waiting(self) -> Iterator[pd.DataFrame]:
        """The trades held back, so many at a time."""
        rows = iter(self.waiting.get())
        while some := list(islice(rows, PIECE_ROWS)):
            yield pd.DataFrame(some, columns=HELD)

    def _release(self, key, new: Iterator[pd.DataFrame] | None, timers) -> Iterator[pd.DataFrame]:
        mark = timers.getCurrentWatermarkInMs() * 1000
        held = _numbers(chain(self._waiting(), new or ()))
        ready = held["us"] < mark
        before = (self.running.get() if self.running.exists() else None) or NOTHING
        if ready.any():
            passed = np.flatnonzero(ready)
            order = passed[np.lexsort((held["seq"][passed], held["us"][passed]))]
            for piece in pieces(held, order):
                us = piece["us"]
                fresh = np.zeros(len(us), bool)
                if self.forget_ms is not None:
                    fresh = np.diff(us, prepend=us[0] if before[2] is None else before[2]) > self.forget_ms * 1000
                starts = np.unique(np.append([0], np.flatnonzero(fresh)))
                for start, end in zip(starts, np.append(starts[1:], len(us))):
                    part = {c: values[start:end] for c, values in piece.items()}
                    before, out = _run(key[0], part, NOTHING if fresh[start] else before, self.sessions)
                    yield out
            self.running.update(before)
        waiting = np.flatnonzero(~ready)
        if new is not None or ready.any():
            self._keep(held, waiting)
        last = before[2]
        if len(waiting):
            self.handle.registerTimer(int(held["us"][waiting].min()) // 1000 + 1)
        elif self.forget_ms is not None and last is not None:
            if last + self.forget_ms * 1000 < mark:
                self.running.clear()
            else:
                self.handle.registerTimer(last // 1000 + self.forget_ms + 1)

    def _keep(self, held: dict[str, np.ndarray], waiting: np.ndarray) -> None:
        self.waiting.clear()
        for piece in pieces(held, waiting):
            self.waiting.appendList([
                (int(us), int(seq), None if price != price else price, None if size != size else size, "buy" if buys else "sell")
                for us, seq, price, size, buys in zip(*(values.tolist() for values in piece.values()))
            ])

    def close(self) -> None:
        pass


def ordered_trades(trades: DataFrame, lateness: str = "5 minutes", sessions: bool = False, forget_ms: int | None = None) -> DataFrame:
    """``streaming_trades`` in event-time order over all micro-batches, equal to the batch form.

    A trade comes out once the watermark, ``lateness`` behind the newest trade, has passed it; trades behind the
    watermark when they arrive are refused, and the query's progress counts them. Trades without a time never come out.
    State holds the trades of one lateness per symbol, and four numbers; with ``forget_ms`` a symbol without trades for
    longer is forgotten and starts from nothing when it comes back.
    """
    use_rocksdb(trades.sparkSession)
    slim = trades.filter("ts IS NOT NULL").withWatermark("ts", lateness).select("symbol", "ts", micros(F.col("ts")).alias("us"), "seq", "price", "size", "side")
    return slim.groupBy("symbol").transformWithStateInPandas(
        TradesInOrder(sessions, forget_ms), OUT, outputMode="append", timeMode="eventTime"
    )
