"""Alerts on streams: stale components, cooldown, lag, duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tapeworks.functions.timecols import micros
from tapeworks.operators.health import CHECK_EVERY, COOLDOWN, STALE_AFTER, STRIKES, lag_alerts
from tapeworks.operators.quality import content_hash
from tapeworks.streaming.drain import use_rocksdb

COLUMNS = ["component", "last_ms", "check_ms", "strike", "restart"]
STALE_OUT = "component string, last_ms long, check_ms long, strike int, restart boolean"


class StaleWatch(StatefulProcessor):
    """Checks a component at fixed instants of event time; reports each stale check.

    The timer of the next possible stale check is set when messages arrive. It fires once the
    watermark has passed it without news, and sets the following one until the strikes are up.
    """

    def __init__(self, stale_ms: int, every_ms: int, strikes: int):
        self.stale_ms, self.every_ms, self.strikes = stale_ms, every_ms, strikes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_ms long, strike int")

    def _first_check(self, last_ms: int) -> int:
        limit = last_ms + self.stale_ms
        return limit - limit % self.every_ms + self.every_ms

    def _report(self, key, last_ms: int, check_ms: int, strike: int) -> tuple:
        return (key[0], last_ms, check_ms, strike, strike == self.strikes)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = sorted(t for pdf in rows for t in (pdf["us"] // 1000).tolist())
        last, strike = self.seen.get() or (None, 0)
        out = []
        for now in times:
            if last is not None and now > last:
                # checks between two messages of one batch are due before the later one
                check = self._first_check(last) + strike * self.every_ms
                while strike < self.strikes and check < now:
                    strike += 1
                    out.append(self._report(key, last, check, strike))
                    check += self.every_ms
            if last is None or now > last:
                last, strike = now, 0
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.seen.update((last, strike))
        self.handle.registerTimer(self._first_check(last))
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, strike = self.seen.get()
        check, now, out = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs(), []
        while strike < self.strikes and check <= now:
            strike += 1
            out.append(self._report(key, last, check, strike))
            check += self.every_ms
        self.seen.update((last, strike))
        if strike < self.strikes:
            self.handle.registerTimer(check)
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def stale_checks(
    messages: DataFrame, lateness: str = "0 seconds", stale_after: int = STALE_AFTER,
    every: int = CHECK_EVERY, strikes: int = STRIKES,
) -> DataFrame:
    """Stale checks per component from a stream messages(component, ts)."""
    use_rocksdb(messages.sparkSession)
    feed = messages.withWatermark("ts", lateness).select(
        "component", "ts", micros(F.col("ts")).alias("us")
    )
    watch = StaleWatch(stale_after // 1000, every // 1000, strikes)
    return feed.groupBy("component").transformWithStateInPandas(
        watch, STALE_OUT, outputMode="append", timeMode="eventTime"
    )


def streaming_cooldown(alerts: DataFrame, period: int = COOLDOWN, lateness: str = "10 minutes") -> DataFrame:
    """Alerts(alert_key, ts, seq) that get through: none within ``period`` of the last one sent.

    A key is forgotten once the watermark has passed its silence: nothing would be held back.
    """

    def pick(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        pdf = pd.concat(list(batches)).sort_values(["us", "seq"], kind="stable")
        sent = []
        for at, us in enumerate(pdf["us"].tolist()):
            if last is None or us - last >= period:
                last = us
                sent.append(at)
        if last is not None:
            state.update((int(last),))
            state.setTimeoutTimestamp(max((last + period) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pdf.iloc[sent].assign(alert_key=key[0])[["alert_key", "us", "seq"]]

    slim = alerts.withWatermark("ts", lateness).select("alert_key", "ts", micros(F.col("ts")).alias("us"), "seq")
    return slim.groupBy("alert_key").applyInPandasWithState(
        pick, "alert_key string, us long, seq long", "last long", "append", GroupStateTimeout.EventTimeTimeout
    )


def streaming_lag_alerts(lags: DataFrame, period: int = COOLDOWN) -> DataFrame:
    """Throttled lag alerts from a stream of readings(topic, lag, ts, seq)."""
    return streaming_cooldown(lag_alerts(lags), period)


def streaming_dedupe(messages: DataFrame, columns: list[str], lateness: str = "5 minutes") -> DataFrame:
    """First copy of each message; copies are recognised by content within ``lateness``."""
    marked = messages.withColumn("_content", content_hash(columns))
    return (
        marked.withWatermark("ts", lateness)
        .dropDuplicatesWithinWatermark(["symbol", "ts", "_content"])
        .drop("_content")
    )
