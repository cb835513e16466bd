"""Feed health: gaps, restarts, component status and alert throttling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.timecols import DAY, SECOND, floor_to, micros
from tapeworks.operators.chunks import Chunks, bounded, measure
from tapeworks.operators.scan import last_known, running
from tapeworks.session import settled

# Limits of the health rules.
STALE_AFTER = 30 * SECOND
CHECK_EVERY = 10 * SECOND
STRIKES = 3
COOLDOWN = 300 * SECOND
LAG_LIMIT = 100
# Component, name of its messages in the log, seconds until it counts as stale.
COMPONENTS = [
    ("Producer", "producer", 30),
    ("Aggregator", "consumer_ticks", 90),
    ("Writer", "consumer_bars", 90),
]


def gaps(
    trades: DataFrame,
    stale_after: int = STALE_AFTER,
    every: int = CHECK_EVERY,
    strikes: int = STRIKES,
    chunks: Chunks | None = None,
) -> DataFrame:
    """Time since the previous trade, and what the health checks in between found.

    Checks run at multiples of ``every``. A check is stale if the last trade is more than
    ``stale_after`` old; the last of ``strikes`` stale checks in a row restarts the feed, after
    which nothing is stale until the next trade. A trade makes the next check fresh, so each
    gap is judged by itself and its checks are counted, not laid out.
    """
    feed = trades.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"])
    linked = last_known(feed, chunks, {"_before": F.col("_us")})
    first = F.col("_before") + stale_after
    first = first - F.pmod(first, F.lit(every)) + every  # first check after the threshold
    found = F.greatest(F.lit(0), F.ceil((F.col("_us") - first) / every))
    return linked.withColumns({
        "gap_us": F.col("_us") - F.col("_before"),
        "stale_checks": F.least(F.lit(strikes), F.coalesce(found, F.lit(0))).cast("long"),
    }).withColumns({
        "restart": F.col("stale_checks") == strikes,
        "restart_us": F.when(F.col("stale_checks") == strikes, first + (strikes - 1) * every),
    }).drop("_us", "_before")


def silence(
    trades: DataFrame, as_of_us: int, stale_after: int = STALE_AFTER, every: int = CHECK_EVERY, strikes: int = STRIKES
) -> DataFrame:
    """Per symbol, what the checks up to ``as_of_us`` found after its last trade.

    ``gaps`` judges gaps that a later trade closes; this one is still open.
    """
    first = F.col("last_us") + stale_after
    first = first - F.pmod(first, F.lit(every)) + every
    found = F.greatest(F.lit(0), F.floor((F.lit(as_of_us) - first) / every) + 1)  # a check at the very instant counts
    last = trades.groupBy("symbol").agg(F.max(micros(F.col("ts"))).alias("last_us")).filter("last_us IS NOT NULL")
    return last.withColumns({
        "gap_us": F.lit(as_of_us) - F.col("last_us"),
        "stale_checks": F.least(F.lit(strikes), found).cast("long"),
    }).withColumns({
        "restart": F.col("stale_checks") == strikes,
        "restart_us": F.when(F.col("stale_checks") == strikes, first + (strikes - 1) * every),
    })


def sessions(trades: DataFrame, chunks: Chunks | None = None, **limits) -> DataFrame:
    """Number the feed sessions: the first trade after a restart opens a new one."""
    feed = trades.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"])
    checked = settled(gaps(trades, chunks=chunks, **limits).withColumn("_us", micros(F.col("ts"))))
    opened = F.col("restart").cast("long")
    return running(checked, chunks, {"feed_session": ("sum", opened)}).drop("_us")


def component_status(
    log: DataFrame, as_of_us: int, components: list[tuple[str, str, int]] | None = None
) -> DataFrame:
    """Status per known component from log(component, ts, is_error), and the overall state.

    ``components`` are (name, name in the log, seconds until stale); the pipeline's own by default.
    """
    known = log.sparkSession.createDataFrame(
        [(name, source, limit) for name, source, limit in components or COMPONENTS],
        "component string, source string, stale_seconds long",
    )
    seen = log.groupBy(F.col("component").alias("source")).agg(
        F.max(F.when(~F.col("is_error"), micros(F.col("ts")))).alias("last_us"),
        F.count(F.when(~F.col("is_error"), 1)).alias("messages"),
        F.count(F.when(F.col("is_error"), 1)).alias("errors"),
    )
    total = seen.agg(F.coalesce(F.sum("errors"), F.lit(0))).scalar()
    age = (F.lit(as_of_us) - F.col("last_us")) / SECOND
    state = known.join(seen, "source", "left").withColumn("age_seconds", age).select(
        "component",
        F.when(F.col("last_us").isNull(), "not started")
        .when(F.col("age_seconds") < F.col("stale_seconds"), "running")
        .otherwise("stale").alias("status"),
        "age_seconds",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("messages", "errors")],
    )
    stale = state.agg(F.max((F.col("status") == "stale").cast("int"))).scalar()
    return state.withColumn("total_errors", total).withColumn(
        "degraded", (F.col("total_errors") > 0) | (stale > 0)
    )


def lag_alerts(lags: DataFrame, limit: int = LAG_LIMIT) -> DataFrame:
    """Readings(topic, lag) above the limit, keyed by topic and hundreds of lag."""
    bucket = F.floor(F.col("lag") / 100).cast("string")
    return lags.filter(F.col("lag") > limit).withColumn(
        "alert_key", F.concat(F.col("topic"), F.lit("_lag_"), bucket)
    )


def _sent(times: np.ndarray, last: int | None, period: int) -> list[int]:
    """Greedy choice: positions of the times at least ``period`` after the one sent before."""
    sent = []
    at = 0 if last is None else int(np.searchsorted(times, last + period, "left"))
    while at < len(times):
        sent.append(at)
        at = int(np.searchsorted(times, times[at] + period, "left"))
    return sent


def _outcomes(times: np.ndarray, period: int) -> list[tuple[int, int]]:
    """(entry, exit): the last time sent in a chunk whose first sent one is at most ``entry``.

    An alert sent before the chunk silences at most its first ``period``, so only entries in
    that stretch can occur. Exits grow with entries; equal ones are listed once.
    """
    after = np.append(np.searchsorted(times, times + period, "left"), len(times))
    entries = np.arange(min(int(after[0]) + 1, len(times)))
    at = entries.copy()
    while True:
        following = after[at]
        if (following >= len(times)).all():
            break
        at = np.where(following < len(times), following, at)
    keep = np.append(at[1:] != at[:-1], True)
    return [(int(times[i]), int(times[j])) for i, j in zip(entries[keep], at[keep])]


def cooldown(
    alerts: DataFrame, key: str = "alert_key", period: int = COOLDOWN, width: int = DAY
) -> DataFrame:
    """Mark the alerts(key, ts, seq) that get through: none within ``period`` of the last sent.

    Which alerts pass depends on all before them. Only the distinct instants of a key matter,
    so copies merge before the shuffle. Stretches of ``width`` first report, in parallel, what
    each way of entering them leads to; those short reports are followed in order per key;
    then all stretches list what they send, in parallel. The rows themselves are only joined.
    """
    width = max(width, 32 * period)
    feed = alerts.withColumn("_us", micros(F.col("ts")))
    instants = feed.groupBy(key, "_us").agg(F.min("seq").alias("_seq"))
    instants = instants.withColumn("_chunk", floor_to(F.col("_us"), width))
    kind = alerts.schema[key].dataType.simpleString()

    def report(ids: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = _outcomes(np.sort(pdf["_us"].to_numpy()), period)
        return pd.DataFrame([(*ids, i, o) for i, o in found], columns=[key, "_chunk", "entry", "exit"])

    def follow(ids: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows, last = [], None
        for chunk, part in pdf.sort_values(["_chunk", "entry"]).groupby("_chunk", sort=False):
            rows.append((ids[0], chunk, last))
            at = 0 if last is None else int(np.searchsorted(part["entry"].to_numpy(), last + period, "left"))
            if at < len(part):
                last = int(part["exit"].iloc[at])
        return pd.DataFrame(rows, columns=[key, "_chunk", "last"]).astype({"last": "Int64"})

    def send(ids: tuple, pdf: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        last = entered["last"].iloc[0]
        pdf = pdf.sort_values("_us").reset_index(drop=True)
        return pdf.iloc[_sent(pdf["_us"].to_numpy(), None if pd.isna(last) else int(last), period)][[key, "_us", "_seq"]]

    groups = [key, "_chunk"]
    reports = instants.select(*groups, "_us").groupBy(*groups).applyInPandas(
        report, f"`{key}` {kind}, _chunk long, entry long, exit long"
    )
    incoming = reports.groupBy(key).applyInPandas(follow, f"`{key}` {kind}, _chunk long, last long")
    sent = instants.groupBy(*groups).cogroup(incoming.groupBy(*groups)).applyInPandas(
        send, f"`{key}` {kind}, _us long, _seq long"
    )
    sent, _ = bounded(settled(sent.select(key, "_us", F.col("_seq").alias("seq"), F.lit(True).alias("sent"))))
    marked = feed.join(sent, [key, "_us", "seq"], "left")
    return marked.select(*alerts.columns, F.coalesce("sent", F.lit(False)).alias("sent"))
