"""Bars merged into the table at rest as they arrive."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.sources.tables import expire, merge_bars


def upsert_stream(
    bars: DataFrame, root: str, checkpoint: str, keep: timedelta | None = None, available_now: bool = False
) -> StreamingQuery:
    """Merge each micro-batch into the hour folders it touches; new rows win on equal keys.

    A batch that is run again changes nothing. With ``keep``, hours older than that before the
    newest bar of a batch are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        newest = batch.agg(F.max("window_start")).first()[0]
        if newest is None:
            return
        merge_bars(batch.sparkSession, root, batch)
        if keep is not None:
            expire(batch.sparkSession, root, datetime.fromtimestamp(newest / 1000, timezone.utc), keep)

    writer = bars.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
