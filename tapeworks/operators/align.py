"""Time alignment: as-of lookups and regular grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.timecols import DAY, SECOND, floor_to, micros
from tapeworks.operators.chunks import ROWS_PER_CHUNK, Chunks, measure
from tapeworks.operators.scan import last_known


# Added to the sequence numbers of left rows, so that they follow all right rows of an instant.
_AFTER = 1 << 62


def as_of(
    left: DataFrame,
    right: DataFrame,
    values: list[str],
    keys: list[str] | None = None,
    rows: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Each left row with ``values`` of the latest right row at or before its ``ts``.

    Both sides carry keys, ts and seq (from 0 up); left rows without a match get nulls. The
    sides are stacked and scanned once, so no pair of rows is ever formed.
    """
    keys = keys or ["symbol"]
    at = micros(F.col("ts")).alias("_us")
    stacked = left.select(
        *keys, at, (F.col("seq") + _AFTER).alias("_order"), F.struct(*left.columns).alias("_row")
    ).unionByName(
        right.select(*keys, at, F.col("seq").alias("_order"), F.struct(*values).alias("_value")),
        allowMissingColumns=True,
    )
    chunks = measure(stacked, keys, seq="_order", rows=rows)
    found = last_known(stacked, chunks, {"_match": F.col("_value")}, inclusive=True)
    return found.filter(F.col("_row").isNotNull()).select(
        "_row.*", *[F.col("_match")[v].alias(v) for v in values]
    )


def grid(feed: DataFrame, step: int = SECOND, keys: list[str] | None = None) -> DataFrame:
    """Every bucket between the first and the last row of a key.

    Starts of days are laid out first and spread over the cluster, then filled, so the long
    grid of one symbol is not generated by one task.
    """
    keys = keys or ["symbol"]
    block = max(step, DAY - DAY % step)
    us = micros(F.col("ts"))
    bounds = feed.groupBy(*keys).agg(
        floor_to(F.min(us), step).alias("_from"), floor_to(F.max(us), step).alias("_to")
    ).filter(F.col("_from").isNotNull())
    blocks = bounds.withColumn(
        "_block", F.explode(F.sequence("_from", "_to", F.lit(block)))
    ).repartition(*keys, "_block")
    last = F.least(F.col("_block") + block - step, F.col("_to"))
    return blocks.select(*keys, F.explode(F.sequence("_block", last, F.lit(step))).alias("bucket"))


def grid_chunks(step: int) -> Chunks:
    """Chunks of a grid need no counting: a bucket is one row."""
    return Chunks(("symbol",), step * min(ROWS_PER_CHUNK, max(1, DAY // step)), "bucket", "bucket")


def on_grid(
    feed: DataFrame,
    per_bucket: DataFrame,
    step: int,
    zero: list[str],
    carry: list[str],
    chunks: Chunks | None = None,
) -> DataFrame:
    """Grid of ``feed`` with ``per_bucket`` figures: ``zero`` columns default to 0, ``carry``
    columns keep their last known value."""
    filled = grid(feed, step).join(per_bucket, ["symbol", "bucket"], "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in zero}
    )
    chunks = chunks or grid_chunks(step)
    return last_known(filled, chunks, {c: F.col(c) for c in carry}, inclusive=True)
