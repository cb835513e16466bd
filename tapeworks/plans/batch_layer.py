"""The batch layer: landed raw messages to validated bars on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.operators.bars import bars
from tapeworks.sources import decode
from tapeworks.sources.tables import validate, write_span


def ticker_bars(raw: DataFrame) -> DataFrame:
    """Minute bars from the ticker messages of a raw feed (column ``value``)."""
    return bars(decode.ticker_ticks(decode.messages(raw)))


def run(raw: DataFrame, root: str) -> DataFrame:
    """Build, write and check; raises if an hour folder has no readable, non-empty file."""
    made = ticker_bars(raw)
    if not write_span(made, root):
        raise ValueError("no bars to write")
    status = validate(raw.sparkSession, root, made)
    bad = status.filter(F.col("status") != "ok").limit(1).collect()
    if bad:
        raise ValueError(f"output folder not as expected: {bad[0].asDict()}")
    return status
