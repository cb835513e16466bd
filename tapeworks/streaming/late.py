"""Bars from a feed whose late ticks are kept, and repair the bars they belong to.

Spark's watermark refuses rows behind it and only counts them. Here each micro-batch first adds what it brings to
partial bars at rest, which merge whichever way the ticks were dealt to batches; then the bars that the mark has passed
are written, and those already written that a late tick touches are written anew. Below one folder:

    partials/hour=H/batch=N   per symbol and ``sub_us``: sums, extremes and the positive prices
    late/batch=N              the late ticks of a batch as they came, with ``repaired``
    marks/batch=N             the instant up to which bars are closed after the batch
    bars                      the bar table, in hour folders
    checkpoint                of the query
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.functions.timecols import EASTERN, HOUR, MINUTE, SECOND, floor_to, micros
from tapeworks.session import store
from tapeworks.sources.tables import merge_bars
from tapeworks.streaming.bars import close_bars, grouped_pieces, merged_sums, with_moments

BEFORE_ALL = -(1 << 62)


def partials(ticks: DataFrame, sub_us: int = SECOND) -> DataFrame:
    """Per symbol and ``sub_us`` microseconds (column _at): a summary that ``merge_partials`` can join to others."""
    return grouped_pieces(ticks.filter(F.col("ts").isNotNull()), floor_to(micros(F.col("ts")), sub_us).alias("_at"))


def merge_partials(stored: DataFrame) -> DataFrame:
    """One summary per symbol and _at; the prices of all meet in one order, so returns are those of all ticks."""
    points = F.array_sort(F.flatten(F.collect_list("_points")))
    return stored.groupBy("symbol", "_at").agg(points.alias("_points"), *merged_sums())


def bars_from(stored: DataFrame, width_us: int = MINUTE, zone: str = EASTERN) -> DataFrame:
    """The bar record from stored partials, equal to ``operators.bars.bars`` of the ticks behind them."""
    pieces = with_moments(merge_partials(stored))
    return close_bars(pieces, F.col("_at"), floor_to(F.col("_at"), width_us), F.col("_bar_key"), width_us, zone)


def late_ticks(spark: SparkSession, root: str) -> DataFrame | None:
    """The ticks that came after their bar was closed, with batch and repaired; None before the first one."""
    files, where = store(spark, f"{root}/late")
    return spark.read.parquet(f"{root}/late") if files.exists(where) else None


def _hours(spark: SparkSession, root: str) -> list[int]:
    """The hour folders of the partials; one listing of their parent."""
    files, where = store(spark, f"{root}/partials")
    if not files.exists(where):
        return []
    names = (status.getPath().getName() for status in files.listStatus(where))
    return sorted(int(n.removeprefix("hour=")) for n in names if n.startswith("hour="))


def _mark(spark: SparkSession, root: str, batch: int) -> int:
    return BEFORE_ALL if batch < 0 else spark.read.parquet(f"{root}/marks/batch={batch}").first()[0]


def repairing_bars(
    ticks: DataFrame,
    root: str,
    width_us: int = MINUTE,
    sub_us: int = SECOND,
    lateness_us: int = 5 * MINUTE,
    keep_us: int | None = 24 * HOUR + 30 * MINUTE,
    zone: str = EASTERN,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the bars of a tick stream below ``root``, late ticks included.

    A bar is written once the mark, ``lateness_us`` behind the newest tick of the batches so far, has passed its end. A
    tick that comes later is kept in the side table; if its hour is still held (``keep_us`` behind the mark; None: for
    good) it also enters the partials and its bar is written again, else ``repaired`` is false and the bar stays. Ticks
    without a time belong to no bar. Only hours with bars to write are read, only their folders of the bar table change.

    A batch that runs again replaces its own folders and writes the same bars: whatever it decides follows from the mark
    of the batch before, and partials are dropped by that mark too. One ``root`` belongs to one query.
    """
    if width_us % sub_us:
        raise ValueError("a bar must hold whole pieces")
    unit = max(width_us, HOUR)

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _mark(spark, root, number - 1)
        us = micros(F.col("ts"))
        bar = floor_to(us, width_us)
        late = bar + width_us <= before
        held = F.lit(True) if keep_us is None else floor_to(bar, unit) + unit > before - keep_us
        newest, found = batch.agg(F.max(us), F.count(F.when(late, 1))).first()
        mark = before if newest is None else max(before, newest - lateness_us)
        if found:
            batch.filter(late).withColumn("repaired", held).write.mode("overwrite").parquet(f"{root}/late/batch={number}")
        if newest is not None:
            at_hour = floor_to(floor_to(F.col("_at"), width_us), unit)
            (
                partials(batch.filter(held), sub_us).withColumns({"hour": at_hour, "batch": F.lit(number)})
                .hint("rebalance", "hour").sortWithinPartitions("hour", "_at", "symbol")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("hour", "batch").parquet(f"{root}/partials")
            )
            write_closed(spark, number, before, mark, bool(found))
        spark.createDataFrame([(mark,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch={number}")
        forget(spark, number, before)

    def write_closed(spark: SparkSession, number: int, before: int, mark: int, repair: bool) -> None:
        closing = [h for h in _hours(spark, root) if h + unit > before and h + width_us <= mark]
        closed_at = floor_to(F.col("_at"), width_us) + width_us
        due = None
        if closing:
            due = read(spark, closing).filter((closed_at > before) & (closed_at <= mark))
        if repair:
            keys = ["symbol", "_bar"]
            new = read(spark, _hours(spark, root)).filter((F.col("batch") == number) & (closed_at <= before))
            touched = [r[0] for r in new.select("hour").distinct().collect()]  # at most the hours held
            if touched:
                old = read(spark, touched).withColumn("_bar", closed_at)
                again = old.join(new.withColumn("_bar", closed_at).select(*keys).distinct(), keys, "left_semi").drop("_bar")
                again = again.filter(closed_at <= before)
                due = again if due is None else due.unionByName(again)
        if due is not None:
            merge_bars(spark, f"{root}/bars", bars_from(due, width_us, zone))

    def read(spark: SparkSession, hours: list[int]) -> DataFrame:
        return spark.read.option("basePath", f"{root}/partials").parquet(*[f"{root}/partials/hour={h}" for h in hours])

    def forget(spark: SparkSession, number: int, before: int) -> None:
        if keep_us is not None:
            for hour in _hours(spark, root):
                if hour + unit <= before - keep_us:
                    files, where = store(spark, f"{root}/partials/hour={hour}")
                    files.delete(where, True)
        files, where = store(spark, f"{root}/marks/batch={number - 2}")
        files.delete(where, True)

    writer = ticks.writeStream.foreachBatch(add).option("checkpointLocation", f"{root}/checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
