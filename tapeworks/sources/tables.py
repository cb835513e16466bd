"""The bar table at rest: Parquet in hour folders named in Eastern time."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from typing import NamedTuple
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.timecols import EASTERN, folder_keys
from tapeworks.operators.sets import keep_last, union_bars
from tapeworks.schemas import BAR_SCHEMA
from tapeworks.session import settled, store

FOLDERS = ["year", "month", "day", "hour"]
# Limits of the serving reads.
FULL_HOURS, LOOK_BACK = 24, timedelta(minutes=5)
FULL_FILES, INCREMENTAL_FILES = 1500, 100
# Up to this many hour folders (three years) are named in a predicate; more are joined.
LISTED_FOLDERS = 26_000


def with_folders(bars: DataFrame, zone: str = EASTERN) -> DataFrame:
    """Folder keys of the bar's own window, not of the time of writing."""
    return bars.withColumns(folder_keys(F.timestamp_millis("window_start"), zone))


def write_bars(bars: DataFrame, root: str, mode: str = "append") -> None:
    """Write into hour folders; rows of an hour meet in one task, or several if they are many.

    ``mode="overwrite"`` replaces only the folders that receive rows. The rebalance lets
    adaptive execution merge short hours and split long ones by their size.
    """
    (
        with_folders(bars).hint("rebalance", *FOLDERS)
        .sortWithinPartitions(*FOLDERS, "window_start", "symbol")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*FOLDERS)
        .parquet(root)
    )


def write_span(bars: DataFrame, root: str) -> bool:
    """Batch sink: one append per collected span; nothing is written for an empty one."""
    made = settled(bars)  # asked twice, computed once
    if made.isEmpty():
        return False
    write_bars(made, root)
    return True


def stream_bars(bars: DataFrame, root: str, checkpoint: str, available_now: bool = False):
    """Streaming sink into the same layout; returns the query."""
    writer = (
        with_folders(bars).writeStream.format("parquet").outputMode("append")
        .option("compression", "snappy").option("checkpointLocation", checkpoint)
        .partitionBy(*FOLDERS)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(root)


def _schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(k, T.StringType()) for k in FOLDERS]])


def bar_table(
    spark: SparkSession, root: str, schema: T.StructType = BAR_SCHEMA, skip_damaged: bool = False, paths: list[str] | None = None
) -> DataFrame:
    """The table under ``root``, or some of its files.

    A file that cannot be read fails the query. Only reads that serve rows and never write
    them back may ask for such files to contribute nothing instead.
    """
    reader = spark.read.schema(_schema(schema)).option("ignoreCorruptFiles", str(skip_damaged).lower())
    return reader.option("basePath", root).parquet(*(paths or [root]))


class StoredFile(NamedTuple):
    written_ms: int
    path: str
    size: int


def list_files(spark: SparkSession, folder: str) -> Iterator[StoredFile]:
    """Data files below ``folder``, empty ones included; none if it does not exist.

    Spark's own listing leaves empty files out.
    """
    files, where = store(spark, folder)
    if not files.exists(where):
        return
    listed = files.listFiles(where, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            yield StoredFile(status.getModificationTime(), status.getPath().toString(), status.getLen())


def newest(files: Iterator[StoredFile], n: int) -> list[str]:
    """Paths of the ``n`` files written last; of the same time, the greater name."""
    return [f.path for f in heapq.nlargest(n, files)]


def folder_path(root: str, folder: str) -> str:
    """Path of an hour folder from its joined key."""
    parts = (folder[:4], folder[4:6], folder[6:8], folder[8:])
    return "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in zip(FOLDERS, parts))])


def _folder(instant: datetime, zone: str = EASTERN) -> str:
    return instant.astimezone(ZoneInfo(zone)).strftime("%Y%m%d%H")


def in_hours(low: datetime, high: datetime, zone: str = EASTERN) -> Column:
    """Predicate on folder keys only, for the hours that cover [low, high].

    Comparing the joined keys prunes any range without listing its hours. Local hours repeat
    or skip when clocks change, hence one hour of slack at both ends.
    """
    hour = timedelta(hours=1)
    joined = F.concat(*FOLDERS)
    return joined.between(_folder(low - hour, zone), _folder(high + hour, zone))


def _ms(instant: datetime) -> int:
    return int(instant.astimezone(timezone.utc).timestamp() * 1000)


def hours_between(low: datetime, high: datetime, zone: str = EASTERN) -> list[str]:
    """Joined folder keys of the hours that cover [low, high], with the slack of ``in_hours``."""
    first = low.astimezone(timezone.utc).replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)
    count = max(0, int((high + timedelta(hours=1) - first) / timedelta(hours=1)) + 1)
    return sorted({_folder(first + timedelta(hours=h), zone) for h in range(count)})


def _newest_of(spark: SparkSession, root: str, folders: list[str], n: int | None, since_ms: int = 0) -> DataFrame:
    """Rows of files in the folders, of the ``n`` written last if given; no other file is opened."""
    table = bar_table(spark, root, skip_damaged=True)
    if n is None:
        return table.filter(F.concat(*FOLDERS).isin(folders))
    found = (f for folder in folders for f in list_files(spark, folder_path(root, folder)) if f.written_ms >= since_ms and f.size)
    paths = newest(found, n)
    return bar_table(spark, root, skip_damaged=True, paths=paths) if paths else table.limit(0)


def read_span(spark: SparkSession, root: str, low: datetime, high: datetime) -> DataFrame:
    """Bars with a window start in [low, high]: folders pruned first, then row groups."""
    start = F.col("window_start")
    return (
        bar_table(spark, root, skip_damaged=True)
        .filter(in_hours(low, high) & start.between(_ms(low), _ms(high)))
        .drop(*FOLDERS)
    )


def read_full(
    spark: SparkSession, root: str, now: datetime, hours: int = FULL_HOURS, files: int | None = None
) -> DataFrame:
    """The folders of the last ``hours`` hours up to now, the current one included.

    Everything in them, or the ``files`` written last.
    """
    folders = [_folder(now - timedelta(hours=h)) for h in range(hours + 1)]
    return _newest_of(spark, root, folders, files).drop(*FOLDERS)


def read_incremental(
    spark: SparkSession, root: str, now: datetime, since: datetime, look_back: timedelta = LOOK_BACK, files: int | None = None
) -> DataFrame:
    """Rows of files written at or after ``since`` - ``look_back``, in every hour from then to now.

    Of all such files, or of the ``files`` written last. The hours are those of the bars' own
    windows; a longer look-back also finds what came late.
    """
    low = since - look_back
    if files is not None:
        return _newest_of(spark, root, hours_between(low, now), files, _ms(low)).drop(*FOLDERS)
    recent = F.col("_metadata.file_modification_time") >= F.lit(low.astimezone(timezone.utc))
    return bar_table(spark, root, skip_damaged=True).filter(in_hours(low, now) & recent).drop(*FOLDERS)


def read_newest(spark: SparkSession, root: str, n: int = INCREMENTAL_FILES) -> DataFrame:
    """Rows of the ``n`` files written last (a full load takes ``FULL_FILES``); no other is opened."""
    paths = newest((f for f in list_files(spark, root) if f.size), n)
    if not paths:
        return spark.createDataFrame([], BAR_SCHEMA)
    return bar_table(spark, root, skip_damaged=True, paths=paths).drop(*FOLDERS)


def file_report(spark: SparkSession, root: str) -> DataFrame:
    """Per hour folder with readable rows: files, rows, and the size of the last file by name."""
    return (
        bar_table(spark, root, skip_damaged=True)
        .select(*FOLDERS, "_metadata.file_name", "_metadata.file_size")
        .groupBy(*FOLDERS)
        .agg(
            F.countDistinct("file_name").alias("files"),
            F.count(F.lit(1)).alias("rows"),
            F.max_by("file_size", "file_name").alias("newest_size"),
        )
    )


def validate(spark: SparkSession, root: str, written: DataFrame) -> DataFrame:
    """Status of every hour folder that ``written`` bars belong to: ok, empty or missing.

    Files are listed, so that a folder with nothing but an empty file, or whose newest file
    is empty, is seen; rows are counted from what can be read.
    """
    expected = with_folders(written).select(F.concat(*FOLDERS)).distinct().limit(LISTED_FOLDERS + 1).collect()
    if len(expected) > LISTED_FOLDERS:
        raise ValueError("validate a shorter span: more hour folders than can be listed")
    rows = []
    for (folder,) in expected:
        found = sorted(list_files(spark, folder_path(root, folder)))
        status = "missing" if not found else "empty" if not found[-1].size else "ok"
        rows.append((folder[:4], folder[4:6], folder[6:8], folder[8:], len(found), found[-1].size if found else None, status))
    kinds = ", ".join(f"{k} string" for k in FOLDERS)
    told = spark.createDataFrame(rows, f"{kinds}, files long, newest_size long, status string")
    if all(r[-1] == "missing" for r in rows):
        return told.withColumn("rows", F.lit(0).cast("long"))
    listed = bar_table(spark, root, skip_damaged=True).filter(F.concat(*FOLDERS).isin([f for (f,) in expected]))
    counts = listed.groupBy(*FOLDERS).agg(F.count(F.lit(1)).alias("rows"))
    return told.join(counts, FOLDERS, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def merge_bars(spark: SparkSession, root: str, new: DataFrame) -> None:
    """Upsert into the table: only folders that receive rows are read and rewritten.

    New rows win. The merge is settled before folders are replaced, so a lost executor
    cannot make a retry read what it is overwriting. A stored file that cannot be read fails
    the merge before anything is replaced.
    """
    made = settled(new)
    if next(list_files(spark, root), None) is None:  # nothing written yet
        write_bars(keep_last(made, ["last_ingestion_time"]), root, "overwrite")
        return
    fresh = with_folders(made).withColumn("_priority", F.lit(1))
    table = bar_table(spark, root)
    touched = fresh.select(F.concat(*FOLDERS).alias("_folder")).distinct()
    listed = [r[0] for r in touched.limit(LISTED_FOLDERS + 1).collect()]
    if len(listed) <= LISTED_FOLDERS:  # known when the files are listed: nothing else is opened
        old = table.filter(F.concat(*FOLDERS).isin(listed))
    else:
        old = table.withColumn("_folder", F.concat(*FOLDERS)).join(touched, "_folder", "left_semi").drop("_folder")
    old = old.withColumn("_priority", F.lit(0))
    merged = keep_last(union_bars(old, fresh), ["_priority", "last_ingestion_time"])
    write_bars(settled(merged.drop("_priority", *FOLDERS)), root, "overwrite")


def expire(spark: SparkSession, root: str, as_of: datetime, keep: timedelta = timedelta(minutes=24 * 60 + 30)) -> int:
    """Retention at rest: delete the hour folders that end before ``as_of`` - ``keep``; returns how many.

    Folders are dropped whole, so bars stay up to an hour longer than the span.
    """
    last = _folder(as_of - keep - timedelta(hours=1))
    files, where = store(spark, root)
    if not files.exists(where):
        return 0
    pattern = store(spark, "/".join([root.rstrip("/"), *(f"{k}=*" for k in FOLDERS)]))[1]
    gone = 0
    for status in files.globStatus(pattern):
        keys = status.getPath().toString().rsplit("/", len(FOLDERS))[1:]
        if "".join(k.partition("=")[2] for k in keys) < last:
            gone += files.delete(status.getPath(), True)
    return gone


def compact(spark: SparkSession, root: str, low: datetime, high: datetime) -> None:
    """Rewrite the hour folders of [low, high] into one file each; fails if a file cannot be read."""
    rows = bar_table(spark, root).filter(in_hours(low, high)).drop(*FOLDERS)
    write_bars(settled(rows), root, "overwrite")
