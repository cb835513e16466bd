"""What the operators of this folder share: table access, settled tables, Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tapeworks.session import work_folder

BATCH_ROWS = 512
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows: texts may be long, and a batch is held in memory whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and still there when executors are lost."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, make: Callable[..., Iterator[dict]], schema: str, **given) -> DataFrame:
    """``make(batches, **given)`` per partition: lists by column in, dicts of lists by column out."""
    small_batches(df.sparkSession)
    fields = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)
    return df.mapInArrow(functools.partial(_run, make, arrow, given), fields)


_caches: dict[str, Callable[[], None]] = {}


def keep_between_tasks(module: str, forget: Callable[[], None]) -> None:
    """Tell what a module keeps in a Python worker; other modules' tasks make it ``forget`` that.

    Workers serve one stage after the other, and each may need the memory that the last one filled.
    """
    _caches[module] = forget


def _make_room(module: str) -> None:
    for other, forget in _caches.items():
        if other != module:
            forget()
    pa.default_memory_pool().release_unused()


def _run(make, arrow: pa.Schema, given: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _make_room(make.__module__)
    lists = ({n: c for n, c in zip(b.schema.names, b.columns)} for b in batches if b.num_rows)
    for out in make(lists, **given):
        arrays = [_array(out[f.name], f.type) for f in arrow]
        if len(arrays[0]):
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]
