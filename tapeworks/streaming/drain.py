"""Running a stream over everything available now, into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeworks.session import work_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs this provider; it also keeps large state off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def drain(stream: DataFrame, folder: str | None = None, mode: str = "append"):
    """Process what is there, write Parquet, and return (table, finished query)."""
    spark = stream.sparkSession
    folder = folder or work_folder(spark, "stream")
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows"), query


def dropped_late(query) -> int:
    """Rows the watermark refused, from the progress reports of a query.

    Counts rows as the stateful operator saw them, after partial aggregation.
    """
    return sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
