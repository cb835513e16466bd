"""Topics: JSON records in and out, over any streaming source with key and value columns.

On a cluster ``format="kafka"`` with the connector's options; elsewhere a folder of JSON lines
takes the place of a topic, and the same decode applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.sources.decode import parse, split_corrupt


def read_topic(spark: SparkSession, format: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Stream of (topic, value): newest offsets of a topic, or the lines of a folder of files."""
    if format == "kafka":
        defaults = {"startingOffsets": "latest", "failOnDataLoss": "false"}
        reader = spark.readStream.format("kafka").options(**{**defaults, **options})
        return reader.load().select("topic", F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text").options(**options)
    return reader.load(path).withColumn("topic", F.lit(path))


def decoded(stream: DataFrame, schema: T.StructType) -> DataFrame:
    good, _ = split_corrupt(parse(stream, schema))
    return good


def as_records(rows: DataFrame, key: str = "symbol") -> DataFrame:
    """One (key, value) record per row, the value being the whole row as JSON."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    value = F.to_json(F.struct(*rows.columns), options)
    return rows.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def write_topic(rows: DataFrame, checkpoint: str, format: str = "kafka", path: str | None = None,
                key: str = "symbol", available_now: bool = False, **options):
    """Start a query that publishes every row of a stream; returns the query."""
    records = as_records(rows, key)
    if format != "kafka":
        records = records.select("value")
    writer = records.writeStream.format(format).options(**options).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def publish(rows: DataFrame, format: str = "kafka", path: str | None = None, key: str = "symbol", **options) -> None:
    """Batch twin of ``write_topic``."""
    records = as_records(rows, key)
    if format != "kafka":
        records = records.select("value")
    writer = records.write.format(format).options(**options).mode("append")
    writer.save(path) if path else writer.save()
