"""Unions, de-duplication, merging and reconciliation of bar tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.operators.chunks import bounded
from tapeworks.session import settled

KEY = ["symbol", "window_start"]
RETENTION_MS = (24 * 60 + 30) * 60_000
HOUR_MS = 3_600_000


def union_bars(*tables: DataFrame) -> DataFrame:
    """Stack by column name; columns one side lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def keep_last(table: DataFrame, order: list[str], key: list[str] | None = None) -> DataFrame:
    """One row per key, the greatest by ``order``. The rank limit also runs before the shuffle."""
    newest = W.partitionBy(*(key or KEY)).orderBy(*[F.desc_nulls_last(c) for c in order])
    return table.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def retain(table: DataFrame, as_of_ms: Column, keep_ms: int = RETENTION_MS) -> DataFrame:
    return table.filter(F.col("window_start") >= as_of_ms - keep_ms)


def upsert(
    current: DataFrame, new: DataFrame, as_of_ms: Column | None = None, key: list[str] | None = None
) -> DataFrame:
    """``current`` with ``new`` merged in: new rows win on equal keys; then retention if asked."""
    stacked = union_bars(
        current.withColumn("_priority", F.lit(0)), new.withColumn("_priority", F.lit(1))
    )
    merged = keep_last(stacked, ["_priority", "last_ingestion_time"], key).drop("_priority")
    return merged if as_of_ms is None else retain(merged, as_of_ms)


def reconcile(
    left: DataFrame, right: DataFrame, columns: list[str], eps: float = 1e-9,
    key: list[str] | None = None,
) -> DataFrame:
    """Keys on one side only and differences per column between two bar tables."""
    key = key or KEY
    a = left.select(*key, F.lit(True).alias("_l"), *[F.col(c).alias(f"l_{c}") for c in columns])
    b = right.select(*key, F.lit(True).alias("_r"), *[F.col(c).alias(f"r_{c}") for c in columns])
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()

    def differs(c: str) -> Column:
        x, y = F.col(f"l_{c}"), F.col(f"r_{c}")
        return both & F.coalesce(F.abs(x - y) > eps, x.isNull() != y.isNull())

    counts = a.join(b, key, "full_outer").agg(
        F.count(F.when(both, 1)).alias("in_both"),
        F.count(F.when(F.col("_r").isNull(), 1)).alias("left_only"),
        F.count(F.when(F.col("_l").isNull(), 1)).alias("right_only"),
        *[F.count(F.when(differs(c), 1)).alias(f"diff_{c}") for c in columns],
    )
    return counts


def digests(table: DataFrame, columns: list[str], key: list[str] | None = None, unit: Column | None = None) -> DataFrame:
    """Per hour of the bars (or ``unit``): rows and two sums over their 64-bit hashes, whatever their order.

    ``odd`` counts rows that equal sums would not prove equal: those with a key that is missing and so matches nothing, or
    with a value that is not finite and so differs from itself. The sums form before the shuffle, which moves hours only.
    """
    key = key or KEY
    unit = F.col("window_start") - F.pmod("window_start", F.lit(HOUR_MS)) if unit is None else unit
    cells = [F.col(c) for c in (*key, *columns)]
    # a missing value leaves a hash as it is, so which ones are missing is hashed too
    present = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cells])
    odd = reduce(Column.__or__, [F.col(c).isNull() for c in key] + [
        F.coalesce(F.isnan((F.col(c) - F.col(c)).cast("double")), F.lit(False)) for c in columns
    ])
    return table.select(
        unit.alias("unit"), F.xxhash64(present, *cells).alias("_a"), F.xxhash64(F.lit(1), *cells, present).alias("_b"), odd.alias("_odd")
    ).groupBy("unit").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_a").cast("decimal(20,0)")).alias("first"),
        F.sum(F.col("_b").cast("decimal(20,0)")).alias("second"), F.count(F.when(F.col("_odd"), 1)).alias("odd"),
    )


def reconcile_by_digest(
    left: DataFrame, right: DataFrame, columns: list[str], eps: float = 1e-9, key: list[str] | None = None
) -> DataFrame:
    """``reconcile`` of two tables with one row per key, joining only the hours whose digests differ.

    ``key`` has window_start among its columns. Hours with the same rows are counted by their digests, so equal tables
    are reconciled without moving a row. ``hours_joined`` tells how many hours were compared row by row.
    """
    names = ["rows", "first", "second"]
    a, b = (digests(t, columns, key) for t in (left, right))
    met = a.select("unit", *[F.col(c).alias(f"l_{c}") for c in (*names, "odd")]).join(
        b.select("unit", *[F.col(c).alias(f"r_{c}") for c in (*names, "odd")]), "unit", "full_outer"
    )
    alike = reduce(Column.__and__, [F.col(f"l_{c}") == F.col(f"r_{c}") for c in names], (F.col("l_odd") + F.col("r_odd")) == 0)
    judged = settled(met.select("unit", F.col("l_rows").alias("rows"), F.coalesce(alike, F.lit(False)).alias("alike")))
    differing, _ = bounded(judged.filter(~F.col("alike")).select(F.col("unit").alias("_unit")))
    hour = F.col("window_start") - F.pmod("window_start", F.lit(HOUR_MS))

    def part(table: DataFrame) -> DataFrame:
        return table.join(differing, hour.eqNullSafe(F.col("_unit")), "left_semi")

    joined = reconcile(part(left), part(right), columns, eps, key)
    equal = judged.agg(
        F.coalesce(F.sum(F.when(F.col("alike"), F.col("rows"))), F.lit(0)).alias("_equal"),
        F.count(F.when(~F.col("alike"), 1)).alias("hours_joined"),
    )
    # two tables of one row each
    return joined.withColumns({
        "in_both": F.col("in_both") + equal.select("_equal").scalar(), "hours_joined": equal.select("hours_joined").scalar(),
    })
