"""Ordered work over whole feeds: running totals and look-backs, chunk by chunk.

Both operators read the feed twice: once to one row per chunk (aggregated before the
shuffle), once to run windows inside the chunks. The chunk table is carried along the
order of each key and joined back; its size is bounded by the time a feed spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.operators.chunks import CUT, Chunks

RUNNING: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max, "min": F.min}
JOINED: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda here, before: F.coalesce(here + before, here, before),
    "max": lambda here, before: F.greatest(here, before),
    "min": lambda here, before: F.least(here, before),
}


def scan(
    df: DataFrame,
    chunks: Chunks,
    last: dict[str, Column] | None = None,
    totals: dict[str, tuple[str, Column]] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Both kinds of ordered columns in one pass, in the order the chunks are cut by.

    ``last``: latest non-null value before the row (``inclusive``: or at it). ``totals``: running
    ``sum``/``max``/``min`` up to and including the row, given as (how, value).
    """
    last, totals = last or {}, totals or {}
    given = {**last, **{n: value for n, (_, value) in totals.items()}}
    feed = chunks.label(df).withColumns({f"_in_{n}": value for n, value in given.items()})

    order = list(dict.fromkeys([chunks.pos, chunks.seq]))
    rank, ends, carry = F.struct(*order), [], []
    before = W.partitionBy(*chunks.keys).orderBy(*CUT).rowsBetween(W.unboundedPreceding, -1)
    for n in last:
        value = F.col(f"_in_{n}")
        ends.append(F.max_by(value, F.when(value.isNotNull(), rank)).alias(f"_end_{n}"))
        carry.append(F.last(f"_end_{n}", ignorenulls=True).over(before).alias(f"_pre_{n}"))
    for n, (how, _) in totals.items():
        ends.append(RUNNING[how](F.col(f"_in_{n}")).alias(f"_end_{n}"))
        carry.append(RUNNING[how](F.col(f"_end_{n}")).over(before).alias(f"_pre_{n}"))
    carried = feed.groupBy(*chunks.group).agg(*ends).select(*chunks.group, *carry)

    inside = W.partitionBy(*chunks.group).orderBy(*order)
    to_here = inside.rowsBetween(W.unboundedPreceding, 0)
    to_last = to_here if inclusive else inside.rowsBetween(W.unboundedPreceding, -1)
    here = {n: F.last(f"_in_{n}", ignorenulls=True).over(to_last) for n in last}
    here |= {n: RUNNING[how](F.col(f"_in_{n}")).over(to_here) for n, (how, _) in totals.items()}
    out = feed.withColumns(here).join(carried, chunks.group, "left")
    out = out.withColumns({
        **{n: F.coalesce(n, f"_pre_{n}") for n in last},
        **{n: JOINED[how](F.col(n), F.col(f"_pre_{n}")) for n, (how, _) in totals.items()},
    })
    return chunks.strip(out.drop(*[f"_{p}_{n}" for n in given for p in ("in", "pre")]))


def running(
    df: DataFrame, chunks: Chunks, totals: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Running ``sum``/``max``/``min`` from the first row of a key to the current row."""
    return scan(df, chunks, totals=totals)


def last_known(
    df: DataFrame, chunks: Chunks, values: dict[str, Column], inclusive: bool = False
) -> DataFrame:
    """Latest non-null value before the current row (``inclusive``: or at it), per key."""
    return scan(df, chunks, last=values, inclusive=inclusive)


def with_preceding(
    df: DataFrame, pos: str, width: int, rows: int, columns: list[str], key: str = "symbol"
) -> DataFrame:
    """Blocks of ``width`` along ``pos``, each preceded by the last ``rows`` rows before it.

    For frames of a few rows: windows per (key, ``_block``) then see all they need. Borrowed
    rows hold ``columns`` only and have ``_own`` false; drop them with ``own_rows``.
    """
    own = df.withColumns({
        "_block": F.col(pos) - F.pmod(F.col(pos), F.lit(width)), "_own": F.lit(True),
    })
    newest = W.partitionBy(key, "_block").orderBy(F.desc(pos))
    ends = (
        own.select(key, "_block", F.struct(pos, *columns).alias("_row"), pos)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= rows)
        .groupBy(key, "_block")
        .agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    )
    # earlier blocks hold a row each at least, so as many of them as rows are enough
    blocks = W.partitionBy(key).orderBy("_block").rowsBetween(-rows, -1)
    before = ends.select(
        key, "_block", F.flatten(F.collect_list("_rows").over(blocks)).alias("_rows")
    ).select(key, "_block", F.explode(F.slice(F.reverse("_rows"), 1, rows)).alias("_row"))
    borrowed = before.select(key, "_block", "_row.*", F.lit(False).alias("_own"))
    return own.unionByName(borrowed, allowMissingColumns=True)


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_own", "_block")
