"""Order books as relations: levels per instant, top of book, depth around the mid price.

``changes`` has symbol, ts, seq, kind ('snapshot' or 'l2update'), side, price and size, and part,
the place within a message, where messages hold several changes. All levels of one snapshot
share ts and seq; a size of 0 deletes a level.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import DAY, SECOND, floor_to, micros
from tapeworks.operators.chunks import CUT, Chunks, bounded, measure
from tapeworks.operators.scan import last_known
from tapeworks.session import settled

# Levels kept per side, and the depth band around the mid price.
MAX_LEVELS = 50
DEPTH_BAND = 0.02


def with_snapshot(changes: DataFrame, chunks: Chunks | None = None) -> DataFrame:
    """Add ``_snap``: position of the latest snapshot at or before each change, 0 if none."""
    feed = changes.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"])
    opened = F.when(F.col("kind") == "snapshot", F.struct("_us", "seq"))
    marked = last_known(feed, chunks, {"_snap": opened}, inclusive=True)
    return marked.withColumn(
        "_snap", F.coalesce("_snap", F.struct(F.lit(0).cast("long").alias("_us"),
                                              F.lit(0).cast("long").alias("seq")))
    )


def order_of(changes: DataFrame) -> list[str]:
    """Columns that put changes in order."""
    return ["_us", "seq", *(["part"] if "part" in changes.columns else [])]


def level_changes(changes: DataFrame, every: int, chunks: Chunks | None = None) -> DataFrame:
    """Last size of each level per bucket and snapshot era."""
    marked = with_snapshot(changes, chunks).withColumn("bucket", floor_to(F.col("_us"), every))
    return marked.groupBy("symbol", "side", "price", "bucket").agg(
        F.max_by(F.struct("size", "_snap"), F.struct(*order_of(changes))).alias("_last")
    ).select("symbol", "side", "price", "bucket", "_last.*")


def books(changes: DataFrame, every: int, chunks: Chunks | None = None) -> DataFrame:
    """Live levels at the end of every bucket from the first change to the last.

    A level lives from its change until its next one, and ends with the snapshot era it
    belongs to. The result holds (levels x buckets) rows; pick ``every`` accordingly.
    """
    levels = settled(level_changes(changes, every, chunks))
    era = levels.groupBy("symbol", "bucket").agg(F.max("_snap").alias("_era"))
    span, _ = bounded(era.groupBy("symbol").agg(F.max("bucket").alias("_end")))
    # one row per symbol and bucket; the running maximum fills eras of buckets without changes
    following = W.partitionBy("symbol").orderBy("bucket")
    eras = (
        era.withColumns({
            "_era": F.max("_era").over(following.rowsBetween(W.unboundedPreceding, 0)),
            "_next": F.lead("bucket").over(following),
        })
        .withColumn("_until", F.coalesce(F.col("_next") - every, F.col("bucket")))
        .select("symbol", "_era", F.explode(F.sequence("bucket", "_until", F.lit(every))).alias("bucket"))
    )
    history = W.partitionBy("symbol", "side", "price").orderBy("bucket")
    lived = (
        levels.withColumn("_next", F.lead("bucket").over(history))
        .filter(F.col("size") > 0)
        .join(span, "symbol")
        .withColumn("_until", F.coalesce(F.col("_next") - every, F.col("_end")))
        .select(
            "symbol", "side", "price", "size", "_snap",
            F.explode(F.sequence("bucket", "_until", F.lit(every))).alias("bucket"),
        )
    )
    return (
        lived.join(eras, ["symbol", "bucket"])
        .filter(F.col("_snap") == F.col("_era"))
        .select("symbol", "bucket", "side", "price", "size")
    )


def level_intervals(changes: DataFrame, every: int = SECOND, chunks: Chunks | None = None) -> DataFrame:
    """Levels with the buckets in which they stand: (symbol, side, price, size, valid_from, valid_to).

    A level stands from the bucket of its change up to that of its next one, or of the next snapshot; ``valid_to``
    is the first bucket without it, null if it stands at the end. One row per change at most: the result doesn't
    grow with the time between changes.
    """
    levels = settled(level_changes(changes, every, chunks))
    eras = levels.groupBy("symbol", "_snap").agg(F.lit(True).alias("_one"))
    # eras without a level of their own end nothing: their snapshot set levels, so they have one
    following = W.partitionBy("symbol").orderBy("_snap")
    ends = eras.select("symbol", "_snap", floor_to(F.lead("_snap").over(following)["_us"], every).alias("_ends"))
    history = W.partitionBy("symbol", "side", "price").orderBy("bucket")
    stood = levels.withColumn("_next", F.lead("bucket").over(history)).filter(F.col("size") > 0)
    return (
        stood.join(ends, ["symbol", "_snap"])
        .select("symbol", "side", "price", "size", F.col("bucket").alias("valid_from"), F.least("_next", "_ends").alias("valid_to"))
        .filter("valid_to IS NULL OR valid_from < valid_to")
    )


def quote_intervals(changes: DataFrame, every: int = SECOND, chunks: Chunks | None = None, k: int = 1) -> DataFrame:
    """Best ``k`` levels per side with the buckets in which they stand: (symbol, valid_from, valid_to, bids, asks).

    One row per bucket that changed them; ``valid_to`` is null for the last one.
    """
    told = quotes(changes, every, chunks, k)
    following = W.partitionBy("symbol").orderBy("bucket")
    before = F.lag(F.struct("bids", "asks")).over(following)
    moved = told.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.struct("bids", "asks")))
    return moved.select(
        "symbol", F.col("bucket").alias("valid_from"), F.lead("bucket").over(following).alias("valid_to"), "bids", "asks"
    )


def top_levels(levels: DataFrame, k: int = MAX_LEVELS) -> DataFrame:
    """Best ``k`` levels per side: highest bids, lowest asks. Adds ``level`` (1 is the best)."""
    signed = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    best = W.partitionBy("symbol", "bucket", "side").orderBy(signed)
    return levels.withColumn("level", F.row_number().over(best)).filter(F.col("level") <= k)


def top_of_book(levels: DataFrame) -> DataFrame:
    """Best bid and best ask per instant, null where a side is empty."""
    buy = F.col("side") == "buy"
    return levels.groupBy("symbol", "bucket").agg(
        F.max(F.when(buy, F.col("price"))).alias("best_bid"),
        F.min(F.when(~buy, F.col("price"))).alias("best_ask"),
    )


def near_mid(levels: DataFrame, mids: DataFrame, band: float = DEPTH_BAND) -> DataFrame:
    """Levels within ``band`` of that instant's mid price (mids: symbol, bucket, mid)."""
    price, mid = F.col("price"), F.col("mid")
    kept = F.when(F.col("side") == "buy", price >= mid * (1 - band)).otherwise(price <= mid * (1 + band))
    return levels.join(mids, ["symbol", "bucket"]).filter((mid > 0) & kept)


def depth(levels: DataFrame, mids: DataFrame, band: float = DEPTH_BAND) -> DataFrame:
    """Total, bid and ask size near the mid, one row per row of ``mids``; 0 without levels."""
    buy = F.col("side") == "buy"
    sums = near_mid(levels, mids, band).groupBy("symbol", "bucket").agg(
        F.sum("size").alias("depth"),
        F.sum(F.when(buy, F.col("size"))).alias("bid_depth"),
        F.sum(F.when(~buy, F.col("size"))).alias("ask_depth"),
    )
    return mids.join(sums, ["symbol", "bucket"], "left").withColumns(
        {c: S.or_zero(F.col(c)) for c in ("depth", "bid_depth", "ask_depth")}
    )


def apply_change(sides: dict, kind: str, side: str, price: float, size: float) -> None:
    """Put one level into {'buy': {price: size}, 'sell': {...}}, or take it out."""
    if size == 0 and kind != "snapshot":
        sides[side].pop(price, None)
    else:
        sides[side][price] = size


class Ladder:
    """One side of a book with its prices in order: a change costs a search, the best levels are a slice."""

    def __init__(self, levels: dict[float, float]):
        self.sizes = levels
        self.prices = sorted(levels)

    def change(self, kind: str, price: float, size: float) -> None:
        if size == 0 and kind != "snapshot":
            if self.sizes.pop(price, None) is not None:
                del self.prices[bisect.bisect_left(self.prices, price)]
            return
        if price not in self.sizes:
            bisect.insort(self.prices, price)
        self.sizes[price] = size

    def best(self, side: str, k: int = MAX_LEVELS) -> list[float]:
        return self.prices[:-k - 1:-1] if side == "buy" else self.prices[:k]


def best_levels(levels: dict[float, float], side: str, k: int = MAX_LEVELS) -> list[dict]:
    pick = heapq.nlargest if side == "buy" else heapq.nsmallest
    return [{"price": p, "size": levels[p]} for p in pick(k, levels)]


LEVELS = "array<struct<price:double,size:double>>"
QUOTE_SCHEMA = f"symbol string, _chunk long, _sub long, bucket long, bids {LEVELS}, asks {LEVELS}"
# A task hands its books on in batches of so many rows, or once they hold so many levels.
BATCH_ROWS = 10_000
BATCH_LEVELS = 200_000


def _opening(ends: DataFrame) -> DataFrame:
    """The live levels each chunk starts with, from the last size of each level per chunk."""
    numbered = W.partitionBy("symbol").orderBy(*CUT)
    # the last change of a chunk belongs to its last era and is the last one of some level
    eras = (
        ends.groupBy("symbol", *CUT).agg(F.max("_snap").alias("_last_snap"))
        .withColumns({
            "_n": F.row_number().over(numbered),
            "_era": F.max("_last_snap").over(numbered.rowsBetween(W.unboundedPreceding, -1)),
        })
    )
    end, _ = bounded(eras.groupBy("symbol").agg(F.max("_n").alias("_end")))
    sizes = ends.join(eras.select("symbol", *CUT, "_n"), ["symbol", *CUT]).select(
        "symbol", "side", "price", "_n", "size", "_snap"
    )
    following = W.partitionBy("symbol", "side", "price").orderBy("_n")
    lived = (
        sizes.withColumn("_next", F.lead("_n").over(following))
        .filter(F.col("size") > 0)
        .join(end, "symbol")
        .withColumn("_until", F.coalesce("_next", "_end"))
        .filter(F.col("_n") < F.col("_until"))
        .withColumn("_n", F.explode(F.sequence(F.col("_n") + 1, F.col("_until"))))
    )
    return (
        lived.join(eras.select("symbol", *CUT, "_n", "_era"), ["symbol", "_n"])
        .filter(F.col("_snap") == F.col("_era"))
        .select("symbol", *CUT, "side", "price", "size")
    )


def _plain(column: pa.Array) -> list:
    """Python values of a column; missing numbers are NaN."""
    if column.null_count and pa.types.is_integer(column.type):
        return [float("nan") if x is None else x for x in column.to_pylist()]
    return column.to_numpy(zero_copy_only=False).tolist()


class _Books:
    """Books laid down as flat columns, until a batch of them goes out."""

    def __init__(self):
        self.rows = []
        self.sides = {side: ([0], [], []) for side in ("buy", "sell")}
        self.levels = 0

    def add(self, row: tuple, sides: dict[str, Ladder], k: int) -> None:
        self.rows.append(row)
        for side, (ends, prices, sizes) in self.sides.items():
            best = sides[side].best(side, k)
            prices.extend(best)
            sizes.extend(map(sides[side].sizes.__getitem__, best))
            ends.append(len(prices))
            self.levels += len(best)

    def full(self) -> bool:
        return len(self.rows) >= BATCH_ROWS or self.levels >= BATCH_LEVELS

    def batch(self) -> pa.RecordBatch:
        symbol, *numbers = zip(*self.rows)
        columns = [pa.array(symbol, pa.string()), *(pa.array(x, pa.int64(), from_pandas=True) for x in numbers)]
        for ends, *values in self.sides.values():
            levels = pa.StructArray.from_arrays([pa.array(x, pa.float64(), from_pandas=True) for x in values], ["price", "size"])
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), levels))
        return pa.RecordBatch.from_arrays(columns, ["symbol", *CUT, "bucket", "bids", "asks"])


def fold_books(batches: Iterable[pa.RecordBatch], step: int, k: int) -> Iterator[pa.RecordBatch]:
    """Books at the end of each bucket from rows in order: per chunk the levels it opens with, then its changes.

    Holds one book, the batch read and the batch to be handed on, however many changes a chunk has.
    """
    made, opening, sides = _Books(), {}, {}
    chunk = current = opened = None  # current: the row of the bucket still open

    for batch in batches:
        for symbol, cut, sub, change, us, seq, kind, side, price, size in zip(*(_plain(c) for c in batch.columns)):
            new, bucket = (symbol, cut, sub) != chunk, us - us % step
            if current and (new or bucket != current[3]):
                made.add(current, sides, k)
                if made.full():
                    yield made.batch()
                    made = _Books()
            if new:
                chunk, current, opened = (symbol, cut, sub), None, None
                opening = {"buy": {}, "sell": {}}
            if not change:
                opening[side][price] = size
                continue
            if current is None:
                sides = {side_: Ladder(levels) for side_, levels in opening.items()}
            current = (symbol, cut, sub, bucket)
            if kind == "snapshot" and (us, seq) != opened:
                opened, sides = (us, seq), {"buy": Ladder({}), "sell": Ladder({})}
            sides[side].change(kind, price, size)
    if current:
        made.add(current, sides, k)
    if made.rows:
        yield made.batch()


def quotes(
    changes: DataFrame, step: int = SECOND, chunks: Chunks | None = None, k: int = MAX_LEVELS
) -> DataFrame:
    """Best ``k`` levels per side at the end of each bucket that saw a change.

    Chunks are folded independently: each gets the levels it opens with from a relational
    pass, and holds a bounded number of changes. Spark sorts them; a fold reads them as they
    come and hands its books on in batches.
    """
    feed = changes.withColumn("_us", micros(F.col("ts")))
    chunks = chunks or measure(feed, ["symbol"], width=max(DAY, step))  # few chunks: each opens with all live levels
    feed = chunks.label(with_snapshot(changes, chunks)).drop("_span")
    order = order_of(changes)

    ends = feed.groupBy("symbol", *CUT, "side", "price").agg(
        F.max_by(F.struct("size", "_snap"), F.struct(*order)).alias("_last")
    ).select("symbol", *CUT, "side", "price", "_last.*")
    opening = _opening(settled(ends))
    slim = feed.select("symbol", *CUT, *order, "kind", "side", "price", "size", F.lit(True).alias("_change"))
    stacked = slim.unionByName(opening.withColumn("_change", F.lit(False)), allowMissingColumns=True)
    # changes without a time make a chunk, the earliest one; levels a chunk opens with come before its changes
    in_order = stacked.withColumn("_chunk", F.coalesce("_chunk", F.lit(-(1 << 63)))).repartition("symbol", *CUT).sortWithinPartitions(
        "symbol", *CUT, "_change", *[F.col(c).asc_nulls_last() for c in order],
    )

    def fold(batches):
        return fold_books(batches, step, k)

    folded = in_order.select(
        "symbol", *CUT, "_change", "_us", "seq", "kind", "side", "price", "size"
    ).mapInArrow(fold, QUOTE_SCHEMA)
    if not chunks.splits and chunks.width % step == 0:
        return folded.drop(*CUT)
    # a cut inside a bucket leaves two rows for it, of which the later chunk's is final
    return folded.groupBy("symbol", "bucket").agg(
        F.max_by(F.struct("bids", "asks"), F.struct(*CUT)).alias("_book")
    ).select("symbol", "bucket", "_book.*")
