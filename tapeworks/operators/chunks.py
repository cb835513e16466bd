"""Cutting ordered feeds into pieces that fit one task.

Running sums, look-backs and as-of lookups need the rows of a symbol in order, but one
symbol may own a third of a feed. So a feed is cut along its order into chunks: work runs
per (keys, chunk), and a table with one row per chunk carries state across the cuts.

A chunk is a bucket of ``width`` microseconds. ``measure`` counts the rows per bucket and
cuts buckets over ``rows`` into shorter ones, again and again; an instant that alone
exceeds the limit is cut along the sequence number.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.timecols import HOUR, floor_to
from tapeworks.session import settled

ROWS_PER_CHUNK = 1_000_000
# Most rows a side table may have to be broadcast. Overfull buckets number at most
# (rows of the feed / rows per chunk).
BROADCAST_ROWS = 50_000
# An overfull bucket is cut into this many parts at least, so that a dense instant inside it
# is reached in a few rounds.
FEWEST_PARTS = 32
CUT = ["_chunk", "_sub"]


def bounded(table: DataFrame) -> tuple[DataFrame, bool]:
    """``table`` ready to be joined to a feed, and whether it has any rows.

    It is counted by fetching at most one row more than may be broadcast. Up to that many are
    broadcast; a longer one is written out and takes part in an ordinary join, where adaptive
    execution splits a skewed feed.
    """
    found = table.limit(BROADCAST_ROWS + 1).collect()
    if len(found) > BROADCAST_ROWS:
        return settled(table), True
    return F.broadcast(table.sparkSession.createDataFrame(found, table.schema)), bool(found)


@dataclass(frozen=True)
class Chunks:
    keys: tuple[str, ...]
    width: int = HOUR
    pos: str = "_us"
    seq: str = "seq"
    splits: tuple[DataFrame, ...] = field(default=())

    @property
    def group(self) -> list[str]:
        return [*self.keys, *CUT]

    def label(self, df: DataFrame, newest: str = "left") -> DataFrame:
        """Add the chunk columns: start in time, start in sequence if cut there, and length.

        ``newest="inner"`` keeps only the rows of buckets cut by the last split.
        """
        out = df.withColumns({
            "_chunk": floor_to(F.col(self.pos), self.width),
            "_sub": F.lit(0).cast("long"),
            "_span": F.lit(self.width).cast("long"),
        })
        for i, split in enumerate(self.splits, 1):
            how = newest if i == len(self.splits) else "left"
            offset = F.col(self.pos) - F.col("_chunk")
            along = F.col(self.seq) - F.col("_seq_low")
            out = out.join(split, self.group, how).withColumns({
                "_chunk": F.coalesce(
                    F.col("_chunk") + offset - F.pmod(offset, F.col("_step")), F.col("_chunk")
                ),
                "_sub": F.coalesce(F.col(self.seq) - F.pmod(along, F.col("_seq_step")), F.col("_sub")),
                "_span": F.coalesce("_step", "_span"),
            }).drop("_step", "_seq_low", "_seq_step")
        return out

    def strip(self, df: DataFrame) -> DataFrame:
        return df.drop(*CUT, "_span")


def measure(
    df: DataFrame,
    keys: list[str],
    width: int = HOUR,
    pos: str = "_us",
    seq: str = "seq",
    rows: int = ROWS_PER_CHUNK,
    rounds: int = 24,
) -> Chunks:
    """Chunks of about ``rows`` rows at most. Runs a count per bucket, two columns wide."""
    chunks = Chunks(tuple(keys), width, pos, seq)
    slim = df.select(*keys, F.col(pos), F.col(seq))
    span, low, high = F.col("_span"), F.col("_seq_low"), F.col("_seq_high")
    for _ in range(rounds):
        parts = F.greatest(F.ceil(F.col("n") / rows), F.lit(FEWEST_PARTS))
        full = (
            chunks.label(slim, newest="inner")
            .groupBy(*chunks.group)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.max("_span").alias("_span"),
                F.min(seq).alias("_seq_low"),
                F.max(seq).alias("_seq_high"),
            )
            .filter((F.col("n") > rows) & ((span > 1) | (high > low)))
            .select(
                *chunks.group,
                F.when(span > 1, F.ceil(span / parts)).cast("long").alias("_step"),
                "_seq_low",
                F.when(span <= 1, F.ceil((high - low + 1) / parts)).cast("long").alias("_seq_step"),
            )
        )
        full, found = bounded(full)
        if not found:
            break
        chunks = replace(chunks, splits=(*chunks.splits, full))
    else:
        raise ValueError(f"chunks are still over {rows} rows after {rounds} cuts")
    return chunks
