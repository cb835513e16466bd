"""Order books kept as streaming state, truncated after every change."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tapeworks.functions.timecols import SECOND, micros
from tapeworks.operators.book import LEVELS, MAX_LEVELS, apply_change, best_levels
from tapeworks.streaming.drain import use_rocksdb
from tapeworks.streaming.packed import gather, pieces

# Kinds and sides by their codes; levels a batch of books may hold.
KINDS, SIDES = ("l2update", "snapshot"), ("sell", "buy")
BATCH_LEVELS = 50_000
COLUMNS = ["us", "seq", "part", "kind", "side", "price", "size"]
# Besides the levels: the bucket still open, and the last snapshot begun.
STATE = f"bids {LEVELS}, asks {LEVELS}, bucket long, opened_us long, opened_seq long"
OUT = f"symbol string, bucket long, bids {LEVELS}, asks {LEVELS}"


def unpack(state) -> dict:
    """Side maps from the two stored level lists."""
    bids, asks = state or ([], [])
    return {"buy": {x[0]: x[1] for x in bids}, "sell": {x[0]: x[1] for x in asks}}


def pack(sides: dict) -> tuple:
    return tuple(sorted(sides[s].items()) for s in ("buy", "sell"))


def fold(sides: dict, changes, keep: int | None) -> None:
    """Apply (kind, side, price, size) in order. A change that pushes a level beyond ``keep`` forgets it."""
    for kind, side, price, size in changes:
        apply_change(sides, kind, side, price, size)
        if keep is not None and len(sides[side]) > keep:
            levels = sides[side]
            levels.pop(min(levels) if side == "buy" else max(levels))


def message_order(held: dict[str, np.ndarray]) -> np.ndarray:
    """Changes by time, message and place; a message that holds both kinds has all of its first kind first."""
    order = np.lexsort((held["part"], held["seq"], held["us"]))
    if not len(order) or held["kind"].min() == held["kind"].max():
        return order
    same = np.ones(len(order) - 1, bool)
    for c in ("us", "seq"):
        values = held[c][order]
        same &= values[1:] == values[:-1]
    kind = held["kind"][order]
    if (same & (kind[1:] != kind[:-1])).any():
        starts = np.flatnonzero(np.append([True], ~same))
        message = np.cumsum(np.append([0], ~same))
        order = order[np.lexsort((kind != kind[starts][message], message))]
    return order


class BookKeeper(StatefulProcessor):
    """Emits the book of each bucket in which it changed, once, when a change of a later bucket comes.

    The changes of a micro-batch are held as numbers; books go out a batch at a time.
    """

    def __init__(self, step: int, k: int, keep: int | None):
        self.step, self.k, self.keep = step, k, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.book = handle.getValueState("book", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = gather((pdf.astype({"price": float, "size": float}) for pdf in rows), COLUMNS)
        bids, asks, current, *opened = self.book.get() or ([], [], None, None, None)
        sides, opened, out, levels = unpack((bids, asks)), tuple(opened), [], 0
        for piece in pieces(held, message_order(held)):
            piece["kind"], piece["side"] = np.take(KINDS, piece["kind"]), np.take(SIDES, piece["side"])
            for us, seq, kind, side, price, size in zip(*(piece[c].tolist() for c in COLUMNS if c != "part")):
                bucket = us - us % self.step
                if current is not None and bucket > current:
                    out.append((key[0], current, best_levels(sides["buy"], "buy", self.k),
                                best_levels(sides["sell"], "sell", self.k)))
                    levels += len(out[-1][2]) + len(out[-1][3])
                    if levels > BATCH_LEVELS:
                        yield self._books(out)
                        out, levels = [], 0
                current = bucket if current is None else max(current, bucket)
                if kind == "snapshot" and (us, seq) != opened:
                    opened, sides = (us, seq), {"buy": {}, "sell": {}}
                fold(sides, [(kind, side, price, size)], self.keep)
        self.book.update((*pack(sides), current, *opened))
        yield self._books(out)

    def _books(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["symbol", "bucket", "bids", "asks"])

    def close(self) -> None:
        pass


def streaming_quotes(
    changes: DataFrame, step: int = SECOND, k: int = MAX_LEVELS, keep: int | None = MAX_LEVELS
) -> DataFrame:
    """Best ``k`` levels per symbol and bucket from a stream of book changes, in arrival order.

    A bucket comes out when it closes, so the last one of a symbol is still open.

    Two modes. As a feed handler does, a side forgets what a change pushes beyond its ``keep``
    best levels. With ``keep=None`` the whole book is state, and the result is that of the
    batch form, ``operators.book.quotes``.
    """
    use_rocksdb(changes.sparkSession)
    part = F.coalesce("part", F.lit((1 << 31) - 1)) if "part" in changes.columns else F.lit(0)
    kind = F.when(F.col("kind") == KINDS[1], 1).otherwise(0)
    side = F.when(F.col("side") == SIDES[1], 1).when(F.col("side") == SIDES[0], 0)
    slim = changes.filter("ts IS NOT NULL AND seq IS NOT NULL AND kind IS NOT NULL").select(
        "symbol", micros(F.col("ts")).alias("us"), "seq", part.cast("int").alias("part"), kind.cast("byte").alias("kind"),
        side.cast("byte").alias("side"), "price", "size",
    )
    return slim.groupBy("symbol").transformWithStateInPandas(
        BookKeeper(step, k, keep), OUT, outputMode="append", timeMode="none"
    )
