"""Look-back metrics over several horizons ending at each sample.

A horizon of width w at time t covers (t - w, t]. Sliding a frame row by row costs the frame
length per row, so time is cut into blocks of length b, with w = m * b. The span then is the
end of block k - m, the whole blocks between, and the start of block k up to t. Starts and
ends are running aggregates; each row visits its own block and, shifted by w, the block m
further on, where later rows meet it. The blocks between come from a table with one row per
block. Every row is shuffled twice per horizon, whatever its length. Usually m is 1; it grows
until the fullest block fits a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.functions import scalars as S
from tapeworks.functions.timecols import DAY, HOUR, MINUTE, SECOND, floor_to, micros
from tapeworks.operators.chunks import ROWS_PER_CHUNK
from tapeworks.session import settled

# The horizons of a tick.
HORIZONS = {"1s": SECOND, "1min": MINUTE, "1h": HOUR, "24h": DAY}
METRICS = ["high", "low", "price_change", "price_change_percent", "volume", "buy_volume", "sell_volume"]


def _parts() -> dict[str, tuple]:
    """Aggregates a horizon is merged from: (aggregate, input)."""
    point = F.when(F.col("price") > 0, F.struct("_us", "seq", "price"))
    return {
        "first": (F.min, point),
        "last": (F.max, point),
        "high": (F.max, F.when(F.col("price") > 0, F.col("price"))),
        "low": (F.min, F.when(F.col("price") > 0, F.col("price"))),
        "buy": (F.sum, S.or_zero(F.col("buy_vol"))),
        "sell": (F.sum, S.or_zero(F.col("sell_vol"))),
    }


def block_counts(
    samples: DataFrame, key: str, widths: dict[str, int], rows: int
) -> dict[str, int]:
    """Blocks per horizon so that the fullest block holds at most about ``rows`` rows."""
    parts, todo = {name: 1 for name in widths}, dict(widths)
    while todo:
        blocks = F.array(*[
            F.struct(F.lit(n).alias("name"), floor_to(F.col("_us"), w // parts[n]).alias("block"))
            for n, w in todo.items()
        ])
        counted = samples.select(key, F.explode(blocks).alias("b")).groupBy(key, "b").count()
        fullest = dict(counted.groupBy("b.name").agg(F.max("count")).collect())
        over = {}
        for name, width in todo.items():
            if (fullest.get(name) or 0) > rows and width % (10 * parts[name]) == 0:
                parts[name] *= 10
                over[name] = width
        todo = over
    return parts


def _between(whole: DataFrame, key: str, width: int, length: int) -> DataFrame:
    """Aggregates over the whole blocks between the two ends, for every block.

    The same scheme once more, on one row per block: the span (block - width, block - length]
    meets the end of one stretch of its own size and the start of the next.
    """
    size, parts = width - length, _parts()
    copies = F.array(*[
        F.struct(F.lit(role).alias("role"), at.alias("at"), floor_to(at, size).alias("stretch"))
        for role, at in (
            ("own", F.col("_block")), ("past", F.col("_block") + size), ("asks", F.col("_block") - length)
        )
    ])
    laid = whole.select("*", F.explode(copies).alias("c")).select("*", "c.*").drop("c")
    group = W.partitionBy(key, "stretch")
    start = group.orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    end = group.orderBy(F.desc("at")).rangeBetween(W.unboundedPreceding, -1)
    role, columns = F.col("role"), {}
    for part, (how, _) in parts.items():
        value = F.col(f"_b_{part}")
        columns[f"_x_{part}"] = how(F.when(role == "own", value)).over(start)
        columns[f"_y_{part}"] = how(F.when(role == "past", value)).over(end)
    merged = {
        "first": F.least, "last": F.greatest, "high": F.greatest, "low": F.least,
        "buy": lambda x, y: F.coalesce(x + y, x, y), "sell": lambda x, y: F.coalesce(x + y, x, y),
    }
    return laid.withColumns(columns).filter(role == "asks").select(
        key, "_block",
        *[merged[part](F.col(f"_x_{part}"), F.col(f"_y_{part}")).alias(f"_m_{part}") for part in parts],
    )


def _one_horizon(feed: DataFrame, key: str, name: str, width: int, m: int, keep: list[str]) -> DataFrame:
    length = width // m
    parts = _parts()
    block = floor_to(F.col("_us"), length)
    # one copy of a row in its own block, and one of its figures where later rows look back
    figures = [key, "_us", "seq", "price", "buy_vol", "sell_vol"]
    rest = [c for c in keep if c not in figures]
    nothing = F.lit(None).cast(feed.select(F.struct(*rest) if rest else F.struct(F.lit(0))).schema[0].dataType)
    copies = F.array(
        F.struct(F.lit(True).alias("own"), block.alias("block"), F.col("_us").alias("at"),
                 (F.struct(*rest) if rest else F.struct(F.lit(0))).alias("rest")),
        F.struct(F.lit(False).alias("own"), (block + width).alias("block"),
                 (F.col("_us") + width).alias("at"), nothing.alias("rest")),
    )
    both = feed.select(*figures, F.explode(copies).alias("_c")).select(
        *figures, F.col("_c.own").alias("_own"), F.col("_c.block").alias("_block"),
        F.col("_c.at").alias("_at"), F.col("_c.rest").alias("_rest"),
    )

    group = W.partitionBy(key, "_block")
    start = group.orderBy("_at").rangeBetween(W.unboundedPreceding, W.currentRow)
    # in descending order, strictly later positions: rows less than `width` old
    end = group.orderBy(F.desc("_at")).rangeBetween(W.unboundedPreceding, -1)
    columns = {}
    for part, (how, value) in parts.items():
        columns[f"_s_{part}"] = how(F.when(F.col("_own"), value)).over(start)
        columns[f"_e_{part}"] = how(F.when(~F.col("_own"), value)).over(end)
    out = both.withColumns(columns).filter("_own").select("*", "_rest.*").drop("_rest")

    sources = ["e", "s"]
    if m > 1:
        whole = feed.withColumn("_block", block).groupBy(key, "_block").agg(
            *[how(value).alias(f"_b_{part}") for part, (how, value) in parts.items()]
        )
        whole = _between(whole, key, width, length)
        out = out.join(whole, [key, "_block"], "left")
        sources = ["e", "m", "s"]

    def all_of(part: str) -> list[Column]:
        return [F.col(f"_{s}_{part}") for s in sources]

    first = F.coalesce(*all_of("first"))["price"]
    last = F.coalesce(*reversed(all_of("last")))["price"]
    buy = sum((S.or_zero(c) for c in all_of("buy")), F.lit(0.0))
    sell = sum((S.or_zero(c) for c in all_of("sell")), F.lit(0.0))
    high, low = F.greatest(*all_of("high")), F.least(*all_of("low"))
    priced = first.isNotNull()  # without any positive price the volumes count as 0 too
    metrics = {
        "high": S.or_zero(high),
        "low": S.or_zero(low),
        "price_change": S.or_zero(last - first),
        "price_change_percent": S.or_zero(S.change_percent(first, last)),
        "volume": S.when_or_zero(priced, buy + sell),
        "buy_volume": S.when_or_zero(priced, buy),
        "sell_volume": S.when_or_zero(priced, sell),
    }
    return out.select(*keep, *[value.alias(f"{metric}_{name}") for metric, value in metrics.items()])


def horizons(
    samples: DataFrame,
    widths: dict[str, int] | None = None,
    key: str = "symbol",
    rows_per_block: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``<metric>_<name>`` per horizon to samples(symbol, ts, seq, price, buy_vol, sell_vol).

    ``rows_per_block=None`` skips the count of rows per block, for feeds whose pace is known.
    """
    widths = widths or HORIZONS
    out = samples.withColumn("_us", micros(F.col("ts")))
    parts = {} if rows_per_block is None else block_counts(out, key, widths, rows_per_block)
    for name, width in widths.items():
        if parts.get(name, 1) > 1:
            out = settled(out)  # read twice below
        out = _one_horizon(out, key, name, width, parts.get(name, 1), out.columns)
    return out.drop("_us")


def horizons_by_frame(
    samples: DataFrame, widths: dict[str, int] | None = None, key: str = "symbol"
) -> DataFrame:
    """The same metrics from plain sliding frames: for short horizons and as a cross-check."""
    out = samples.withColumn("_us", micros(F.col("ts")))
    parts = _parts()
    for name, width in (widths or HORIZONS).items():
        frame = W.partitionBy(key).orderBy("_us").rangeBetween(-(width - 1), 0)
        value = {part: how(source).over(frame) for part, (how, source) in parts.items()}
        first, last = value["first"]["price"], value["last"]["price"]
        priced = first.isNotNull()
        out = out.withColumns({
            f"high_{name}": S.or_zero(value["high"]),
            f"low_{name}": S.or_zero(value["low"]),
            f"price_change_{name}": S.or_zero(last - first),
            f"price_change_percent_{name}": S.or_zero(S.change_percent(first, last)),
            f"volume_{name}": S.when_or_zero(priced, value["buy"] + value["sell"]),
            f"buy_volume_{name}": S.when_or_zero(priced, value["buy"]),
            f"sell_volume_{name}": S.when_or_zero(priced, value["sell"]),
        })
    return out.drop("_us")
