"""Queries by the second, over the whole tables.

The queries of the same names without ``_seconds`` run at coarser steps beside their SQL, which lays out levels
per bucket. Here books are folded to the seconds that saw a change, and carried to the seconds between.
"""

import re

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.aggregates import mids
from tapeworks.catalog.ordered import grid_by
from tapeworks.catalog.registry import ORACLES, QUERIES, query
from tapeworks.catalog.streams import SPANS, book_by, streamed_ticks, streamed_ticks_sql
from tapeworks.functions.timecols import DAY, MINUTE, SECOND
from tapeworks.operators import align, book
from tapeworks.operators.horizons import HORIZONS
from tapeworks.plans import ticks as tick_plan
from tapeworks.session import work_folder

WHOLE = 1 << 30


def changed_books(spark, folder, k=WHOLE):
    return book.quotes(V.changes(spark, folder), SECOND, k=k)


def every_second(spark, folder, k):
    return align.on_grid(V.changes(spark, folder), changed_books(spark, folder, k), SECOND, [], ["bids", "asks"])


def _side(levels, side):
    return F.transform(levels, lambda x, i: F.struct(
        F.lit(side).alias("side"), x["price"].alias("price"), x["size"].alias("size"), (i + 1).alias("level")
    ))


def laid_out(books):
    sides = F.concat(_side(F.col("bids"), "buy"), _side(F.col("asks"), "sell"))
    return books.select("symbol", "bucket", F.explode(sides).alias("_level")).select("symbol", "bucket", "_level.*")


# a second with a mid price has a message, and each message is a change: its book is one of the changed ones
@query("j3_depth_filter_seconds")
def j3_seconds(spark, folder):
    near = book.near_mid(laid_out(changed_books(spark, folder)), mids(spark, folder, SECOND))
    return V.rounded(near.select("symbol", "bucket", "side", "price", "size"))


@query("a15_depth_seconds")
def a15_seconds(spark, folder):
    return V.rounded(book.depth(laid_out(changed_books(spark, folder)), mids(spark, folder, SECOND)).drop("mid"))


@query("a17_top_seconds")
def a17_seconds(spark, folder):
    live = every_second(spark, folder, 1).filter((F.size("bids") > 0) | (F.size("asks") > 0))
    best = (F.get(side, F.lit(0))["price"].alias(name) for side, name in (("bids", "best_bid"), ("asks", "best_ask")))
    return live.select("symbol", "bucket", *best)


@query("k1_levels_seconds")
def k1_seconds(spark, folder):
    return V.rounded(laid_out(every_second(spark, folder, 5)))


@query("j2_grid_seconds")
def j2_seconds(spark, folder):
    return grid_by(spark, folder, SECOND)


@query("t02_book_seconds")
def t02_seconds(spark, folder):
    return book_by(spark, folder, SECOND)


@query("t03_ticks_seconds")
def t03_seconds(spark, folder):
    return V.rounded(tick_plan.ticks(V.trades(spark, folder), V.tickers(spark, folder), V.changes(spark, folder)))


# ---- the same by the second on a short feed: the whole events table, its 30 days within 72 minutes


SHRINK = 600
START = 1_704_067_200_000_000
DENSE_EVENTS = f"""events AS (SELECT * REPLACE (make_timestamp({START} + (epoch_us(ts) - {START}) // {SHRINK}) AS ts) FROM main.events)"""
DENSE_STEPS = {"j2_grid": {MINUTE: SECOND}, "t03_ticks": {
    SPANS["1s"]: SECOND, **{SPANS[name] - 1: width - 1 for name, width in HORIZONS.items()},
}}


def dense(spark, folder):
    """A folder with the events of ``folder``, 600 times as dense."""
    place = work_folder(spark, "dense")
    us = START + F.expr(f"(unix_micros(cast(ts AS timestamp)) - {START}) div {SHRINK}")
    V.load(spark, folder, "events").withColumn("ts", F.timestamp_micros(us)).write.parquet(f"{place}/events.parquet")
    return place


def dense_sql(name):
    """The SQL of the coarser twin, its steps set to a second."""
    steps = DENSE_STEPS.get(name, {DAY: SECOND})
    sql = re.sub(r"\d+", lambda m: str(steps.get(int(m[0]), m[0])), ORACLES[name])
    return sql.replace("WITH ", f"WITH {DENSE_EVENTS}, ", 1)


def _dense(name):
    @query(f"{name}_dense", dense_sql(name))
    def run(spark, folder):
        return QUERIES[f"{name}_seconds"](spark, dense(spark, folder))


for _name in ("a15_depth", "a17_top", "j2_grid", "j3_depth_filter", "k1_levels", "t03_ticks"):
    _dense(_name)


@query("t03_ticks_stream_dense", streamed_ticks_sql(SECOND, HORIZONS).replace("WITH ", f"WITH {DENSE_EVENTS}, ", 1))
def t03_stream_dense(spark, folder):
    place = dense(spark, folder)
    events = spark.readStream.schema(V.load(spark, place, "events").schema).parquet(f"{place}/events.parquet")
    return streamed_ticks(V.feed(events))


# ---- books as intervals: results of the size of the changes, whatever the time between them


SQL_INTERVALS = f"""WITH {V.SQL_CHANGES},
last AS (SELECT symbol, side, price, us - us % {SECOND} AS bucket, arg_max(size, (us, seq)) AS size FROM changes GROUP BY ALL),
linked AS (SELECT *, lead(bucket) OVER (PARTITION BY symbol, side, price ORDER BY bucket) AS until FROM last),
intervals AS (SELECT symbol, side, price, size, bucket AS valid_from, until AS valid_to FROM linked WHERE size > 0)"""


@query("t02_intervals", f"""{SQL_INTERVALS}
SELECT symbol, side, price, round(size + 1.3e-9, 6) + 0.0 AS size, valid_from, valid_to FROM intervals""")
def t02_intervals(spark, folder):
    return V.rounded(book.level_intervals(V.changes(spark, folder)))


@query("a17_intervals", f"""{SQL_INTERVALS},
turns AS (SELECT DISTINCT symbol, us - us % {SECOND} AS bucket FROM changes),
tops AS (SELECT t.symbol, t.bucket, max(price) FILTER (side = 'buy') AS best_bid, min(price) FILTER (side = 'sell') AS best_ask
         FROM turns t LEFT JOIN intervals i ON i.symbol = t.symbol AND i.valid_from <= t.bucket AND (i.valid_to IS NULL OR i.valid_to > t.bucket)
         GROUP BY 1, 2),
sizes AS (SELECT t.symbol, t.bucket, best_bid, best_ask, b.size AS bid_size, a.size AS ask_size FROM tops t
          LEFT JOIN intervals b ON b.symbol = t.symbol AND b.side = 'buy' AND b.price = best_bid AND b.valid_from <= t.bucket AND (b.valid_to IS NULL OR b.valid_to > t.bucket)
          LEFT JOIN intervals a ON a.symbol = t.symbol AND a.side = 'sell' AND a.price = best_ask AND a.valid_from <= t.bucket AND (a.valid_to IS NULL OR a.valid_to > t.bucket)),
moved AS (SELECT *, row_number() OVER w AS n, lag(best_bid) OVER w AS b0, lag(best_ask) OVER w AS a0, lag(bid_size) OVER w AS bs0, lag(ask_size) OVER w AS as0
          FROM sizes WINDOW w AS (PARTITION BY symbol ORDER BY bucket))
SELECT symbol, bucket AS valid_from, lead(bucket) OVER (PARTITION BY symbol ORDER BY bucket) AS valid_to, best_bid, best_ask,
       round(bid_size + 1.3e-9, 6) + 0.0 AS bid_size, round(ask_size + 1.3e-9, 6) + 0.0 AS ask_size
FROM moved WHERE n = 1 OR best_bid IS DISTINCT FROM b0 OR best_ask IS DISTINCT FROM a0 OR bid_size IS DISTINCT FROM bs0 OR ask_size IS DISTINCT FROM as0""")
def a17_intervals(spark, folder):
    """The top of the book by the second, a row per change of it."""
    first = [F.get(side, F.lit(0)) for side in ("bids", "asks")]
    return V.rounded(book.quote_intervals(V.changes(spark, folder)).select(
        "symbol", "valid_from", "valid_to", first[0]["price"].alias("best_bid"), first[1]["price"].alias("best_ask"),
        first[0]["size"].alias("bid_size"), first[1]["size"].alias("ask_size"),
    ))
