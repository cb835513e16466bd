import random
import time

import pytest
from helpers import as_dicts, at, random_trades, trades
from pyspark.sql import functions as F

from tapeworks.functions.timecols import HOUR, MINUTE, SECOND
from tapeworks.operators import bars as B
from tapeworks.operators import book, flow, health
from tapeworks.plans import ticks as tick_plan
from tapeworks.session import work_folder
from tapeworks.sources import tables, topics
from tapeworks.streaming import alerts as A
from tapeworks.streaming import bars as SB
from tapeworks.streaming import book as SK
from tapeworks.streaming import state as SS
from tapeworks.streaming import ticks as ST
from tapeworks.streaming.drain import drain, dropped_late


def stream_of(spark, df, order="ts", files=4):
    """A stream that delivers ``df`` in ``files`` micro-batches, in time order."""
    root = work_folder(spark, "stream")
    rows = df.orderBy(order, "seq").collect()
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], df.schema).coalesce(1).write.mode("append").parquet(root)
        time.sleep(0.05)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(root)


def equal(got, want):
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        for name, x in b.items():
            assert a[name] == (pytest.approx(x, abs=1e-6) if isinstance(x, float) else x), name


@pytest.mark.parametrize("width, width_us, sub", [("1 minute", MINUTE, "1 second"), ("1 hour", HOUR, "7 minutes")])
def test_streaming_bars_equal_batch_bars(spark, width, width_us, sub):
    feed = trades(spark, random_trades(300, span=20_000)).withColumn("volume_1s", F.col("size"))
    rows, _ = drain(SB.streaming_bars(stream_of(spark, feed), width, width_us, sub if width_us == MINUTE else "10 minutes"))
    last = feed.agg(F.max("ts")).first()[0].timestamp() * 1000 - 300_000
    want = B.bars(feed, width_us).filter(F.col("window_end") <= last)
    equal(as_dicts(rows, "symbol", "window_start"), as_dicts(want, "symbol", "window_start"))


def test_late_rows_are_dropped_and_counted(spark):
    feed = trades(spark, [("X", t, i, 1.0, 1.0, "buy") for i, t in enumerate([0, 1, 4000, 4001, 8000, 8001, 10, 11])])
    stream = stream_of(spark, feed, order="seq")
    rows, query = drain(SB.streaming_bars(stream))
    assert dropped_late(query) > 0
    assert sum(r.num_ticks for r in rows.collect()) == 4  # the last two minutes are open, two rows late


def test_streaming_book_equals_batch_book_below_the_limit(spark):
    from test_book import SCHEMA, random_changes
    data = [("X", at(t), q, i, k, s, float(p), float(z)) for i, (t, q, k, s, p, z) in enumerate(random_changes())]
    df = spark.createDataFrame(data, SCHEMA)
    rows, _ = drain(SK.streaming_quotes(stream_of(spark, df), MINUTE))
    got, want = as_dicts(rows, "bucket"), as_dicts(book.quotes(df, MINUTE), "bucket")
    assert len(got) > 20
    assert [(r["bucket"], r["bids"], r["asks"]) for r in got] == [(r["bucket"], r["bids"], r["asks"]) for r in want[:-1]]  # the last is open


def test_whole_books_equal_the_batch_form_above_the_limit(spark):
    from test_book import SCHEMA
    rnd, data, seq = random.Random(7), [], 0
    while len(data) < 900:
        seq += 1
        kind = "snapshot" if rnd.random() < 0.01 else "l2update"
        for part in range(rnd.randint(1, 4) if kind == "l2update" else 120):
            side = rnd.choice(["buy", "sell"])
            price = rnd.randint(1, 90) + (100 if side == "sell" else 0)
            data.append(("X", at(seq * 7.3), seq, part, kind, side, float(price), float(rnd.choice([0, 1, 2, 3]) if kind == "l2update" else 1)))
    df = spark.createDataFrame(data, SCHEMA)
    want = as_dicts(book.quotes(df, MINUTE, k=200), "bucket")
    assert max(len(r["bids"]) for r in want) > 50
    rows, _ = drain(SK.streaming_quotes(stream_of(spark, df, files=4), MINUTE, k=200, keep=None))
    got = as_dicts(rows, "bucket")
    assert [(r["bucket"], r["bids"], r["asks"]) for r in got] == [(r["bucket"], r["bids"], r["asks"]) for r in want[:-1]]


def test_streaming_book_forgets_levels_beyond_the_limit(spark):
    from test_book import SCHEMA
    steps = [("buy", 10, 1), ("buy", 11, 1), ("buy", 12, 1), ("buy", 12, 0), ("buy", 11, 0)]
    data = [("X", at(i), i, 0, "l2update", s, float(p), float(z)) for i, (s, p, z) in enumerate(steps)]
    df = spark.createDataFrame(data, SCHEMA)
    rows, _ = drain(SK.streaming_quotes(stream_of(spark, df, files=2), SECOND, k=2, keep=2))
    books = [[x["price"] for x in r["bids"]] for r in as_dicts(rows, "bucket")]
    assert books == [[10], [11, 10], [12, 11], [11]]  # 10 was pushed out and stays out; the last second is open


def test_a_missing_size_moves_nothing(spark):
    feed = trades(spark, [("X", i, i, p, z, "buy") for i, (p, z) in enumerate([(1.0, 1.0), (None, None), (3.0, 2.0), (4.0, None)])])
    rows = as_dicts(drain(SS.streaming_trades(stream_of(spark, feed, files=2)))[0], "seq")
    assert [r["cvd"] for r in rows] == [1, 1, 3, 3] and [r["previous_price"] for r in rows] == [None, 1, 1, 3]


def test_stream_sessions_equal_batch_sessions(spark):
    feed = trades(spark, [r for r in random_trades(200, span=9000) if r[3] > 0])
    rows = as_dicts(drain(SS.streaming_trades(stream_of(spark, feed, files=3), sessions=True))[0], "seq")
    want = as_dicts(flow.volume_delta(health.sessions(feed), session="feed_session"), "seq")
    assert max(r["feed_session"] for r in rows) > 5
    assert [(r["seq"], r["feed_session"], r["cvd"]) for r in rows] == [(r["seq"], r["feed_session"], pytest.approx(r["cvd"])) for r in want]


def test_cooldown_keys_are_forgotten(spark):
    feed = spark.createDataFrame([(f"k{t % 50}", at(t * 60), t) for t in range(300)], "alert_key string, ts timestamp, seq long")
    rows, query = drain(A.streaming_cooldown(stream_of(spark, feed, files=6), lateness="0 seconds"))
    assert rows.count() == 300 and query.recentProgress[-1].stateOperators[0].numRowsTotal < 50


def test_running_state_survives_batches(spark):
    feed = trades(spark, random_trades(120))
    rows, _ = drain(SS.streaming_trades(stream_of(spark, feed)))
    want = {r["seq"]: r["cvd"] for r in as_dicts(flow.volume_delta(feed), "seq")}
    got = {r["seq"]: r["cvd"] for r in as_dicts(rows, "seq")}
    assert got == pytest.approx(want)
    assert rows.filter("previous_price is null").count() == 3  # the first trade of each symbol


def late_by_one(feed, spark, every=3, files=4):
    """The feed in micro-batches of equal spans; every third row arrives in the batch after its own."""
    root = work_folder(spark, "late")
    rows = feed.orderBy("ts", "seq").collect()
    size = -(-len(rows) // files)
    parts = [[] for _ in range(files)]
    for at_, row in enumerate(rows):
        parts[min(files - 1, at_ // size + (row["seq"] % every == 0))].append(row)
    for part in parts:
        spark.createDataFrame(part, feed.schema).coalesce(1).write.mode("append").parquet(root)
        time.sleep(0.05)
    return spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(root)


def test_trades_a_batch_late_are_followed_in_order(spark):
    feed = trades(spark, [(s, t, i, 100.0 + i, 1.0 + i % 3, k) for i, (s, t, k) in enumerate(
        [("X", t, "buy" if t % 5 else "sell") for t in range(0, 400, 2)] + [("Y", 31, "buy"), ("Y", 33, "sell")])])
    rows = as_dicts(drain(SS.ordered_trades(late_by_one(feed, spark), "200 seconds"))[0], "symbol", "us", "seq")
    closed = feed.filter(F.col("ts") < F.lit(at(398 - 200)))
    want = as_dicts(flow.volume_delta(closed), "symbol", "ts", "seq")
    assert len(rows) == 99 + 2  # Y is released without a later message of its own
    assert [(r["symbol"], r["seq"], r["cvd"]) for r in rows] == [(r["symbol"], r["seq"], pytest.approx(r["cvd"])) for r in want]
    last = {}
    for r in rows:
        assert r["previous_price"] == last.get(r["symbol"])
        last[r["symbol"]] = r["price"]


def test_ordered_trades_refuse_what_the_watermark_has_passed_and_keep_nulls(spark):
    data = [("X", 0, 0, 1.0, 1.0, "buy"), ("X", 5000, 1, None, None, "buy"), ("X", 6000, 2, 2.0, 1.0, "buy"), ("X", 10, 3, 9.0, 9.0, "buy"),
            ("X", 20_000, 4, 3.0, 1.0, "sell"), ("X", 40_000, 5, 3.0, 1.0, "sell")]
    rows, query = drain(SS.ordered_trades(stream_of(spark, trades(spark, data), order="seq", files=6), "10 seconds"))
    got = as_dicts(rows, "us")
    assert [(r["seq"], r["previous_price"], r["cvd"]) for r in got] == [(0, None, 1), (1, 1, 1), (2, 1, 2), (4, 2, 1)]
    assert dropped_late(query) == 1


def test_silent_symbols_are_forgotten(spark):
    data = [("X", 0, 0, 1.0, 5.0, "buy"), ("Y", 1000, 1, 1.0, 1.0, "buy"), ("Y", 2000, 2, 1.0, 1.0, "buy"), ("X", 3000, 3, 2.0, 1.0, "buy"), ("Y", 9000, 4, 1.0, 1.0, "buy")]
    feed = trades(spark, data)
    kept = as_dicts(drain(SS.ordered_trades(stream_of(spark, feed, files=5), "10 seconds"))[0], "seq")
    gone = as_dicts(drain(SS.ordered_trades(stream_of(spark, feed, files=5), "10 seconds", forget_ms=1_500_000))[0], "seq")
    assert [(r["seq"], r["cvd"], r["previous_price"]) for r in kept] == [(0, 5, None), (1, 1, None), (2, 2, 1), (3, 6, 1)]
    assert [(r["seq"], r["cvd"], r["previous_price"]) for r in gone] == [(0, 5, None), (1, 1, None), (2, 2, 1), (3, 1, None)]


def tick_feeds(spark):
    deals = trades(spark, [r for r in random_trades(300, span=89, hot=0.6) if r[3] > 0 and r[1] < 90])
    shown = spark.createDataFrame(
        [(s, at(t), 1000 + i, 100.0 + i, 5.0, 120.0, 80.0, 99.0, None if i % 3 == 0 else 99.0, 101.0)
         for i, (s, t) in enumerate([("H", 3.0), ("A", 4.5), ("H", 30.2), ("B", 40.0), ("H", 61.7), ("A", 88.0)])],
        "symbol string, ts timestamp, seq long, price double, volume_24h double, high_24h double, low_24h double, "
        "open_24h double, best_bid double, best_ask double")
    changes = spark.createDataFrame(
        [("H", at(5.0 + i * 0.9), 2000 + i, 0, "snapshot" if i == 40 else "l2update", "buy" if i % 2 else "sell",
          99.0 - i % 7 if i % 2 else 101.0 + i % 5, float(i % 4)) for i in range(80)],
        "symbol string, ts timestamp, seq long, part int, kind string, side string, price double, size double")
    return deals, shown, changes


def test_streaming_ticks_equal_batch_ticks_by_the_second(spark):
    feeds = tick_feeds(spark)
    want = as_dicts(tick_plan.ticks(*feeds), "symbol", "timestamp")
    streams = [stream_of(spark, df, files=1) for df in feeds]
    got = as_dicts(drain(ST.streaming_ticks(*streams, lateness="0 seconds"))[0], "symbol", "timestamp")
    # the stream cannot fill seconds after the last message of a symbol, nor close the newest ones
    keys = {(r["symbol"], r["timestamp"]) for r in got}
    assert len(keys) == len(got) > 150
    equal(got, [r for r in want if (r["symbol"], r["timestamp"]) in keys])
    assert len(want) - len(got) < 15
    assert list(want[0]) == [f.name for f in tick_plan.TICK_SCHEMA]


def test_streaming_ticks_carry_their_state_over_micro_batches(spark):
    feeds = tick_feeds(spark)
    changes = feeds[2].unionByName(spark.createDataFrame(  # a change without a price names no level
        [("H", at(20.05), 5000, 0, "l2update", "buy", None, 3.0)], feeds[2].schema))
    want = as_dicts(tick_plan.ticks(*feeds), "symbol", "timestamp")
    streams = [stream_of(spark, df, files=3) for df in (*feeds[:2], changes)]
    rows, query = drain(ST.streaming_ticks(*streams, lateness="30 seconds"))
    got = as_dicts(rows, "symbol", "timestamp")
    keys = {(r["symbol"], r["timestamp"]) for r in got}
    assert sum(p.stateOperators[0].numRowsUpdated > 0 for p in query.recentProgress) > 1
    assert len(keys) == len(got) > 80 and dropped_late(query) == 0
    for r in want:  # the order flow does count it
        r["ofi_1s"] += 3.0 * (r["symbol"] == "H" and r["timestamp"] == int(at(21).timestamp() * 1000))
    equal(got, [r for r in want if (r["symbol"], r["timestamp"]) in keys])


def test_one_tick_by_hand(spark):
    """One second by hand: book quotes, depth, flow, impact, health with volatility 0 read as 1."""
    deals = trades(spark, [("X", 0.2, 1, 100.0, 2.0, "buy"), ("X", 0.6, 2, 104.0, 1.0, "sell")])
    shown = spark.createDataFrame([("X", at(0.1), 0, 90.0, 7.0, 120.0, 80.0, 80.0, 1.0, 2.0)],
                                  "symbol string, ts timestamp, seq long, price double, volume_24h double, high_24h double, "
                                  "low_24h double, open_24h double, best_bid double, best_ask double")
    changes = spark.createDataFrame(
        [("X", at(0.3), 3, "l2update", "buy", 99.0, 3.0), ("X", at(0.4), 4, "l2update", "sell", 101.0, 5.0),
         ("X", at(0.5), 5, "l2update", "buy", 97.0, 9.0)],
        "symbol string, ts timestamp, seq long, kind string, side string, price double, size double")
    row = tick_plan.ticks(deals, shown, changes).first()
    assert (row.price, row.price_change_24h, row.price_change_percent_24h) == (104, 24, 30)
    assert (row.best_bid_1s, row.best_ask_1s, row.mid_price_1s, row.bid_ask_spread_1s) == (99, 101, 100, 2)
    assert (row.bid_depth_2pct_1s, row.ask_depth_2pct_1s, row.depth_2pct_1s) == (3, 5, 8)
    assert (row.buy_volume_1s, row.sell_volume_1s, row.volume_1s, row.buy_sell_ratio) == (2, 1, 3, 2)
    assert row.vwap_1s == pytest.approx(304 / 3) and row.micro_price_deviation_1s == 2
    assert (row.cvd_1s, row.ofi_1s, row.kyles_lambda_1s) == (1, 7, -4)
    assert (row.price_change_1s, row.high_1s, row.liquidity_health_1s) == (0, 104, 4)


def test_stale_watch_counts_three_strikes(spark):
    feed = trades(spark, [("X", t, i, 1.0, 1.0, "buy") for i, t in enumerate([0, 5, 12, 100, 101, 150.5])])
    messages = stream_of(spark, feed.select(F.col("symbol").alias("component"), "ts", "seq"), files=3)
    rows = as_dicts(drain(A.stale_checks(messages))[0], "check_ms")
    base = int(at(0).timestamp() * 1000)
    assert [((r["check_ms"] - base) / 1000, r["strike"], r["restart"]) for r in rows] == [
        (50, 1, False), (60, 2, False), (70, 3, True), (140, 1, False), (150, 2, False)]


def test_cooldown_across_batches(spark):
    feed = spark.createDataFrame([("a", at(t), i) for i, t in enumerate([0, 100, 299, 300, 500, 599, 600, 901])],
                                 "alert_key string, ts timestamp, seq long")
    rows = drain(A.streaming_cooldown(stream_of(spark, feed)))[0]
    assert sorted(r.seq for r in rows.collect()) == [0, 3, 6, 7]


def test_dedupe_across_batches(spark):
    feed = trades(spark, random_trades(40))
    twice = feed.unionByName(feed)
    stream = stream_of(spark, twice, files=5)
    rows, _ = drain(A.streaming_dedupe(stream, ["symbol", "seq", "price"]).select("symbol", "seq"))
    assert rows.count() == 40 == rows.distinct().count()


def test_chained_topics_end_in_the_bar_table(spark, tmp_path):
    """Ticks topic -> bars topic -> hour folders: three queries, each with its own checkpoint."""
    feed = trades(spark, [("X", i, i, 100.0 + i % 7, 1.0, "buy") for i in range(900)])
    topics.publish(feed.orderBy("seq").coalesce(1), format="text", path=str(tmp_path / "ticks"))
    ticks = topics.decoded(topics.read_topic(spark, "text", str(tmp_path / "ticks")), feed.schema)
    query = topics.write_topic(SB.streaming_bars(ticks), str(tmp_path / "c1"), "text", str(tmp_path / "bars"), available_now=True)
    query.awaitTermination()
    schema = B.bars(feed).schema
    landed = topics.decoded(topics.read_topic(spark, "text", str(tmp_path / "bars")), schema).select(*schema.names)
    tables.stream_bars(landed, str(tmp_path / "table"), str(tmp_path / "c2"), available_now=True).awaitTermination()
    got = as_dicts(tables.bar_table(spark, str(tmp_path / "table")).drop(*tables.FOLDERS), "window_start")
    want = as_dicts(B.bars(feed), "window_start")[:9]  # 15 minutes of ticks, 5 of lateness, the last one open
    equal(got, want)
    # a restart from the checkpoint finds nothing new and writes nothing twice
    tables.stream_bars(landed, str(tmp_path / "table"), str(tmp_path / "c2"), available_now=True).awaitTermination()
    assert tables.bar_table(spark, str(tmp_path / "table")).count() == len(want)
