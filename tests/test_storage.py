import datetime as dt
import os
import time

import pytest
from helpers import UTC, as_dicts, at, trades
from pyspark.sql import functions as F

from tapeworks.operators.bars import bars
from tapeworks.plans import batch_layer
from tapeworks.schemas import RAW_SCHEMA
from tapeworks.session import work_folder
from tapeworks.sources import decode, tables, topics
from tapeworks.streaming.drain import drain
from tapeworks.streaming.upsert import upsert_stream

MIN = 60


def made(spark, minutes, price=100.0, symbol="X"):
    return bars(trades(spark, [(symbol, m * MIN, m, price, 1.0, "buy") for m in minutes]))


def starts(df):
    return sorted((r.window_start // 1000 - int(at(0).timestamp())) // MIN for r in df.collect())


def folders(root):
    return sorted(os.path.relpath(d, root) for d, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files))


def test_folders_follow_the_window_in_eastern_time(spark):
    root = work_folder(spark, "t")
    tables.write_bars(made(spark, [0, 59, 60, 12 * 60]), root)
    day = "year=2024/month=03/day=01/hour="
    assert folders(root) == [day + "07", day + "08", day + "19"]
    assert tables.bar_table(spark, root).count() == 4
    assert dict(tables.bar_table(spark, root).dtypes)["hour"] == "string"


def test_span_read_prunes_folders(spark):
    root = work_folder(spark, "t")
    tables.write_bars(made(spark, range(0, 48 * 60, 60)), root)
    span = tables.read_span(spark, root, at(600 * MIN), at(700 * MIN))
    assert starts(span) == [600, 660]
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat(year" in plan and "PushedFilters: [IsNotNull(window_start)" in plan
    assert len(span.inputFiles()) == 48  # files known; the ones scanned are fewer
    full = tables.read_full(spark, root, at(30 * 60 * MIN))
    assert starts(full) == [m for m in range(6 * 60, 31 * 60, 60)]


def test_span_read_over_the_hour_that_repeats(spark):
    # clocks go back on 2024-11-03 at 06:00 UTC: 01:xx local happens twice
    root = work_folder(spark, "t")
    base = dt.datetime(2024, 11, 3, 4, 0, tzinfo=UTC)
    rows = [("X", base + dt.timedelta(minutes=30 * i), i, 1.0) for i in range(10)]
    tables.write_bars(bars(spark.createDataFrame(rows, "symbol string, ts timestamp, seq long, price double")), root)
    for low in range(9):
        span = tables.read_span(spark, root, base + dt.timedelta(minutes=30 * low), base + dt.timedelta(minutes=30 * low + 30))
        assert span.count() == 2


def test_incremental_and_newest_reads(spark):
    root, now = work_folder(spark, "t"), at(30 * MIN)

    def write(minutes, written):
        known = {f.path for f in tables.list_files(spark, root)}
        tables.write_bars(made(spark, minutes), root)
        for f in tables.list_files(spark, root):
            if f.path not in known:
                os.utime(f.path.removeprefix("file:"), (written.timestamp(), written.timestamp()))

    write([0, 1, 300], at(-3600))
    write([2, 3, 400], at(60))
    assert starts(tables.read_incremental(spark, root, now, at(300))) == [2, 3]
    assert starts(tables.read_incremental(spark, root, now, at(-3400))) == [0, 1, 2, 3]
    write([5], at(120))
    assert starts(tables.read_newest(spark, root, 1)) == [5]
    assert len(starts(tables.read_newest(spark, root, 100))) == 7
    assert tables.read_newest(spark, work_folder(spark, "none")).count() == 0


def test_unreadable_files_are_skipped(spark):
    root = work_folder(spark, "t")
    tables.write_bars(made(spark, [0, 1]), root)
    folder = os.path.join(root, folders(root)[0])
    with open(os.path.join(folder, "part-junk.parquet"), "wb") as f:
        f.write(b"not parquet at all")
    assert starts(tables.bar_table(spark, root, skip_damaged=True)) == [0, 1]
    assert starts(tables.read_span(spark, root, at(0), at(10 * MIN))) == [0, 1]
    with pytest.raises(Exception, match="parquet"):
        tables.bar_table(spark, root).count()


def test_a_damaged_file_fails_merges_and_compaction_and_stays(spark):
    root = work_folder(spark, "t")
    tables.write_bars(made(spark, [0]), root)
    tables.write_bars(made(spark, [1]), root)
    folder = os.path.join(root, folders(root)[0])
    name = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    with open(os.path.join(folder, name), "r+b") as f:
        f.truncate(100)
    for rewrite in (lambda: tables.merge_bars(spark, root, made(spark, [2])), lambda: tables.compact(spark, root, at(0), at(10 * MIN))):
        with pytest.raises(Exception):
            rewrite()
        assert name in os.listdir(folder) and len(starts(tables.bar_table(spark, root, skip_damaged=True))) == 1


def test_retention_at_rest_drops_whole_hours(spark):
    root = work_folder(spark, "t")
    assert tables.expire(spark, root, at(0)) == 0
    tables.write_bars(made(spark, range(0, 30 * 60, 60)), root)
    gone = tables.expire(spark, root, at(30 * 60 * MIN), dt.timedelta(hours=10))
    assert gone == 19 and min(starts(tables.bar_table(spark, root))) == 19 * 60


def test_incremental_read_covers_all_hours_since_the_last_load(spark):
    root, now = work_folder(spark, "t"), at(600 * MIN)
    tables.write_bars(made(spark, range(0, 601, 60)), root)
    for f in tables.list_files(spark, root):
        os.utime(f.path.removeprefix("file:"), (now.timestamp(), now.timestamp()))
    assert starts(tables.read_incremental(spark, root, now, now - dt.timedelta(hours=5))) == list(range(180, 601, 60))
    assert len(starts(tables.read_incremental(spark, root, now, now - dt.timedelta(hours=5), files=3))) == 3
    assert len(starts(tables.read_full(spark, root, now, files=2))) == 2 and len(starts(tables.read_full(spark, root, now))) == 11


def test_merge_is_idempotent_and_touches_its_hours_only(spark):
    root = work_folder(spark, "t")
    tables.merge_bars(spark, root, made(spark, [0, 1, 60]))
    untouched = os.listdir(os.path.join(root, folders(root)[1]))
    for _ in range(2):
        tables.merge_bars(spark, root, made(spark, [1, 2], price=200.0))
    rows = as_dicts(tables.bar_table(spark, root), "window_start")
    assert [r["close"] for r in rows] == [100, 200, 200, 100]
    assert os.listdir(os.path.join(root, folders(root)[1])) == untouched


def test_compaction_leaves_one_file_per_hour(spark):
    root = work_folder(spark, "t")
    for m in (0, 1, 2):
        tables.write_bars(made(spark, [m]), root)
    assert tables.file_report(spark, root).first().files == 3
    tables.compact(spark, root, at(0), at(10 * MIN))
    report = tables.file_report(spark, root).first()
    assert (report.files, report.rows) == (1, 3) and starts(tables.bar_table(spark, root)) == [0, 1, 2]


def test_validation(spark):
    root = work_folder(spark, "t")
    tables.write_bars(made(spark, [0]), root)
    status = {r.hour: r.status for r in tables.validate(spark, root, made(spark, [0, 60])).collect()}
    assert status == {"07": "ok", "08": "missing"}
    folder = os.path.join(root, folders(root)[0])
    with open(os.path.join(folder, "part-zzz.parquet"), "wb"):
        pass
    os.utime(os.path.join(folder, "part-zzz.parquet"), (time.time() + 60, time.time() + 60))
    row = tables.validate(spark, root, made(spark, [0])).first()
    assert (row.status, row.files, row.newest_size, row.rows) == ("empty", 2, 0, 1)


def test_an_empty_span_writes_nothing(spark):
    root = work_folder(spark, "t")
    assert tables.write_span(made(spark, []), root) is False and not os.path.exists(root)


RAW = [
    '{"type":"subscriptions","channels":[]}',
    '{invalid json}',
    '{"type":"snapshot","symbol":"X","ts":"2024-03-01T12:00:00Z","seq":1,"bids":[["99","1"],["98","2"]],"asks":[["101","3"]]}',
    '{"type":"l2update","symbol":"X","ts":"2024-03-01T12:00:01Z","seq":2,"changes":[["buy","99","0"],["sell","102","4"]]}',
    '{"type":"ticker","product_id":"X","ts":"2024-03-01T12:00:02Z","seq":3,"price":"100.5","last_size":"0.25","volume_24h":"9","high_24h":"110","low_24h":"90"}',
    '{"type":"match","symbol":"X","ts":"2024-03-01T12:00:03Z","seq":4,"price":"100","size":"2","side":"buy"}',
    '{"type":"match","symbol":"X","ts":"2024-03-01T12:00:04Z","seq":5,"price":"oops","size":"2","side":"sell"}',
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([("t", r) for r in RAW], "topic string, value string")


def test_decode(raw):
    feed = decode.messages(raw)
    assert [(r["seq"], r["side"], r["price"], r["size"]) for r in as_dicts(decode.book_changes(feed), "seq", "part")] == [
        (1, "buy", 99, 1), (1, "buy", 98, 2), (1, "sell", 101, 3), (2, "buy", 99, 0), (2, "sell", 102, 4)]
    assert [(r["price"], r["size"], r["side"]) for r in as_dicts(decode.trades(feed), "seq")] == [(100, 2, "buy"), (0, 2, "sell")]
    ticker = decode.tickers(feed).first()
    assert (ticker.symbol, ticker.price, ticker.best_bid, ticker.open_24h) == ("X", 100.5, None, 0)
    tick = decode.ticker_ticks(feed).first()
    assert (tick.volume_1s, tick.trade_count_1s, tick.cvd_1s) == (0.25, 1, 0)


def test_quarantine(raw):
    parsed = decode.parse(raw, RAW_SCHEMA)
    row = decode.quarantine_counts(parsed).first()
    assert (row.good, row.bad) == (6, 1)
    odd = [("t", m) for m in (
        '{"type":"match","symbol":"X","price":"1","size":"2"}', '{"type":"match","ts":"2024-03-01T12:00:03Z","price":"1"}',
        '{"type":"ticker","symbol":"X","ts":"never","time":"2024-03-01T12:00:03Z"}', '{"type":"l2update","symbol":"X","time":"2024-03-01T12:00:03Z"}')]
    told = decode.quarantine_reasons(decode.parse(parsed.sparkSession.createDataFrame(odd, "topic string, value string"), RAW_SCHEMA))
    assert {r.reason: r.records for r in told.collect()} == {"no time": 1, "no symbol": 1, "no price": 1}
    good, bad = decode.split_corrupt(parsed)
    assert good.count() == 6 and bad.count() == 1


def test_batch_layer(spark, raw):
    status = batch_layer.run(raw, work_folder(spark, "batch"))
    assert [r.status for r in status.collect()] == ["ok"]
    with pytest.raises(ValueError, match="no bars"):
        batch_layer.run(raw.limit(2), work_folder(spark, "batch"))


def test_messages_as_the_exchange_sends_them(spark):
    ticker = '{"type":"ticker","product_id":"X-Y","time":"2024-03-01T12:00:%02d.5Z","sequence":%d,"price":"%d","last_size":"1"}'
    lines = [("t", ticker % (s, s, 100 + s)) for s in range(5)] + [("t", ticker.replace('"time"', '"tome"') % (1, 1, 1))]
    raw = spark.createDataFrame(lines, "topic string, value string")
    root = work_folder(spark, "batch")
    assert [r.status for r in batch_layer.run(raw, root).collect()] == ["ok"]
    bar = tables.bar_table(spark, root).first()
    assert (bar.symbol, bar.open, bar.close, bar.num_ticks) == ("X-Y", 100, 104, 5)


def test_ticks_without_time_belong_to_no_bar(spark):
    feed = trades(spark, [("X", 0, 0, 1.0, 1.0, "buy")])
    lost = feed.withColumn("ts", F.lit(None).cast("timestamp"))
    assert [r.num_ticks for r in bars(feed.unionByName(lost)).collect()] == [1]


def test_whole_snapshots_and_the_best_of_them(spark):
    sides = ",".join(f'["{p}","1"]' for p in range(1, 81))
    line = '{"type":"snapshot","symbol":"X","ts":"2024-03-01T12:00:00Z","seq":1,"bids":[%s],"asks":[%s]}' % (sides, sides)
    feed = decode.messages(spark.createDataFrame([(line,)], "value string"))
    assert decode.book_changes(feed).count() == 160
    best = [(r.side, r.price) for r in decode.book_changes(feed, 50).collect()]
    assert sorted(p for s, p in best if s == "buy") == list(range(31, 81)) and sorted(p for s, p in best if s == "sell") == list(range(1, 51))


def test_streaming_upsert_with_retention(spark, tmp_path):
    for i, minutes in enumerate(([0, 60], [60, 120], [40 * 60])):
        made(spark, minutes, price=100.0 + i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)
    stream = spark.readStream.schema(made(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    upsert_stream(stream, str(tmp_path / "t"), str(tmp_path / "c"), dt.timedelta(hours=38), available_now=True).awaitTermination()
    rows = as_dicts(tables.bar_table(spark, str(tmp_path / "t")), "window_start")
    assert [r["close"] for r in rows] == [101, 101, 102]


def test_topic_of_files(spark, raw, tmp_path):
    topics.publish(made(spark, [0, 1]), format="text", path=str(tmp_path / "bars"))
    stream = topics.read_topic(spark, format="text", path=str(tmp_path / "bars"))
    schema = bars(trades(spark, [])).schema
    rows, _ = drain(topics.decoded(stream, schema).select(*schema.names))
    assert starts(rows) == [0, 1]
    assert topics.as_records(made(spark, [0])).first().key == "X"
