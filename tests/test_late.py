import random

import pytest
from helpers import as_dicts, at, random_trades, trades
from pyspark.sql import functions as F
from test_streaming import equal

from tapeworks.functions.timecols import HOUR, MINUTE, SECOND
from tapeworks.operators import bars as B
from tapeworks.session import work_folder
from tapeworks.sources import tables
from tapeworks.streaming import late


def feed_of(spark, rows):
    return trades(spark, rows).withColumn("volume_1s", F.col("size"))


def run(spark, root, batches, **options):
    """One run of the query per batch; each goes on from the checkpoint."""
    landed = work_folder(spark, "landed")
    for rows in batches:
        df = feed_of(spark, rows)
        df.coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(df.schema).parquet(landed)
        late.repairing_bars(stream, root, available_now=True, **options).awaitTermination()


def stored(spark, root):
    return as_dicts(tables.bar_table(spark, f"{root}/bars").drop(*tables.FOLDERS), "symbol", "window_start")


def test_partials_merge_whichever_way_ticks_were_dealt(spark):
    rows = random_trades(300, span=3000, seed=3)
    parts = [[r for r in rows if r[2] % 3 == k] for k in range(3)]
    dealt = None
    for part in parts:
        made = late.partials(feed_of(spark, part), 10 * SECOND)
        dealt = made if dealt is None else dealt.unionByName(made)
    want = B.bars(feed_of(spark, rows), MINUTE)
    equal(as_dicts(late.bars_from(dealt), "symbol", "window_start"), as_dicts(want, "symbol", "window_start"))


def test_bars_after_repair_equal_batch_bars_of_all_ticks(spark):
    width, sub = HOUR, 10 * MINUTE
    rows = sorted(random_trades(400, span=30_000, seed=5), key=lambda r: r[1])
    rnd = random.Random(2)
    batches = [[], [], []]
    for i, row in enumerate(rows):
        batches[2 if rnd.random() < 0.2 else min(2, i * 3 // len(rows))].append(row)
    root = work_folder(spark, "repair")
    run(spark, root, batches, width_us=width, sub_us=sub)
    last = max(r[1] for r in rows) - 300
    want = B.bars(feed_of(spark, rows), width).filter(F.col("window_end") <= at(last).timestamp() * 1000)
    equal(stored(spark, root), as_dicts(want, "symbol", "window_start"))
    kept = late.late_ticks(spark, root)
    assert kept.count() > 20 and kept.filter("NOT repaired").count() == 0 and kept.filter("batch = 0").count() == 0


def test_ticks_later_than_what_is_held_stay_in_the_side_table_only(spark):
    first = [("X", t, i, 100.0 + i, 1.0, "buy") for i, t in enumerate((0, 10, 7200, 40_000))]
    second = [("X", 20, 10, 500.0, 1.0, "buy"), ("X", 36_010, 11, 90.0, 1.0, "buy"), ("X", 40_100, 12, 1.0, 1.0, "buy")]
    third = [("X", 30, 20, 600.0, 1.0, "buy"), ("X", 50_000, 21, 2.0, 1.0, "buy")]
    root = work_folder(spark, "repair")
    run(spark, root, [first, second, third], keep_us=2 * HOUR)
    sides = {(r.seq, r.batch, r.repaired) for r in late.late_ticks(spark, root).collect()}
    assert sides == {(10, 1, False), (11, 1, True), (20, 2, False)}
    bars = stored(spark, root)
    assert [(b["num_ticks"], b["high"]) for b in bars] == [(2, 101.0), (1, 102.0), (1, 90.0), (1, 103.0), (1, 1.0)]


def test_a_batch_that_runs_again_changes_nothing(spark, monkeypatch):
    rows = sorted(random_trades(200, span=9000, seed=8), key=lambda r: r[1])
    early, rest = rows[:150:2] + rows[150:], rows[1:150:2]
    root, landed = work_folder(spark, "repair"), work_folder(spark, "landed")
    merge, failing = late.merge_bars, [False]

    def broken(session, where, made):
        merge(session, where, made)
        if failing[0]:
            raise RuntimeError("lost after the bars were written")

    monkeypatch.setattr(late, "merge_bars", broken)
    for part in (early, rest):
        df = feed_of(spark, part)
        df.coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(df.schema).parquet(landed)
        failing[0] = part is rest
        if failing[0]:
            with pytest.raises(Exception, match="lost after"):
                late.repairing_bars(stream, root, available_now=True).awaitTermination()
            failing[0] = False
        late.repairing_bars(stream, root, available_now=True).awaitTermination()
    last = at(max(r[1] for r in rows) - 300).timestamp() * 1000
    want = B.bars(feed_of(spark, rows), MINUTE).filter(F.col("window_end") <= last)
    equal(stored(spark, root), as_dicts(want, "symbol", "window_start"))
    assert late.late_ticks(spark, root).groupBy("seq").count().filter("count > 1").count() == 0


def test_no_rows_missing_times_and_pieces_that_do_not_fit(spark):
    root = work_folder(spark, "repair")
    run(spark, root, [[]])
    assert late.late_ticks(spark, root) is None
    none = feed_of(spark, [("X", 0, 0, 1.0, 1.0, "buy")]).withColumn("ts", F.lit(None).cast("timestamp"))
    assert late.partials(none).count() == 0
    with pytest.raises(ValueError):
        late.repairing_bars(none, root, width_us=MINUTE, sub_us=7 * SECOND)
