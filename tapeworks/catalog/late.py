"""Queries: late ticks kept, and the bars they repair."""

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.aggregates import DOUBLES, PLAIN
from tapeworks.catalog.registry import query
from tapeworks.functions.timecols import HOUR, MINUTE, micros
from tapeworks.session import work_folder
from tapeworks.sources import tables
from tapeworks.streaming import late

LATENESS = 5 * MINUTE
SHIFTED = 23 * HOUR  # every other tick arrives as if it were so much younger, every seventh in the last batch


def repaired(spark, folder):
    """Hour bars of the feed in four micro-batches, many ticks of which come after their bars were closed."""
    root, landed = work_folder(spark, "repair"), work_folder(spark, "ticks")
    rows = V.as_ticks(V.feed(V.load(spark, folder, "events")))
    us = micros(F.col("ts"))
    low, high = rows.agg(F.min(us), F.max(us)).first()
    shown = F.when(F.col("seq") % 2 == 0, us + SHIFTED).otherwise(us)
    batch = F.least(F.lit(3), F.floor((shown - (low or 0)) * 4 / ((high or 0) - (low or 0) + 1)))
    batch = F.when(F.col("seq") % 7 == 0, 3).otherwise(batch)
    for number in range(4):  # the query goes on from its checkpoint with what has landed since
        rows.filter(batch == number).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(rows.schema).parquet(landed)
        late.repairing_bars(stream, root, HOUR, 10 * MINUTE, LATENESS, None, available_now=True).awaitTermination()
    return root


@query("t08_repair", V.sql(V.HOUR_BARS, DOUBLES, PLAIN, "bars",
                           f"WHERE window_end * 1000 <= (SELECT max(us) FROM ticks) - {LATENESS}"))
def t08_repair(spark, folder):
    """After all batches the bars are those of all ticks, though the watermark had passed many."""
    return V.rounded(tables.bar_table(spark, f"{repaired(spark, folder)}/bars").drop(*tables.FOLDERS))


@query("t08_side", f"""WITH {V.SQL_FEED},
ends AS (SELECT min(us) AS low, max(us) AS high FROM feed),
dealt AS (SELECT symbol, us, seq, CASE WHEN seq % 7 = 0 THEN 3 ELSE
            least(3, (us + CASE WHEN seq % 2 = 0 THEN {SHIFTED} ELSE 0 END - low) * 4 // (high - low + 1)) END AS batch
          FROM feed, ends),
marks AS (SELECT batch + 1 AS batch, max(max(us)) OVER (ORDER BY batch) - {LATENESS} AS mark FROM dealt GROUP BY batch)
SELECT symbol, us, seq, batch FROM dealt JOIN marks USING (batch) WHERE us - us % {HOUR} + {HOUR} <= mark""")
def t08_side(spark, folder):
    """The side table: which ticks came after their bar was closed, and in which batch."""
    kept = late.late_ticks(spark, repaired(spark, folder))
    return V.with_us(kept).select("symbol", "us", "seq", F.col("batch").cast("long").alias("batch"))
