"""Queries: decoding the raw feed, and the bar table written and read back."""

import datetime as dt

from pyspark.sql import functions as F

from tapeworks.catalog import views as V
from tapeworks.catalog.aggregates import DOUBLES, PLAIN, hour_bars
from tapeworks.catalog.registry import query
from tapeworks.functions.timecols import MINUTE, micros
from tapeworks.operators.bars import bars
from tapeworks.plans import batch_layer
from tapeworks.schemas import RAW_SCHEMA
from tapeworks.session import store, work_folder
from tapeworks.sources import decode, tables, topics
from tapeworks.streaming.drain import drain

UTC = dt.timezone.utc


def raw(spark, folder):
    return V.raw_messages(V.events_feed(spark, folder))


SQL_DECODED = V.SQL_FEED + """,
decoded AS (
  SELECT symbol, us, seq, 'match' AS kind, CASE WHEN event_type = 'purchase' THEN 'buy' ELSE 'sell' END AS side,
         value + 100 AS price, k::DOUBLE AS size FROM feed WHERE event_type IN ('purchase', 'click')
  UNION ALL SELECT symbol, us, seq, 'ticker', NULL, value + 100, NULL FROM feed WHERE event_type = 'view'
  UNION ALL SELECT symbol, us, seq, 'l2update', CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END,
         100.0 + k % 40, value FROM feed WHERE event_type = 'signup')"""


@query("s03_decode", V.sql(SQL_DECODED, "price size", "symbol us seq kind side", "decoded"))
def s03(spark, folder):
    feed = decode.messages(raw(spark, folder))
    columns = ["symbol", "ts", "seq", "kind", "side", "price", "size"]
    matches = decode.trades(feed).withColumn("kind", F.lit("match")).select(*columns)
    shown = decode.tickers(feed).select("symbol", "ts", "seq", F.lit("ticker").alias("kind"), "price")
    levels = decode.book_changes(feed).select(*columns)
    whole = matches.unionByName(shown, allowMissingColumns=True).unionByName(levels)
    return V.rounded(V.with_us(whole))


SQL_TICKER_TICKS = V.SQL_FEED + """,
ticks AS (SELECT symbol, us, seq, value + 100 AS price, k::DOUBLE AS volume_1s, 1 AS trade_count_1s,
                 value * 10 AS volume_24h, value + 105 AS high_24h, value + 95 AS low_24h,
                 0.0::DOUBLE AS vwap_1s, 0.0::DOUBLE AS cvd_1s FROM feed WHERE event_type = 'view')"""


@query("s04_ticker_tick", V.sql(
    SQL_TICKER_TICKS, "price volume_1s volume_24h high_24h low_24h vwap_1s cvd_1s", "symbol us seq trade_count_1s", "ticks"))
def s04(spark, folder):
    made = decode.ticker_ticks(decode.messages(raw(spark, folder)))
    columns = "symbol ts seq trade_count_1s price volume_1s volume_24h high_24h low_24h vwap_1s cvd_1s"
    return V.rounded(V.with_us(made.select(*columns.split())))


def written(spark, folder, made=None) -> str:
    """A fresh table of the hour bars (or of ``made``), one folder per hour."""
    root = work_folder(spark, "bars")
    tables.write_bars(hour_bars(spark, folder) if made is None else made, root)
    return root


@query("s05_sink_roundtrip", f"""WITH {V.HOUR_BARS}
SELECT {', '.join(PLAIN.split())}, {', '.join(f'round({c} + 1.3e-9, 6) + 0.0 AS {c}' for c in DOUBLES.split())},
       window_start_est[1:4] AS year, window_start_est[6:7] AS month, window_start_est[9:10] AS day,
       window_start_est[12:13] AS hour FROM bars""")
def s05(spark, folder):
    return V.rounded(tables.bar_table(spark, written(spark, folder)))


@query("s06_batch_roundtrip", f"""WITH {SQL_TICKER_TICKS},
grouped AS (SELECT symbol, us - us % {MINUTE} AS bar, arg_min(price, (us, seq)) AS open, max(price) AS high,
                   min(price) AS low, arg_max(price, (us, seq)) AS close, sum(volume_1s) AS total_volume_1m,
                   count(*) AS trade_count_1m FROM ticks GROUP BY 1, 2),
bars AS (SELECT *, bar // 1000 AS window_start FROM grouped)
SELECT symbol, window_start, round(open + 1.3e-9, 6) + 0.0 AS open, round(high + 1.3e-9, 6) + 0.0 AS high, round(low + 1.3e-9, 6) + 0.0 AS low,
       round(close + 1.3e-9, 6) + 0.0 AS close, round(total_volume_1m + 1.3e-9, 6) + 0.0 AS total_volume_1m, trade_count_1m FROM bars""")
def s06(spark, folder):
    root = work_folder(spark, "batch")
    tables.write_span(batch_layer.ticker_bars(raw(spark, folder)), root)
    columns = "symbol window_start open high low close total_volume_1m trade_count_1m"
    return V.rounded(tables.bar_table(spark, root).select(*columns.split()))


LOW, HIGH = dt.datetime(2024, 1, 10, 6, 30, tzinfo=UTC), dt.datetime(2024, 1, 11, 6, 30, tzinfo=UTC)


def ms(instant):
    return int(instant.timestamp() * 1000)


@query("s07_pruned", V.sql(V.HOUR_BARS, "open close", "symbol window_start", "bars",
                           f"WHERE window_start BETWEEN {ms(LOW)} AND {ms(HIGH)}"))
def s07(spark, folder):
    span = tables.read_span(spark, written(spark, folder), LOW, HIGH)
    return V.rounded(span.select("symbol", "window_start", "open", "close"))


NOW = dt.datetime(2024, 1, 11, 6, 30, tzinfo=UTC)


@query("s07_full_day", V.sql(V.HOUR_BARS, "open close", "symbol window_start", "bars",
                             f"WHERE window_start BETWEEN {ms(NOW) - 24 * 3600_000 - 1800_000} AND {ms(NOW)}"))
def s07_full(spark, folder):
    day = tables.read_full(spark, written(spark, folder), NOW)
    return V.rounded(day.select("symbol", "window_start", "open", "close"))


def stamp(spark, root, when, known=frozenset()) -> set[str]:
    """Set the file times of what was written below ``root`` since ``known`` was; returns those files."""
    fresh = {f.path for f in tables.list_files(spark, root)} - known
    for path in fresh:
        files, where = store(spark, path)
        files.setTimes(where, ms(when), -1)
    return fresh


HOUR_SPAN = dt.timedelta(hours=1)


# the load before was five hours ago; hours are read whole, with one of slack on both sides
@query("s08_incremental", V.sql(
    V.HOUR_BARS, "open close", "symbol window_start", "bars",
    f"""WHERE window_start BETWEEN {ms(NOW) - 7 * 3600_000 - 1800_000 + 3600_000} AND {ms(NOW) + 5400_000 - 1}
          AND volatility_regime <> 'medium'"""))
def s08(spark, folder):
    """Bars written first must not come back when asked for files written since."""
    made = hour_bars(spark, folder)
    root = written(spark, folder, made.filter("volatility_regime = 'medium'"))
    first = stamp(spark, root, NOW - 10 * HOUR_SPAN)
    tables.write_bars(made.filter("volatility_regime <> 'medium'"), root)
    stamp(spark, root, NOW - 2 * HOUR_SPAN, first)
    fresh = tables.read_incremental(spark, root, NOW, NOW - 5 * HOUR_SPAN)
    return V.rounded(fresh.select("symbol", "window_start", "open", "close"))


@query("s09_newest_n", V.sql(V.HOUR_BARS, "open close", "symbol window_start", "bars",
                             "WHERE symbol = 'S2'"))
def s09(spark, folder):
    """Each symbol in files of its own, one after the other; the newest hold the last symbol."""
    root, made = work_folder(spark, "newest"), hour_bars(spark, folder)
    known, last = set(), set()
    for hour, symbol in enumerate(("S0", "S1", "S2")):
        tables.write_bars(made.filter(F.col("symbol") == symbol), root)
        last = stamp(spark, root, NOW + hour * HOUR_SPAN, known)
        known |= last
    return V.rounded(tables.read_newest(spark, root, len(last)).select("symbol", "window_start", "open", "close"))


@query("s09_newest_of_day", V.sql(V.HOUR_BARS, "open close", "symbol window_start", "bars",
                                  f"WHERE symbol = 'S2' AND window_start BETWEEN {ms(NOW) - 24 * 3600_000 - 1800_000} AND {ms(NOW)}"))
def s09_day(spark, folder):
    """The cap on files on top of the full read: of the day's folders, the files written last."""
    root, made = work_folder(spark, "newest"), hour_bars(spark, folder)
    tables.write_bars(made.filter("symbol <> 'S2'"), root)
    first = stamp(spark, root, NOW)
    tables.write_bars(made.filter("symbol = 'S2'"), root)
    stamp(spark, root, NOW + HOUR_SPAN, first)
    hours = {tables.folder_path("", tables._folder(NOW - h * HOUR_SPAN)) for h in range(25)}
    fresh = [f for f in tables.list_files(spark, root) if f.path not in first and any(h in f.path for h in hours)]
    return V.rounded(tables.read_full(spark, root, NOW, files=len(fresh)).select("symbol", "window_start", "open", "close"))


@query("s10_skip_bad", V.sql(V.HOUR_BARS, "open close", "symbol window_start", "bars"))
def s10(spark, folder):
    root = written(spark, folder)
    junk = V.load(spark, folder, "events").select("props")
    junk.write.mode("append").text(f"{root}/year=2024/month=01/day=05/hour=05")
    return V.rounded(tables.bar_table(spark, root, skip_damaged=True).select("symbol", "window_start", "open", "close"))


@query("s11_quarantine", """
SELECT 'feed' AS topic, count(*) FILTER (event_type <> 'error') AS good,
       count(*) FILTER (event_type = 'error') AS bad FROM events""")
def s11(spark, folder):
    return decode.quarantine_counts(decode.parse(raw(spark, folder), RAW_SCHEMA))


@query("s11_reasons", """
SELECT 'feed' AS topic, CASE WHEN event_type = 'error' THEN 'unreadable' WHEN event_type = 'signup' THEN 'no time'
       WHEN user_id % 2 = 0 THEN 'no symbol' ELSE 'no price' END AS reason, count(*) AS records
FROM events WHERE event_type IN ('error', 'signup', 'purchase') GROUP BY ALL""")
def s11_reasons(spark, folder):
    """The feed with fields taken out: the time of updates, symbol or price of some matches."""
    fed = V.events_feed(spark, folder)
    kind, even = F.col("event_type"), F.col("user_id") % 2 == 0
    text = V.raw_messages(fed.withColumns({
        "ts": F.when(kind != "signup", F.col("ts")),
        "symbol": F.when((kind != "purchase") | ~even, F.col("symbol")),
        "value": F.when((kind != "purchase") | even, F.col("value")),
    }))
    return decode.quarantine_reasons(decode.parse(text, RAW_SCHEMA))


# the first folder is taken away, the last one is left with an empty file
@query("s12_validate", f"""WITH {V.HOUR_BARS}, f AS (
SELECT window_start_est[1:4] AS year, window_start_est[6:7] AS month, window_start_est[9:10] AS day,
       window_start_est[12:13] AS hour, count(*) AS n FROM bars GROUP BY ALL),
r AS (SELECT *, row_number() OVER (ORDER BY year, month, day, hour) AS up,
             row_number() OVER (ORDER BY year DESC, month DESC, day DESC, hour DESC) AS down FROM f)
SELECT year, month, day, hour, CASE WHEN up = 1 THEN 0 ELSE 1 END AS files, CASE WHEN up = 1 OR down = 1 THEN 0 ELSE n END AS rows,
       CASE WHEN up = 1 THEN 'missing' WHEN down = 1 THEN 'empty' ELSE 'ok' END AS status FROM r""")
def s12(spark, folder):
    root, made = written(spark, folder), hour_bars(spark, folder)
    held = sorted({f.path.rsplit("/", 1)[0] for f in tables.list_files(spark, root)})
    for place in (held[0], held[-1]):
        files, where = store(spark, place)
        files.delete(where, True)
    files, where = store(spark, f"{held[-1]}/part-00000.parquet")
    files.create(where, True).close()
    return tables.validate(spark, root, made).drop("newest_size")


@query("s02_topic_sink", f"""WITH {V.SQL_TRADES}
SELECT symbol AS key, us, seq, round(price + 1.3e-9, 6) + 0.0 AS price FROM trades""")
def s02(spark, folder):
    """Rows to (key, value) records, then the values parsed again."""
    sent = topics.as_records(V.trades(spark, folder))
    schema = "symbol string, ts timestamp, seq long, price double, size double, side string"
    back = sent.select("key", F.from_json("value", schema).alias("row"))
    return V.rounded(back.select("key", micros(F.col("row.ts")).alias("us"), "row.seq", "row.price"))


@query("s01_topic_source", V.sql(SQL_DECODED.replace("decoded AS", "whole AS") + """,
decoded AS (SELECT * FROM whole WHERE kind = 'match')""", "price size", "symbol us seq side", "decoded"))
def s01(spark, folder):
    """Raw messages landed as text files, read back as a stream, decoded and drained."""
    landed = work_folder(spark, "topic")
    raw(spark, folder).select("value").write.text(landed)
    feed = topics.read_topic(spark, format="text", path=landed)
    rows, _ = drain(V.with_us(decode.trades(decode.messages(feed))))
    return V.rounded(rows)


@query("s13_merge_table", f"""WITH {V.HOUR_BARS}
SELECT symbol, window_start, round(close + 1.3e-9, 6) + 0.0 AS close FROM bars""")
def s13(spark, folder):
    """Upsert twice into the table on disk: late half first, then everything, no row doubled."""
    root, made = work_folder(spark, "merge"), hour_bars(spark, folder)
    tables.merge_bars(spark, root, made.filter("symbol <> 'S1'").withColumn("close", F.col("close") + 1))
    tables.merge_bars(spark, root, made)
    return V.rounded(tables.bar_table(spark, root).select("symbol", "window_start", "close"))
