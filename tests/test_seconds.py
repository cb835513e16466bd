"""Queries by the second against the SQL of their coarser twins with its steps set to a second, on a short feed."""

import re

import duckdb
import pytest
from oracle import compare

import __spark_entry__ as entry
from tapeworks.catalog.streams import SPANS, streamed_ticks_sql
from tapeworks.functions.timecols import DAY, MINUTE, SECOND
from tapeworks.operators.horizons import HORIZONS

FOLDER = "/root/testdata/sf0.001"
STEPS = {"j2_grid": {MINUTE: SECOND}, "t03_ticks": {
    SPANS["1s"]: SECOND, **{SPANS[name] - 1: width - 1 for name, width in HORIZONS.items()},
}}
NAMES = ["a15_depth", "a17_top", "j2_grid", "j3_depth_filter", "k1_levels", "t02_book", "t03_ticks"]


@pytest.fixture(scope="module")
def short(tmp_path_factory):
    """The events of 30 days within 72 minutes."""
    folder = tmp_path_factory.mktemp("short")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"""COPY (SELECT * REPLACE (make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 600) AS ts)
                    FROM '{FOLDER}/events.parquet') TO '{folder}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", NAMES)
def test_seconds_equal_sql_at_seconds(spark, short, name):
    folder, con = short
    steps = STEPS.get(name, {DAY: SECOND})
    sql = re.sub(r"\d+", lambda m: str(steps.get(int(m[0]), m[0])), entry.oracle_sql()[name])
    assert sql != entry.oracle_sql()[name]
    assert compare(entry.queries()[f"{name}_seconds"](spark, folder), sql, con) == []


def test_the_stream_of_ticks_comes_by_the_second(spark, tmp_path):
    """It used to come by the hour. 500 messages in 25 minutes, with 9 minutes of silence among them."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"""COPY (SELECT i AS event_id, make_timestamp(1704067200250000 + i * 1900000 + CASE WHEN i > 250 THEN 540000000 ELSE 0 END) AS ts,
                           i * 7 % 11 AS user_id, ['view', 'click', 'purchase', 'signup', 'error'][1 + i * 3 % 7 % 5] AS event_type,
                           0.5 + i * 37 % 97 AS value, '{{"k": ' || i * 13 % 90 || '}}' AS props
                    FROM (SELECT range::BIGINT AS i FROM range(500))) TO '{tmp_path}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    made = entry.queries()["t03_ticks_stream"](spark, str(tmp_path))
    assert made.count() > 3000
    assert compare(made, streamed_ticks_sql(SECOND, HORIZONS), con) == []
