"""Every registered query against its SQL in DuckDB."""

import os

import pytest
from compare import connect, duckdb_result, spark_result

import __spark_entry__ as entry_points
from tallyframe import plans

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")

NO_SQL = {"layout_bytes"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_sql(spark, con, name):
    columns, rows = spark_result(entry_points.queries()[name](spark, FOLDER))
    assert (columns, rows) == duckdb_result(con, entry_points.oracle_sql()[name])
    assert rows


DATE_QUERIES = [
    "cumulative_history", "history_ratio", "unnest_history", "cumulative_scalar", "cumulative_grouped", "scd2_build",
    "scd2_build_as_written", "scd2_merge", "scd2_merge_as_written",
    "user_active_dates", "event_type_dates", "user_segment_dates", "datelist_int", "datelist_int_as_written",
    "datelist_words", "activity_flags", "activity_flags_as_written", "snapshot_table", "snapshot_state",
    "monthly_reduced", "monthly_upsert", "monthly_metric", "array_lengths", "monthly_unpacked",
    "monthly_unpacked_as_written",
]


@pytest.fixture(scope="module")
def later_dates(spark, tmp_path_factory):
    """The tables with many odd events put off by 45 days, into a third month, and odd orders by three years.

    Some users are active in one month only.
    """
    folder = str(tmp_path_factory.mktemp("later_dates"))
    for name in os.listdir(FOLDER):
        if name not in ("events.parquet", "orders.parquet"):
            os.symlink(f"{FOLDER}/{name}", f"{folder}/{name}")
    late = "CASE WHEN event_id % 2 = 1 AND user_id % 3 > 0 THEN ts + INTERVAL 45 DAY ELSE ts END"
    connect(FOLDER).execute(
        "COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate + INTERVAL 3 YEAR ELSE o_orderdate END"
        f" AS o_orderdate) FROM orders) TO '{folder}/orders.parquet' (FORMAT parquet)"
    )
    connect(FOLDER).execute(
        f"COPY (SELECT * REPLACE ({late} AS ts) FROM events WHERE user_id % 5 > 0 OR event_id % 2 = 1)"
        f" TO '{folder}/events.parquet' (FORMAT parquet)"
    )
    return folder


@pytest.mark.parametrize("name", DATE_QUERIES)
def test_bounds_come_from_the_data(spark, later_dates, name):
    found = spark_result(entry_points.queries()[name](spark, later_dates))
    assert found == duckdb_result(connect(later_dates), entry_points.oracle_sql()[name])
    assert found[1]


def test_queries_without_sql(spark):
    assert set(plans.QUERIES) - set(plans.ORACLES) == NO_SQL
    report = plans.QUERIES["layout_bytes"](spark, FOLDER).collect()
    assert {r.layout for r in report} == {"playlist_sorted_first", "mapid_sorted_first"}
    assert all(r.bytes > 0 and r.files > 0 for r in report)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
