"""Active days of users and event types; bitmaps; monthly arrays. Table: events."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    active_days,
    activity_flags,
    array_length_histogram,
    build_dates,
    build_months,
    cumulate_dates,
    datelist_int,
    datelist_words,
    days_between,
    enrich_left,
    reduce_monthly,
    unpack_monthly,
)
from ..session import new_path
from ..sources import (
    append_snapshot,
    read_snapshot,
    upsert_partition,
    write_state,
)
from .registry import joined, query, table, text

#: Buckets of the state table; for a large one, as many as it has partitions of a shuffle.
STATE_BUCKETS = 16


def first_and_last(events: DataFrame) -> tuple[dt.date | None, dt.date | None]:
    """The days of the first and the last event. The raw column is compared, and converted once."""
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return tuple(ends.select(F.to_date("first"), F.to_date("last")).first())


def days_of(events: DataFrame) -> tuple[dt.date, dt.date, dt.date]:
    """The first day of the table, the last but one and the last."""
    first, last = first_and_last(events)
    last = last or dt.date(1970, 1, 2)  # no event at all
    before = last - dt.timedelta(days=1)
    return min(first or before, before), before, last


def dates_state(events: DataFrame, keys: list[str], days: tuple[dt.date, dt.date, dt.date] | None = None) -> DataFrame:
    """The state of the day before in bulk, then one step."""
    first, before, last = days or days_of(events)
    prev = build_dates(events, keys, "ts", first, before, "dates_active", "date")
    return cumulate_dates(prev, active_days(events, keys, "ts", last), keys,
                          "dates_active", "date")


def shown(state: DataFrame, keys: list[str]) -> DataFrame:
    return state.select(
        *keys,
        F.size("dates_active").cast("long").alias("n_days"),
        joined("dates_active").alias("dates_active"),
        text("date").alias("date"),
    )


_DATES_SQL = """
WITH days AS (
  SELECT DISTINCT {keys}, CAST(ts AS DATE) AS d FROM {source}
  WHERE ts IS NOT NULL {notnull})
SELECT {keys}, count(*) AS n_days,
       string_agg(CAST(d AS VARCHAR), ';' ORDER BY d) AS dates_active,
       (SELECT CAST(CAST(max(ts) AS DATE) AS VARCHAR) FROM events) AS date
FROM days GROUP BY {keys}
"""


@query(
    "user_active_dates",
    _DATES_SQL.format(keys="user_id", source="events", notnull="AND user_id IS NOT NULL"),
)
def user_active_dates(spark: SparkSession, folder: str) -> DataFrame:
    return shown(dates_state(table(spark, folder, "events"), ["user_id"]), ["user_id"])


@query(
    "event_type_dates",
    _DATES_SQL.format(keys="event_type", source="events", notnull="AND event_type IS NOT NULL"),
)
def event_type_dates(spark: SparkSession, folder: str) -> DataFrame:
    return shown(dates_state(table(spark, folder, "events"), ["event_type"]), ["event_type"])


@query(
    "user_segment_dates",
    _DATES_SQL.format(
        keys="user_id, segment",
        source="""(SELECT user_id, ts, coalesce(c_mktsegment, 'Unknown') AS segment FROM events
          LEFT JOIN customer ON user_id = c_custkey)""",
        notnull="AND user_id IS NOT NULL",
    ),
)
def user_segment_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days by user and segment; the segment comes from a left join with a default.

    Events are reduced to (user, day) before the join, so a busy user joins a row per day.
    """
    events = table(spark, folder, "events")
    segments = (
        table(spark, folder, "customer")
        .select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    )
    keys = ["user_id", "segment"]

    def with_segment(rows: DataFrame) -> DataFrame:
        return enrich_left(rows, segments, "user_id", {"segment": "Unknown"})

    first, before, last = days_of(events)
    prev = build_dates(events, ["user_id"], "ts", first, before, "dates_active", "date")
    today = active_days(events, ["user_id"], "ts", last)
    state = cumulate_dates(
        with_segment(prev), with_segment(today), keys, "dates_active", "date"
    )
    return shown(state, keys)


def bitmap_state(spark: SparkSession, folder: str, anchor_bit: int) -> DataFrame:
    """Every user with the bits of the last day's month; a user without a day in it gets 0."""
    events = table(spark, folder, "events")
    days = days_of(events)
    state, last = dates_state(events, ["user_id"], days), days[2]
    return datelist_int(state, "dates_active", last, last.replace(day=1), last, anchor_bit)


_BITMAP_SQL = """
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events
              WHERE user_id IS NOT NULL AND ts IS NOT NULL),
ends AS (SELECT CAST(max(ts) AS DATE) AS last FROM events),
bits AS (SELECT user_id,
           CAST(sum(CASE WHEN d >= date_trunc('month', last)
                         THEN CAST(1 AS BIGINT) << CAST({anchor} - (last - d) AS BIGINT) ELSE 0 END)
                AS BIGINT) AS datelist_int
         FROM days, ends GROUP BY user_id)
"""
_FLAGS_SQL = """SELECT user_id,
  bit_count(datelist_int & 4294967295) > 0 AS dim_is_monthly_active,
  bit_count(datelist_int & 4261412864) > 0 AS dim_is_weekly_active,
  bit_count(datelist_int & 2147483648) > 0 AS dim_is_daily_active
FROM bits"""


@query("datelist_int", _BITMAP_SQL.format(anchor=31) + "SELECT user_id, datelist_int FROM bits")
def user_datelist_int(spark: SparkSession, folder: str) -> DataFrame:
    return bitmap_state(spark, folder, 31).select("user_id", "datelist_int")


@query(
    "datelist_int_as_written",
    _BITMAP_SQL.format(anchor=32) + "SELECT user_id, datelist_int FROM bits",
)
def user_datelist_int_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return bitmap_state(spark, folder, 32).select("user_id", "datelist_int")


@query(
    "datelist_words",
    """
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE user_id IS NOT NULL),
ends AS (SELECT min(d) AS first, max(d) AS last FROM days),
placed AS (SELECT user_id, last - d AS ago FROM days, ends),
words AS (SELECT user_id, k, sum(CASE WHEN ago // 8 = k THEN CAST(1 AS BIGINT) << CAST(7 - ago % 8 AS BIGINT) ELSE 0 END) AS word
          FROM placed, (SELECT unnest(range((last - first) // 8 + 1)) AS k FROM ends) GROUP BY ALL)
SELECT user_id, string_agg(CAST(word AS VARCHAR), ';' ORDER BY k) AS datelist_words FROM words GROUP BY user_id
""",
)
def user_datelist_words(spark: SparkSession, folder: str) -> DataFrame:
    """All days of the table in words of eight days: more words than one for a month already."""
    events = table(spark, folder, "events")
    first, last = first_and_last(events)
    state = build_dates(events, ["user_id"], "ts", first, last, "dates_active", "date")
    words = datelist_words(state, "dates_active", last, first, width=8)
    return words.select("user_id", joined("datelist_words").alias("datelist_words"))


def flags(state: DataFrame) -> DataFrame:
    return activity_flags(state).drop("dates_active", "date", "datelist_int")


@query("activity_flags", _BITMAP_SQL.format(anchor=31) + _FLAGS_SQL)
def user_activity_flags(spark: SparkSession, folder: str) -> DataFrame:
    return flags(bitmap_state(spark, folder, 31))


@query("activity_flags_as_written", _BITMAP_SQL.format(anchor=32) + _FLAGS_SQL)
def user_activity_flags_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return flags(bitmap_state(spark, folder, 32))


@query(
    "snapshot_table",
    _DATES_SQL.format(keys="user_id", source="events", notnull="AND user_id IS NOT NULL"),
)
def snapshot_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same state through a table: yesterday's snapshot is read, today's is appended."""
    events = table(spark, folder, "events")
    path = new_path(spark, "user_dates")
    keys = ["user_id"]
    first, before, last = days_of(events)
    append_snapshot(
        build_dates(events, keys, "ts", first, before, "dates_active", "date"), path, "date"
    )
    prev = read_snapshot(spark, path, "date", before)
    today = active_days(events, keys, "ts", last)
    append_snapshot(cumulate_dates(prev, today, keys, "dates_active", "date"), path, "date")
    return shown(read_snapshot(spark, path, "date", last), keys)


@query(
    "snapshot_state",
    _DATES_SQL.format(keys="user_id", source="events", notnull="AND user_id IS NOT NULL"),
)
def snapshot_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a table bucketed by user, whose state is joined where it lies."""
    events = table(spark, folder, "events")
    keys = ["user_id"]
    name, path = f"user_dates_{uuid.uuid4().hex[:12]}", new_path(spark, "user_dates_state")
    n_buckets = STATE_BUCKETS
    first, before, last = days_of(events)
    prev = build_dates(events, keys, "ts", first, before, "dates_active", "date")
    write_state(prev, name, ("date", before), keys, n_buckets, path)
    yesterday = spark.table(name).where(F.col("date") == F.lit(before))
    today = active_days(events, keys, "ts", last)
    write_state(
        cumulate_dates(yesterday, today, keys, "dates_active", "date"),
        name, ("date", last), keys, n_buckets, path,
    )
    spark.sql(f"DROP TABLE {name}")  # the entry; its files stay
    return shown(read_snapshot(spark, path, "date", last), keys)


def type_days(events: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Hits and distinct users per event type and day."""
    return (
        days_between(events, "ts", first, last)
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.count_distinct("user_id").alias("visitors"),
        )
    )


def user_days(events: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Hits per user and day under the name of their metric."""
    return (
        days_between(events, "ts", first, last)
        .where("user_id IS NOT NULL")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("hits"))
        .withColumn("metric_name", F.lit("site_hits"))
    )


TYPE_METRICS = {"hit_array": "hits", "unique_visitors": "visitors"}
USER_KEY = ["user_id", "metric_name"]
USER_METRIC = {"metric_array": "hits"}


def user_hits(events: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The events of users as facts that add up to their hits."""
    rows = days_between(events, "ts", first, last).where("user_id IS NOT NULL")
    return rows.select("user_id", F.lit("site_hits").alias("metric_name"), F.to_date("ts").alias("day"), F.lit(1).alias("hits"))


def user_month(spark: SparkSession, folder: str) -> DataFrame:
    """All months in one pass."""
    events = table(spark, folder, "events")
    first, _, last = days_of(events)
    return build_months(user_hits(events, first, last), USER_KEY, "day", last, USER_METRIC, "month_start")


def type_month_shown(state: DataFrame) -> DataFrame:
    return state.select(
        "event_type",
        text("month").alias("month"),
        joined("hit_array").alias("hit_array"),
        joined("unique_visitors").alias("unique_visitors"),
    )


_TYPE_MONTH_SQL = """
WITH ends AS (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY AS stop FROM events),
active AS (SELECT DISTINCT event_type, CAST(date_trunc('month', ts) AS TIMESTAMP) AS m FROM events
           WHERE event_type IS NOT NULL AND ts IS NOT NULL),
grid AS (SELECT event_type, CAST(m AS DATE) AS m,
                CAST(unnest(range(m, least(m + INTERVAL 1 MONTH, stop), INTERVAL 1 DAY)) AS DATE) AS d
         FROM active, ends),
daily AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS hits,
                 count(DISTINCT user_id) AS visitors FROM events GROUP BY 1, 2)
SELECT grid.event_type, CAST(m AS VARCHAR) AS month,
       string_agg(CAST(coalesce(hits, 0) AS VARCHAR), ';' ORDER BY grid.d) AS hit_array,
       string_agg(CAST(coalesce(visitors, 0) AS VARCHAR), ';' ORDER BY grid.d) AS unique_visitors
FROM grid LEFT JOIN daily ON grid.event_type = daily.event_type AND grid.d = daily.d
GROUP BY grid.event_type, m
"""


@query("monthly_reduced", _TYPE_MONTH_SQL)
def monthly_reduced(spark: SparkSession, folder: str) -> DataFrame:
    """All months in one pass. Distinct users do not add up, so they are counted by day first."""
    events = table(spark, folder, "events")
    first, _, last = days_of(events)
    return type_month_shown(build_months(type_days(events, first, last), ["event_type"], "day", last, TYPE_METRICS))


@query("monthly_upsert", _TYPE_MONTH_SQL)
def monthly_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The same months through a table, of which the step reads and replaces the last partition."""
    events = table(spark, folder, "events")
    path = new_path(spark, "type_month")
    first, before, last = days_of(events)
    key = ["event_type"]
    prev = build_months(type_days(events, first, before), key, "day", before, TYPE_METRICS)
    append_snapshot(prev, path, "month")
    stored = spark.read.parquet(path)
    step = reduce_monthly(stored, type_days(events, last, last), key, last, TYPE_METRICS)
    upsert_partition(step, path, "month")
    return type_month_shown(spark.read.parquet(path))


_USER_MONTH_SQL = """
WITH ends AS (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY AS stop FROM events),
active AS (SELECT DISTINCT user_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS m FROM events
           WHERE user_id IS NOT NULL AND ts IS NOT NULL),
grid AS (SELECT user_id, CAST(m AS DATE) AS m,
                CAST(unnest(range(m, least(m + INTERVAL 1 MONTH, stop), INTERVAL 1 DAY)) AS DATE) AS d
         FROM active, ends),
daily AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS hits FROM events GROUP BY 1, 2),
filled AS (SELECT grid.user_id, grid.m, grid.d, coalesce(hits, 0) AS hits
           FROM grid LEFT JOIN daily ON grid.user_id = daily.user_id AND grid.d = daily.d)
"""


@query(
    "monthly_metric",
    _USER_MONTH_SQL
    + """SELECT user_id, 'site_hits' AS metric_name, CAST(m AS VARCHAR) AS month_start,
         string_agg(CAST(hits AS VARCHAR), ';' ORDER BY d) AS metric_array
         FROM filled GROUP BY user_id, m""",
)
def monthly_metric(spark: SparkSession, folder: str) -> DataFrame:
    """Up to the last day but one in bulk, then one step, which replaces the last month."""
    events = table(spark, folder, "events")
    first, before, last = days_of(events)
    prev = build_months(user_hits(events, first, before), USER_KEY, "day", before, USER_METRIC, "month_start")
    step = reduce_monthly(prev, user_days(events, last, last), USER_KEY, last, USER_METRIC, "month_start")
    months = prev.where(F.col("month_start") != F.lit(last.replace(day=1))).unionByName(step)
    return months.select(
        *USER_KEY,
        text("month_start").alias("month_start"),
        joined("metric_array").alias("metric_array"),
    )


@query(
    "array_lengths",
    _USER_MONTH_SQL
    + """SELECT CAST(length AS BIGINT) AS length, count(*) AS n_rows
         FROM (SELECT user_id, m, count(*) AS length FROM filled GROUP BY user_id, m) GROUP BY 1""",
)
def array_lengths(spark: SparkSession, folder: str) -> DataFrame:
    lengths = array_length_histogram(user_month(spark, folder), "metric_array")
    return lengths.withColumn("length", F.col("length").cast("long"))


@query(
    "monthly_unpacked",
    _USER_MONTH_SQL
    + """SELECT 'site_hits' AS metric_name, CAST(d AS VARCHAR) AS day,
         CAST(sum(hits) AS BIGINT) AS value FROM filled GROUP BY d""",
)
def monthly_unpacked(spark: SparkSession, folder: str) -> DataFrame:
    days = unpack_monthly(
        user_month(spark, folder), ["metric_name"], "month_start", "metric_array"
    )
    return days.withColumn("day", text("day"))


@query(
    "monthly_unpacked_as_written",
    _USER_MONTH_SQL
    + """SELECT 'site_hits' AS metric_name, CAST(d + 1 AS VARCHAR) AS day,
         CAST(sum(hits) AS BIGINT) AS value FROM filled GROUP BY d""",
)
def monthly_unpacked_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Each position dated one day late."""
    days = unpack_monthly(
        user_month(spark, folder), ["metric_name"], "month_start", "metric_array",
        first_offset=1,
    )
    return days.withColumn("day", text("day"))
