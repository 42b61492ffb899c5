"""Web traffic: active days, bitmaps, monthly arrays, sessions.

``events``: user_id, device_id, host, event_time (a timestamp, or text of one). ``devices``:
device_id, browser_type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators import (
    active_days,
    activity_flags,
    array_length_histogram,
    cumulate_dates,
    datelist_int,
    days_between,
    enrich_left,
    reduce_monthly,
    unpack_monthly,
)

# Browser of an unknown device, and the metric of a user's monthly array.
UNKNOWN_BROWSER = "Unknown"
SITE_HITS = "site_hits"

USER_DEVICES_SCHEMA = (
    "user_id long, browser_type string, device_activity_datelist array<date>, snapshot_date date"
)
HOSTS_SCHEMA = "host string, host_activity_datelist array<date>, snapshot_date date"
USERS_SCHEMA = "user_id string, dates_active array<date>, date date"
HOST_MONTH_SCHEMA = "host string, month date, hit_array array<long>, unique_visitors array<long>"
USER_MONTH_SCHEMA = (
    "user_id long, metric_name string, month_start date, metric_array array<long>"
)


def timed(events: DataFrame) -> DataFrame:
    """Events with ``event_time`` as a timestamp; text that is none becomes NULL."""
    if isinstance(events.schema["event_time"].dataType, StringType):
        return events.withColumn("event_time", F.col("event_time").try_cast("timestamp"))
    return events


def user_devices_step(
    state: DataFrame, events: DataFrame, devices: DataFrame, day: dt.date
) -> DataFrame:
    """Active days per user and browser after ``day``.

    Events are reduced to (user, device) before they meet the devices.
    """
    seen = active_days(timed(events), ["user_id"], "event_time", day, also=["device_id"])
    today = (
        enrich_left(seen, devices, "device_id", {"browser_type": UNKNOWN_BROWSER})
        .select("user_id", "browser_type", "active_date")
        .distinct()
    )
    prev = state.where(F.col("snapshot_date") == F.lit(day - dt.timedelta(days=1)))
    keys = ["user_id", "browser_type"]
    return cumulate_dates(prev, today, keys, "device_activity_datelist", "snapshot_date")


def hosts_step(state: DataFrame, events: DataFrame, day: dt.date) -> DataFrame:
    """Active days per host after ``day``."""
    prev = state.where(F.col("snapshot_date") == F.lit(day - dt.timedelta(days=1)))
    today = active_days(timed(events), ["host"], "event_time", day)
    return cumulate_dates(prev, today, ["host"], "host_activity_datelist", "snapshot_date")


def users_step(state: DataFrame, events: DataFrame, day: dt.date) -> DataFrame:
    """Active days per user after ``day``."""
    prev = state.where(F.col("date") == F.lit(day - dt.timedelta(days=1)))
    today = active_days(timed(events), ["user_id"], "event_time", day)
    today = today.withColumn("user_id", F.col("user_id").cast("string"))
    return cumulate_dates(prev, today, ["user_id"], "dates_active", "date")


def device_bitmaps(
    state: DataFrame, day: dt.date, start: dt.date, anchor_bit: int = 31
) -> DataFrame:
    """Active days since ``start`` as one integer per user and browser."""
    now = state.where(F.col("snapshot_date") == F.lit(day))
    bits = datelist_int(now, "device_activity_datelist", day, start, day, anchor_bit)
    return bits.drop("device_activity_datelist")


def user_activity(
    state: DataFrame, day: dt.date, start: dt.date, anchor_bit: int = 31
) -> DataFrame:
    """Monthly, weekly and daily activity per user on ``day``."""
    now = state.where(F.col("date") == F.lit(day))
    bits = datelist_int(now, "dates_active", day, start, day, anchor_bit)
    return activity_flags(bits).drop("dates_active", "date", "datelist_int")


def host_month_step(state: DataFrame, events: DataFrame, day: dt.date) -> DataFrame:
    """Hits and distinct visitors per host, with the values of ``day`` in place."""
    daily = (
        days_between(timed(events), "event_time", day, day)
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("hits"), F.count_distinct("user_id").alias("visitors")
        )
    )
    metrics = {"hit_array": "hits", "unique_visitors": "visitors"}
    return reduce_monthly(state, daily, ["host"], day, metrics)


def user_month_step(state: DataFrame, events: DataFrame, day: dt.date) -> DataFrame:
    """Hits per user, with the value of ``day`` in place."""
    daily = (
        days_between(timed(events), "event_time", day, day)
        .where("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("hits"))
        .withColumn("metric_name", F.lit(SITE_HITS))
    )
    keys = ["user_id", "metric_name"]
    return reduce_monthly(state, daily, keys, day, {"metric_array": "hits"}, "month_start")


def user_month_lengths(state: DataFrame) -> DataFrame:
    return array_length_histogram(state, "metric_array")


def daily_totals(state: DataFrame) -> DataFrame:
    """Totals per metric and day, over all users."""
    return unpack_monthly(state, ["metric_name"], "month_start", "metric_array")
