"""Session windows, on a stream or a finished table, and questions about sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seconds_of


def sessionize(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    gap: str = "5 minutes",
    watermark: str = "15 seconds",
    once: Sequence[str] = (),
) -> DataFrame:
    """Rows (session_start, session_end, keys, event_count).

    A session ends ``gap`` after its last event; an event exactly that late still belongs to it.
    Events without a time are left out.

    ``once`` names the columns that tell events apart, for a source that delivers at least once:
    repeated events count once. A stream keeps an event's columns until the watermark has passed it,
    so a repetition counts again only if it is later than that.
    """
    keys = list(keys)
    if once:
        events = events.where(F.col(ts).isNotNull())
    if events.isStreaming:
        marked = events.withWatermark(ts, watermark)
        windowed = (
            (marked.dropDuplicatesWithinWatermark(list(once)) if once else marked)
            .groupBy(F.session_window(ts, gap).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("event_count"))
        )
    else:
        windowed = _batch_sessions(events.dropDuplicates(list(once)) if once else events, ts, keys, gap)
    return windowed.select(
        F.col("w.start").alias("session_start"),
        F.col("w.end").alias("session_end"),
        *keys,
        "event_count",
    )


def _batch_sessions(events: DataFrame, ts: str, keys: list[str], gap: str) -> DataFrame:
    """Sessions from counts per key and time slot.

    Two events in one slot of the gap's length always share a session, so slots can be counted
    before any shuffle. A key then has at most one row per slot, however many events it had, and
    a slot opens a session if it starts more than ``gap`` after the end of the one before.
    """
    slots = (
        events.select(*keys, F.col(ts).alias("__ts"), F.window(ts, gap)["start"].alias("__slot"))
        .groupBy(*keys, "__slot")
        .agg(
            F.min("__ts").alias("__first"),
            F.max("__ts").alias("__last"),
            F.count(F.lit(1)).alias("__n"),
        )
    )
    order = Window.partitionBy(*keys).orderBy("__slot")
    seconds = F.lit(seconds_of(gap))
    reach = F.timestamp_add("SECOND", seconds, F.lag("__last").over(order))
    opens = F.coalesce(F.col("__first") > reach, F.lit(True)).cast("long")
    return (
        slots.withColumn("__opens", opens)
        .withColumn("__session", F.sum("__opens").over(order))
        .groupBy(*keys, "__session")
        .agg(
            F.min("__first").alias("start"),
            F.timestamp_add("SECOND", seconds, F.max("__last")).alias("end"),
            F.sum("__n").alias("event_count"),
        )
        .select(F.struct("start", "end").alias("w"), *keys, "event_count")
    )


def _rounded_average(column: str):
    return F.round(F.avg(F.col(column).cast("decimal(20,6)")), 2)


def session_stats(sessions: DataFrame, host: str, pattern: str) -> DataFrame:
    """Average events per session over the hosts that match a LIKE pattern."""
    return sessions.where(F.col(host).like(pattern)).agg(
        _rounded_average("event_count").alias("avg_events_per_session")
    )


def session_stats_by_host(sessions: DataFrame, host: str, hosts: Sequence[str]) -> DataFrame:
    """Average events and number of sessions for each of the given hosts, in their order."""
    return (
        sessions.where(F.col(host).isin(*hosts))
        .groupBy(host)
        .agg(
            _rounded_average("event_count").alias("avg_events_per_session"),
            F.count(F.lit(1)).alias("session_count"),
        )
        .orderBy(host)
    )
