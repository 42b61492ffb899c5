"""Sessions of users per event type, batch and streaming. Table: events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import session_stats, session_stats_by_host, sessionize
from ..session import new_path
from ..sources import read_finished
from ..streaming import sessions_to_batches, sessions_to_files
from .registry import instant, query, table

KEYS = ["user_id", "event_type"]
GAP, WATERMARK = "6 hours", "15 seconds"

_SESSIONS_SQL = """
WITH gaps AS (
  SELECT user_id, event_type, ts,
         CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL
              THEN 1 ELSE 0 END AS opens
  FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, event_type ORDER BY ts
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM gaps),
sessions AS (SELECT user_id, event_type, min(ts) AS session_start,
                    max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS event_count
             FROM numbered GROUP BY user_id, event_type, n)
"""
_SHOWN_SQL = """SELECT strftime(session_start, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(session_end, '%Y-%m-%d %H:%M:%S.%f') AS session_end,
       user_id, event_type, event_count FROM sessions
"""


def shown(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns({c: instant(c) for c in ("session_start", "session_end")})


def batch(spark: SparkSession, folder: str) -> DataFrame:
    return sessionize(table(spark, folder, "events"), "ts", KEYS, GAP)


@query("sessions", _SESSIONS_SQL + _SHOWN_SQL)
def sessions(spark: SparkSession, folder: str) -> DataFrame:
    return shown(batch(spark, folder))


@query(
    "session_stats",
    _SESSIONS_SQL
    + """SELECT CAST(round(CAST(sum(event_count) AS DECIMAL(20, 6)) / count(*), 2) AS DOUBLE)
         AS avg_events_per_session FROM sessions WHERE event_type LIKE '%e'""",
)
def sessions_of_hosts(spark: SparkSession, folder: str) -> DataFrame:
    stats = session_stats(batch(spark, folder), "event_type", "%e")
    return stats.withColumn(
        "avg_events_per_session", F.col("avg_events_per_session").cast("double")
    )


@query(
    "session_stats_by_host",
    _SESSIONS_SQL
    + """SELECT event_type,
       CAST(round(CAST(sum(event_count) AS DECIMAL(20, 6)) / count(*), 2) AS DOUBLE)
         AS avg_events_per_session, count(*) AS session_count
FROM sessions WHERE event_type IN ('click', 'view', 'nothing') GROUP BY 1""",
)
def sessions_by_host(spark: SparkSession, folder: str) -> DataFrame:
    stats = session_stats_by_host(
        batch(spark, folder), "event_type", ["click", "view", "nothing"]
    )
    return stats.withColumn(
        "avg_events_per_session", F.col("avg_events_per_session").cast("double")
    )


@query(
    "sessions_stream",
    _SESSIONS_SQL + _SHOWN_SQL
    + "WHERE session_end <= (SELECT max(ts) - INTERVAL 15 SECOND FROM events)",
)
def sessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All events as a stream, read to its end: the sessions that are closed by then."""
    path = new_path(spark, "sessions")
    columns = table(spark, folder, "events").schema
    # A pattern rather than a plain path, so that one file and a folder of files both work.
    events = (
        spark.readStream.schema(columns)
        .parquet(f"{folder}/events.parque[t]")
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    job = sessions_to_files(
        events, "ts", KEYS, f"{path}/closed", f"{path}/checkpoint", GAP, WATERMARK
    )
    job.awaitTermination()
    return shown(spark.read.parquet(f"{path}/closed"))


@query("sessions_once", _SESSIONS_SQL + _SHOWN_SQL)
def sessions_once(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice or more, as an at-least-once source may do; each counts once."""
    events = table(spark, folder, "events")
    again = events.unionByName(events).unionByName(events.where(F.col("event_id") % 3 == 0))
    return shown(sessionize(again, "ts", KEYS, GAP, once=["event_id"]))


@query(
    "sessions_batches",
    _SESSIONS_SQL + _SHOWN_SQL
    + "WHERE session_end <= (SELECT max(ts) - INTERVAL 15 SECOND FROM events)",
)
def sessions_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The stream through a sink by micro-batch, of which only recorded batches are read."""
    path = new_path(spark, "session-batches")
    events = (
        spark.readStream.schema(table(spark, folder, "events").schema)
        .parquet(f"{folder}/events.parque[t]")
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    job = sessions_to_batches(events, "ts", KEYS, f"{path}/closed", f"{path}/checkpoint", GAP, WATERMARK, ["event_id"])
    job.awaitTermination()
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    schema = f"session_start timestamp, session_end timestamp, {', '.join(f'{k} {kinds[k]}' for k in KEYS)}, event_count long"
    return shown(read_finished(spark, f"{path}/closed", schema).drop("batch_id"))
