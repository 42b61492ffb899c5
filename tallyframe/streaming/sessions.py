"""The sessionisation job: events in, finished sessions out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.sessions import sessionize
from ..sources.jdbc import JdbcTarget, jdbc_sink
from ..sources.batches import staged_sink
from ..sources.kafka import EVENT_TIME, KafkaSource, kafka_events


# Sessions merge in each task before the shuffle, so a busy key sends few sessions instead of all
# its events. Open sessions are kept on disk, so their number is not bound by executor memory.
STREAM_SETTINGS = {
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def start_with_settings(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Starts a query with ``STREAM_SETTINGS``.

    A query keeps the settings it was started with, so the session gets its own back at once.
    """
    before = {name: spark.conf.get(name, None) for name in STREAM_SETTINGS}
    for name, value in STREAM_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def sessions_to_files(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    gap: str = "5 minutes",
    watermark: str = "15 seconds",
    trigger: dict | None = None,
    once: Sequence[str] = (),
) -> StreamingQuery:
    """Writes each session once it can no longer grow. The file sink is exactly-once.

    ``once`` names the columns of an event by which repeated messages are dropped.
    """
    writer = (
        sessionize(events, ts, keys, gap, watermark, once)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return start_with_settings(events.sparkSession, writer)


def sessions_to_batches(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    gap: str = "5 minutes",
    watermark: str = "15 seconds",
    once: Sequence[str] = (),
) -> StreamingQuery:
    """Sessions by micro-batch, for readers of :func:`~tallyframe.sources.read_finished`."""
    writer = (
        sessionize(events, ts, keys, gap, watermark, once)
        .writeStream.outputMode("append")
        .foreachBatch(staged_sink(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return start_with_settings(events.sparkSession, writer)


def sessions_to_jdbc(
    spark: SparkSession, source: KafkaSource, target: JdbcTarget, checkpoint: str, once: Sequence[str] = ()
) -> StreamingQuery:
    """Kafka to database, sessions per (ip, host). Errors end the query and reach the caller.

    The source delivers at least once; ``once`` names the fields that tell events apart.
    """
    writer = (
        sessionize(kafka_events(spark, source), EVENT_TIME, ["ip", "host"], once=once)
        .writeStream.outputMode("append")
        .foreachBatch(jdbc_sink(target))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="60 seconds")
    )
    return start_with_settings(spark, writer)
