"""Web events from Kafka: connection options and decoding."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import text_schema

# Fields of a message and the pattern of its event time.
EVENT_FIELDS = ("ip", "event_time", "referrer", "host", "url", "geodata")
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"  # with its offset, so the session's zone is no matter
EVENT_TIME = "window_timestamp"


@dataclass(frozen=True)
class KafkaSource:
    servers: str
    topic: str
    group: str
    key: str = ""
    secret: str = ""
    #: Further options of the reader, such as maxOffsetsPerTrigger (the size of a micro-batch) and
    #: minPartitions.
    more: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_settings(
        cls, settings: Mapping[str, str], names: Mapping[str, str], more: Mapping[str, str] | None = None
    ) -> KafkaSource:
        """From settings such as the environment; ``names`` maps our fields to their names there."""
        found = {ours: settings[theirs] for ours, theirs in names.items() if theirs in settings}
        return cls(**found, more=more or {})

    def options(self) -> dict[str, str]:
        module = "org.apache.kafka.common.security.plain.PlainLoginModule"
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "kafka.group.id": self.group,
            "startingOffsets": "earliest",
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f'{module} required username="{self.key}" password="{self.secret}";'
            ),
            **self.more,
        }


def decode_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Fields of JSON messages and their event time. A malformed message has no event time."""
    event = F.from_json(F.col(value).cast("string"), text_schema(*EVENT_FIELDS))
    return (
        messages.select(event.alias("event"))
        .select("event.*")
        .withColumn(EVENT_TIME, F.try_to_timestamp("event_time", F.lit(EVENT_TIME_PATTERN)))
    )


def observed_events(messages: DataFrame, value: str = "value", name: str = "messages") -> DataFrame:
    """:func:`decode_events` that counts as it goes: ``rows``, and ``rejected`` ones without an event time.

    The counts of a micro-batch are in the query's progress under ``name``; no message is read twice.
    """
    events = decode_events(messages, value)
    return events.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(EVENT_TIME).isNull()).alias("rejected"))


def rejected_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages that :func:`decode_events` finds no event time in, for a side output or a count."""
    time = F.try_to_timestamp(
        F.from_json(F.col(value).cast("string"), text_schema(*EVENT_FIELDS))["event_time"], F.lit(EVENT_TIME_PATTERN)
    )
    return messages.where(time.isNull())


def kafka_events(spark: SparkSession, source: KafkaSource) -> DataFrame:
    """The event stream. Needs the Spark Kafka connector on the class path."""
    return decode_events(spark.readStream.format("kafka").options(**source.options()).load())
