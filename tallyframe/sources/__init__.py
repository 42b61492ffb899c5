from .batches import read_finished, staged_sink
from .jdbc import JdbcTarget, append_rows, jdbc_sink
from .kafka import KafkaSource, decode_events, kafka_events, observed_events, rejected_events
from .tables import (
    append_snapshot,
    bucket_count,
    data_files,
    empty_state,
    materialise,
    read_csv,
    read_snapshot,
    text_schema,
    total_bytes,
    upsert_partition,
    write_bucketed,
    write_state,
    write_table,
)

__all__ = [
    "JdbcTarget",
    "KafkaSource",
    "append_rows",
    "append_snapshot",
    "bucket_count",
    "data_files",
    "decode_events",
    "empty_state",
    "jdbc_sink",
    "kafka_events",
    "materialise",
    "observed_events",
    "read_csv",
    "read_finished",
    "read_snapshot",
    "rejected_events",
    "staged_sink",
    "text_schema",
    "total_bytes",
    "upsert_partition",
    "write_bucketed",
    "write_state",
    "write_table",
]
