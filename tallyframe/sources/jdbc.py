"""Append sink for a database, one Spark JDBC write per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sink table and rows per insert.
SESSION_TABLE = "processed_events_aggregated"
FLUSH_ROWS = 1000


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str
    table: str = SESSION_TABLE
    driver: str = "org.postgresql.Driver"
    batch_rows: int = FLUSH_ROWS
    batch_column: str | None = None  # gets the id of the micro-batch

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(self.batch_rows),
        }


def append_rows(df: DataFrame, target: JdbcTarget) -> None:
    """Inserts from the executors; a failed task is retried by Spark."""
    df.write.format("jdbc").options(**target.options()).mode("append").save()


def jdbc_sink(target: JdbcTarget) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. A batch that runs again inserts again: at-least-once.

    With ``batch_column`` each row carries its micro-batch, so the rows of a repeated one can be told
    apart and deleted. A session is named by its keys and start, so readers can ``dedup`` on these.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if target.batch_column:
            batch = batch.withColumn(target.batch_column, F.lit(batch_id).cast("long"))
        append_rows(batch, target)

    return write
