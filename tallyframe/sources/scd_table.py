"""Slowly changing dimensions as stored state: open intervals in one table, closed ones in another.

A step reads and writes the open intervals only. Intervals that it closes are appended and never
touched again, so a step costs what changes and what is open, however long the history is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd import DATES, scd2_step
from .tables import append_snapshot, write_state

SNAPSHOT, CLOSED_AT = "snapshot_date", "closed_at"


@dataclass(frozen=True)
class Scd2Table:
    """``table`` is the catalog name of the open intervals, bucketed by key below ``path``/open and
    partitioned by snapshot; ``path``/closed holds the closed ones, partitioned by the period that
    closed them."""

    table: str
    path: str
    key: Sequence[str]
    attrs: Sequence[str]
    tracked: Sequence[str]
    buckets: int = 16

    def _columns(self) -> list[str]:
        return [*self.key, *self.attrs, *self.tracked, *DATES]

    def _write(self, rows: DataFrame, period: dt.date) -> None:
        """Both parts replace what an earlier try of the same period has written."""
        is_open = F.col("end_date") == F.lit(period)
        closed = rows.where(~is_open).select(*self._columns(), F.lit(period).alias(CLOSED_AT))
        append_snapshot(closed, f"{self.path}/closed", CLOSED_AT)
        now = rows.where(is_open).select(*self._columns(), F.lit(period).alias(SNAPSHOT))
        write_state(now, self.table, (SNAPSHOT, period), self.key, self.buckets, f"{self.path}/open")

    def load(self, intervals: DataFrame, snapshot: dt.date) -> None:
        """Starts from a built history at ``snapshot``."""
        self._write(intervals, snapshot)

    def stepped(self, spark: SparkSession, current: DataFrame, snapshot: dt.date, period: dt.date) -> DataFrame:
        """The rows that the step from ``snapshot`` to ``period`` writes."""
        before = spark.table(self.table).where(F.col(SNAPSHOT) == F.lit(snapshot))
        return scd2_step(before, current, self.key, self.attrs, self.tracked, period)

    def step(self, spark: SparkSession, current: DataFrame, snapshot: dt.date, period: dt.date) -> None:
        """Moves the state on by one period. It can run again: the state before it stays in place."""
        self._write(self.stepped(spark, current, snapshot, period), period)

    def read(self, spark: SparkSession, at: dt.date) -> DataFrame:
        """All intervals as they were at a snapshot; later partitions are not read."""
        closed = spark.read.schema(self._schema(spark, CLOSED_AT)).parquet(f"{self.path}/closed")
        now = spark.read.schema(self._schema(spark, SNAPSHOT)).parquet(f"{self.path}/open")
        closed = closed.where(F.col(CLOSED_AT) <= F.lit(at)).select(*self._columns())
        now = now.where(F.col(SNAPSHOT) == F.lit(at)).select(*self._columns())
        return closed.unionByName(now).withColumn(SNAPSHOT, F.lit(at))

    def _schema(self, spark: SparkSession, partition: str) -> str:
        kinds = {f.name: f.dataType.simpleString() for f in spark.table(self.table).schema}
        return ", ".join(f"`{c}` {kinds[c]}" for c in self._columns()) + f", {partition} date"

    def forget(self, spark: SparkSession) -> None:
        """Drops the catalog entry; the files stay."""
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")
