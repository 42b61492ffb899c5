"""A file sink for micro-batches that is safe against repeated and broken-off ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"


def staged_sink(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: rows go to ``path``/rows/batch_id=N, then N to ``path``/finished.

    A batch that runs again replaces its own folder, and counts only once it is on the record, so
    readers of :func:`read_finished` see each batch whole and once: neither the rows of a batch that
    broke off nor those of a repeated one twice. An empty batch is recorded as well. ``path`` has to
    lie in a folder that all executors share.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/{BATCH}={batch_id}")
        record = batch.sparkSession.createDataFrame([(batch_id,)], "id long")
        record.coalesce(1).write.mode("overwrite").parquet(f"{path}/finished/{BATCH}={batch_id}")

    return write


def read_finished(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all recorded batches, with their ``batch_id``; ``schema`` is that of the rows."""
    rows = spark.read.schema(f"{schema}, {BATCH} long").option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    done = spark.read.schema(f"id long, {BATCH} long").option("basePath", f"{path}/finished").parquet(f"{path}/finished")
    return rows.join(done.select(F.col("id").alias(BATCH)), BATCH, "left_semi")
