"""Files and tables: CSV, snapshots, upserts, buckets, written intermediate results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import new_path


def text_schema(*columns: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A CSV file with a header. All columns are text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_snapshot(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """One snapshot of a cumulative table; other partitions are not listed or read."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(value))


def append_snapshot(df: DataFrame, path: str, column: str) -> None:
    """Adds the snapshots in ``df`` to a table partitioned by ``column``.

    A snapshot that is there already is replaced, so a step can run again.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def upsert_partition(df: DataFrame, path: str, column: str) -> None:
    """Replaces the partitions in ``df`` by its rows.

    The cumulative steps return merged rows, old and new, so replacing the partition is the
    upsert. ``df`` may read the partitions that it replaces.
    """
    append_snapshot(df, path, column)


def write_table(df: DataFrame, name: str, mode: str = "append", path: str | None = None) -> None:
    """Appends to a catalog table, or overwrites it."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def empty_state(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """The state before the first period."""
    return spark.createDataFrame([], schema)


def write_bucketed(
    df: DataFrame,
    table: str,
    n: int,
    keys: Sequence[str],
    path: str | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Writes a table in ``n`` buckets, sorted by the keys, and returns it.

    The rebalance hint gathers rows by key first, so a task writes few buckets instead of all
    of them; a partition that is too large is split, so a hot key has several files.
    """
    keys = list(keys)
    writer = df.hint("rebalance", *keys).write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(n, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_count(n_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Buckets of about ``bucket_bytes`` each; a suggestion for the ``n`` of a bucketed table."""
    return max(1, -(-n_bytes // bucket_bytes))


def total_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the Parquet files at the given paths, from their listing."""
    sizes = [data_files(spark, p).agg(F.coalesce(F.sum("length"), F.lit(0))) for p in paths]
    return sum(s.first()[0] for s in sizes)


def write_state(
    df: DataFrame,
    table: str,
    snapshot: tuple[str, object],
    keys: Sequence[str],
    n: int,
    path: str | None = None,
) -> None:
    """Puts one snapshot into a cumulative table that is partitioned by it and bucketed by entity.

    A step joins yesterday's snapshot with today's facts. From such a table the state is read in
    place, so only the facts of the day are shuffled, however large the state has grown; choose
    ``n`` no smaller than the partitions of a shuffle, or Spark rather shuffles the state.
    ``snapshot`` is the partition column and the value it has in ``df``. Rows are gathered by
    entity first, so that a task writes few buckets. A snapshot that is there already is
    replaced, so a step can run again.
    """
    spark, keys = df.sparkSession, list(keys)
    column, value = snapshot
    rows = df.where(F.col(column) == F.lit(value)).hint("rebalance", *keys)
    if not spark.catalog.tableExists(table):
        writer = rows.write.format("parquet").partitionBy(column).bucketBy(n, *keys).sortBy(*keys)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    The lineage ends there, a lost executor costs nothing, and the plan knows the size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Name and length of the Parquet files below ``path``; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
