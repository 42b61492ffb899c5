"""Cleansing, enrichment, bucketed joins and table layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..sources.tables import data_files, materialise
from .checks import counted
from .skew import dealt, task_count

# The spellings of booleans in the text files.
TRUE_TEXT = ("true", "TRUE", "1")
FALSE_TEXT = ("false", "FALSE", "0")


def text_to_bool(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*TRUE_TEXT), True).when(c.isin(*FALSE_TEXT), False)


def _typed(name: str, kind: str) -> Column:
    if kind == "boolean":
        return text_to_bool(name)
    if kind.startswith("timestamp:"):
        return F.try_to_timestamp(name, F.lit(kind.partition(":")[2]))
    return F.col(name).try_cast(kind)


def clean_typed(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Types the text columns named in ``spec`` and drops the others.

    A type is ``"boolean"``, ``"timestamp:<pattern>"`` or any type to cast to. Text that does
    not fit becomes NULL instead of failing the job; :func:`clean_counted` also counts it.
    """
    return df.select(*[_typed(name, kind).alias(name) for name, kind in spec.items()])


def clean_counted(df: DataFrame, spec: dict[str, str]) -> tuple[DataFrame, Observation]:
    """:func:`clean_typed`, and for each column the number of texts that do not fit its type.

    The counts (``bad_<column>``, and ``rows``) are taken while the result is written.
    """
    bad = {f"bad_{name}": F.col(name).isNotNull() & _typed(name, kind).isNull() for name, kind in spec.items()}
    seen, observation = counted(df, **bad)
    return clean_typed(seen, spec), observation


def enrich_broadcast(
    facts: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Facts with the columns of a dimension.

    No hint and no count: Spark broadcasts the dimension if its size in bytes is below
    ``spark.sql.autoBroadcastJoinThreshold``, so a small one costs no shuffle of the facts. Beyond it
    the join shuffles, and adaptive execution splits hot keys.
    """
    return facts.join(dim, key, how)


def enrich_left(
    facts: DataFrame, dim: DataFrame, key: str | Sequence[str], defaults: dict[str, str]
) -> DataFrame:
    """Facts with the columns of a dimension, and a default where there is no match or value."""
    filled = {c: F.coalesce(F.col(c), F.lit(value)) for c, value in defaults.items()}
    return facts.join(dim, key, "left").withColumns(filled)


def bucket_join(
    details: DataFrame, matches: DataFrame, medals: DataFrame, match: str, player: str
) -> DataFrame:
    """Details of a match with the medals of the same player in it, and with the match.

    Details and medals bucketed by (match, player) meet without a shuffle, and a match with very many
    players lies in many buckets. The match comes last, over a join that adaptive execution may
    split. A medal row meets only its own player: pairing all players with all medals of a match
    would repeat both.

    Tables that are all bucketed by ``match`` alone join without any shuffle if the caller sets
    ``spark.sql.requireAllClusterKeysForCoPartition`` to false; a hot match is one task then.
    """
    return details.hint("merge").join(medals, [match, player]).join(matches, match)


def unpaired_weights(
    details: DataFrame, medals: DataFrame, match: str, spread: Column | None = None, n_salts: int = 1
) -> DataFrame:
    """Details with ``weight``, the number of medal rows of their match.

    A join of details and medals on the match alone repeats each detail that often. Sums over
    weights give the same answers without emitting the pairs. With ``n_salts`` the details of a
    match are spread by ``spread`` (an integer over their columns) and each weight is repeated
    that often, so a hot match is joined in several tasks.
    """
    per_match = medals.groupBy(match).agg(F.count(F.lit(1)).alias("weight"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("__salt")
    place = F.pmod(F.lit(0) if spread is None else spread, F.lit(n_salts)).cast("int")
    salted = details.withColumn("__salt", place)
    return salted.join(per_match.select("*", salts), [match, "__salt"]).drop("__salt")


#: Rows in a row of a file that are dealt, or looked at, together.
FILE_BLOCK = 10_000


def layout_rows(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written and read back, and the number of tasks that its rows are dealt over.

    A reader packs files up to a number of bytes, and sorted or repeated values have few. The rows are
    therefore counted, which reads the footers, and dealt in blocks of their files; few are left as they are.
    """
    rows = materialise(df, "layout-rows")
    n_tasks = task_count(rows, rows.count())
    block = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / FILE_BLOCK))
    return (dealt(rows.withColumn("__block", block), n_tasks, "__block").drop("__block") if n_tasks > 1 else rows), n_tasks


def compare_layouts(df: DataFrame, orders: dict[str, Sequence[str]], path: str) -> DataFrame:
    """Writes ``df`` once per sort order and reports (layout, bytes, files).

    Rows stay in their partitions and are sorted there, so the files differ only by row order.
    They are written once unsorted first, so the work behind ``df`` is not done per layout.
    """
    rows, _ = layout_rows(df)
    reports = []
    for layout, columns in orders.items():
        target = f"{path}/{layout}"
        rows.sortWithinPartitions(*columns).write.mode("overwrite").parquet(target)
        reports.append(
            data_files(df.sparkSession, target)
            .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
            .select(F.lit(layout).alias("layout"), "bytes", "files")
        )
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def check_layouts(df: DataFrame, orders: dict[str, Sequence[str]], path: str, key: str) -> DataFrame:
    """Writes ``df`` once per sort order and reads it back: (layout, n_rows, key_sum, n_unsorted).

    ``n_unsorted`` counts the rows that come before their predecessor in the file, in the layout's
    order. A file is looked at by itself, in blocks of ``FILE_BLOCK`` rows: the last row of a block is
    repeated ahead of the next one, so no window holds a whole file.
    """
    rows, n_tasks = layout_rows(df)
    own = F.floor(F.col("__row") / FILE_BLOCK)
    window = Window.partitionBy("__file", "__block").orderBy("__row")
    out = None
    for layout, columns in orders.items():
        target = f"{path}/{layout}"
        rows.sortWithinPartitions(*columns).write.mode("overwrite").parquet(target)
        stored = df.sparkSession.read.parquet(target).select(
            key, F.struct(*columns).alias("__now"), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
        )
        ends = (F.col("__row") + 1) % FILE_BLOCK == 0
        blocks = stored.withColumn("__block", F.explode(F.when(ends, F.array(own, own + 1)).otherwise(F.array(own))))
        report = (
            dealt(blocks, n_tasks, "__file", "__block")
            .withColumn("__before", F.lag("__now").over(window))
            .where(F.col("__block") == own)
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.sum(key).alias("key_sum"),
                F.count_if(F.col("__now") < F.col("__before")).alias("n_unsorted"),
            )
            .select(F.lit(layout).alias("layout"), "n_rows", "key_sum", "n_unsorted")
        )
        out = report if out is None else out.unionByName(report)
    return out
