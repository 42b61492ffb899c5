"""Deduplication and fact normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checks import duplicate_keys


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark limits every group to ``k`` rows before the shuffle (WindowGroupLimit), so a group
    that holds most of the rows sends at most ``k`` rows per map task.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k).drop(rank)


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key.

    ``order_by`` picks the survivor. The remaining columns follow as tie-breaks, so the result
    does not depend on the order in which rows arrive.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    order = list(order_by or []) + rest
    if not order:
        return df.select(*keys).distinct()
    return top_k_per_group(df, keys, order, 1)


def normalise_fact(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    key: Sequence[str],
    columns: dict[str, Column],
    dim_unique: bool | None = None,
) -> DataFrame:
    """Typed ``dim_*`` / ``m_*`` columns of a fact with its dimension, one row per key.

    ``on`` has to be part of ``key``. Then the join cannot change which row of a key survives, and
    duplicates of both sides are removed before the join instead of after it. A dimension without
    duplicates is joined as it is: ``dim_unique`` says so, and by default its keys are counted,
    which reads the key columns alone, where removing duplicates would sort all columns.
    """
    missing = [c for c in on if c not in key]
    if missing:
        raise ValueError(f"join columns {missing} are not part of the fact key")
    if dim_unique is None:
        dim_unique = duplicate_keys(dim.select(*on), on).isEmpty()
    once = dim if dim_unique else dedup(dim, list(on))
    return dedup(fact, key).join(once, list(on), "inner").select(
        *[c.alias(name) for name, c in columns.items()]
    )
