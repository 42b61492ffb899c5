"""Checks that stand in for primary keys and enumerations, which Spark tables do not enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count. Counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def values_outside(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values of ``column`` that are not in the domain, with their row count. NULL is allowed."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError naming a few of the keys that repeat."""
    bad = duplicate_keys(df, keys).take(5)
    if bad:
        raise ValueError(f"key {list(keys)} is not unique: {[r.asDict() for r in bad]}")
    return df


def assert_domain(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError naming a few of the values outside the domain."""
    bad = values_outside(df, column, values).take(5)
    if bad:
        raise ValueError(f"{column} outside {list(values)}: {[r.asDict() for r in bad]}")
    return df


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` itself and how many of its rows meet each condition, counted while it is written.

    ``Observation.get`` has the counts, and ``rows``, once an action on the returned frame is done: no
    second pass over the rows, and no job of its own.
    """
    observation = Observation()
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def null_keys(keys: Sequence[str]) -> dict[str, Column]:
    """Conditions for :func:`counted`: rows whose key is NULL, by column."""
    return {f"null_{k}": F.col(k).isNull() for k in keys}


def outside_domain(column: str, values: Sequence[str]) -> dict[str, Column]:
    """A condition for :func:`counted`: rows whose value is not in the domain. NULL is allowed."""
    return {f"outside_{column}": ~F.col(column).isin(*values)}
