"""Registered queries: name -> (spark, folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(c: Column | str) -> Column:
    """Dates and numbers as text, which both engines print alike."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def joined(array: Column | str, fn: Callable[[Column], Column] = text, sep: str = ";") -> Column:
    """An array as text."""
    return F.array_join(F.transform(array, fn), sep)


def instant(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
