"""Monthly facts packed by position: element *i* of an array is the metric of day *i*."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import has_all


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), n)


def reduce_monthly(
    prev_month: DataFrame,
    daily: DataFrame,
    key: Sequence[str],
    day: dt.date,
    metrics: dict[str, str],
    month: str = "month",
    as_written: bool = False,
) -> DataFrame:
    """Puts the values of ``day`` into the arrays of its month; the result replaces the month.

    ``metrics`` maps an array column to the daily column it takes. Values are placed by index:
    a skipped day is filled with 0 and a day that runs twice overwrites itself. With
    ``as_written`` the value is appended whatever the length of the array.
    """
    key = list(key)
    offset = day.day - 1
    t = daily.where(has_all(key)).select(
        *key, *[F.col(c).cast("long").alias(f"__{a}") for a, c in metrics.items()]
    )
    first = F.lit(day.replace(day=1))
    y = prev_month.where(F.col(month) == first).where(has_all(key)).select(*key, *metrics)

    def placed(array: str) -> Column:
        value = F.array(F.coalesce(F.col(f"__{array}"), F.lit(0).cast("long")))
        if as_written:
            return F.concat(F.coalesce(F.col(array), _zeros(offset)), value)
        if offset == 0:
            return value
        known = F.coalesce(F.col(array), _zeros(0))
        return F.concat(F.slice(F.concat(known, _zeros(31)), 1, offset), value)

    return y.join(t, key, "full_outer").select(
        *key, first.alias(month), *[placed(a).alias(a) for a in metrics]
    )


def build_months(
    rows: DataFrame,
    key: Sequence[str],
    day: str,
    through: dt.date,
    metrics: dict[str, str | Column],
    month: str = "month",
) -> DataFrame:
    """The arrays of all months up to ``through`` in one pass, equal to day-by-day steps.

    ``metrics`` maps an array to the column whose values it adds up by day, so ``rows`` may be daily
    rows or, where a value adds up, the facts themselves. A month is one group with a sum for each
    day: the plan has one grouping whatever the number of months, and a group sends one row of sums
    per map task however many facts it has. Days without rows are 0; the month of ``through`` ends on
    that day. Rows after it, or with a NULL day or key, are left out.
    """
    key = list(key)
    at = F.col(day)
    known = rows.where(at <= F.lit(through)).where(has_all(key))
    named = known.select(
        *key, F.trunc(at, "MM").alias(month), F.dayofmonth(at).alias("__day"),
        *[(F.col(c) if isinstance(c, str) else c).cast("long").alias(f"__{a}") for a, c in metrics.items()],
    )
    slots = [
        F.sum(F.when(F.col("__day") == i, F.col(f"__{a}"))).alias(f"__{a}_{i}") for a in metrics for i in range(1, 32)
    ]
    packed = named.groupBy(*key, month).agg(*slots)
    last = F.dayofmonth(F.least(F.last_day(month), F.lit(through)))

    def array(a: str) -> Column:
        values = [F.coalesce(F.col(f"__{a}_{i}"), F.lit(0).cast("long")) for i in range(1, 32)]
        return F.slice(F.array(*values), F.lit(1), last).alias(a)

    return packed.select(*key, month, *[array(a) for a in metrics])


def build_monthly(
    daily: DataFrame,
    key: Sequence[str],
    day: str,
    through: dt.date,
    metrics: dict[str, str | Column],
    month: str = "month",
) -> DataFrame:
    """:func:`build_months` of the month of ``through`` alone."""
    rows = daily.where(F.col(day) >= F.lit(through.replace(day=1)))
    return build_months(rows, key, day, through, metrics, month)


def array_length_histogram(df: DataFrame, array: str) -> DataFrame:
    """Rows per array length: one length means that no day was lost or applied twice."""
    return df.groupBy(F.size(array).alias("length")).agg(F.count(F.lit(1)).alias("n_rows"))


def unpack_monthly(
    df: DataFrame,
    group: Sequence[str],
    month: str,
    array: str,
    first_offset: int = 0,
) -> DataFrame:
    """Daily totals of a group, from the sum of its arrays at each position.

    ``first_offset=1`` dates position 1 one day late.
    """
    rows = df.select(*group, month, F.posexplode(array).alias("__pos", "__value"))
    return (
        rows.groupBy(*group, month, "__pos")
        .agg(F.sum("__value").alias("value"))
        .select(
            *group, F.date_add(F.col(month), F.col("__pos") + first_offset).alias("day"), "value"
        )
    )
