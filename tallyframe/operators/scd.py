"""Slowly changing dimensions, type 2: validity intervals, built whole or by one period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import differs, same, year_start

DATES = ["start_date", "end_date"]


def scd2_build(
    states: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    tracked: Sequence[str],
    period: str,
    snapshot: int,
    to_date: Callable[[Column], Column] = year_start,
    as_written: bool = False,
) -> DataFrame:
    """Intervals in which the tracked columns stay the same, from one state per period.

    An interval carries the latest value of ``attrs``, as repeated merges leave it. All windows and
    groups share the partitioning by ``key``: one shuffle. ``as_written`` reads periods after the
    snapshot too, takes a change from or to NULL for no change, and splits an interval where one
    of ``attrs`` differs.
    """
    key, attrs, tracked = list(key), list(attrs), list(tracked)
    rows = states if as_written else states.where(F.col(period) <= snapshot)
    order = Window.partitionBy(*key).orderBy(period)
    before = [f"__{c}" for c in tracked]
    changed = differs(tracked, before, null_safe=not as_written).cast("int")
    return (
        rows.withColumns({b: F.lag(c).over(order) for b, c in zip(before, tracked, strict=True)})
        .withColumn("__streak", F.sum(changed).over(order))
        .groupBy(*key, "__streak", *tracked, *(attrs if as_written else []))
        .agg(
            *([] if as_written else [F.max_by(a, period).alias(a) for a in attrs]),
            F.min(period).alias("__first"),
            F.max(period).alias("__last"),
        )
        .select(
            *key,
            *attrs,
            *tracked,
            to_date(F.col("__first")).alias("start_date"),
            to_date(F.col("__last")).alias("end_date"),
            to_date(F.lit(snapshot)).alias("snapshot_date"),
        )
    )


def scd2_merge(
    scd: DataFrame,
    current: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    tracked: Sequence[str],
    snapshot: dt.date,
    period: dt.date,
    as_written: bool = False,
) -> DataFrame:
    """The intervals at ``period``, from those at ``snapshot`` and the current state.

    One full outer join of the open intervals with the current rows gives the extended, closed
    and opened intervals; closed history passes through untouched. An entity without a current
    row keeps its last interval. ``as_written`` extends only rows in which every tracked column
    differs, closes and opens those in which any differs, and loses the rest.
    """
    key, attrs, tracked = list(key), list(attrs), list(tracked)
    at = scd.where(F.col("snapshot_date") == F.lit(snapshot))
    columns = [*attrs, *tracked]
    closed = at.where(F.col("end_date") < F.lit(snapshot)).select(*key, *columns, *DATES)
    open_ = at.where(F.col("end_date") == F.lit(snapshot)).select(
        *key, F.struct(*columns, *DATES).alias("old")
    )
    now = current.select(*key, F.struct(*columns).alias("new"))
    both = open_.join(now, key, "full_outer")

    def record(values: str, start: Column, end: Column, names_from: str | None = None) -> Column:
        return F.struct(
            *[F.col(names_from or values)[a].alias(a) for a in attrs],
            *[F.col(values)[c].alias(c) for c in tracked],
            start.alias("start_date"),
            end.alias("end_date"),
        )

    old, new, today = F.col("old"), F.col("new"), F.lit(period)
    opened = record("new", today, today)
    extended = record("new", old["start_date"], today)
    pairs = [old[c] for c in tracked], [new[c] for c in tracked]
    if as_written:
        kept = record("old", old["start_date"], old["end_date"], names_from="new")
        nothing = F.filter(F.array(opened), lambda _: F.lit(False))
        each = [differs([a], [b], null_safe=False) for a, b in zip(*pairs, strict=True)]
        all_differ = each[0]
        for d in each[1:]:
            all_differ = all_differ & d
        any_differ = differs(*pairs, null_safe=False)
        records = F.concat(
            F.when(all_differ, F.array(extended)).otherwise(nothing),
            F.when(any_differ, F.array(kept, opened)).otherwise(nothing),
            F.when(old.isNull(), F.array(opened)).otherwise(nothing),
        )
    else:
        kept = record("old", old["start_date"], old["end_date"])
        records = (
            F.when(old.isNull(), F.array(opened))
            .when(new.isNull(), F.array(kept))
            .when(same(*pairs), F.array(extended))
            .otherwise(F.array(kept, opened))
        )
    return (
        closed.unionByName(both.select(*key, F.inline(records)))
        .withColumn("snapshot_date", today)
        .select(*key, *columns, *DATES, "snapshot_date")
    )


def scd2_step(
    open_: DataFrame,
    current: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    tracked: Sequence[str],
    period: dt.date,
) -> DataFrame:
    """The open intervals after ``period`` and those that it closes, from the open ones alone.

    The rows of :func:`scd2_merge` but for the history that was closed before, which a step neither
    reads nor writes. A row is open if its end_date is ``period``.
    """
    key, attrs, tracked = list(key), list(attrs), list(tracked)
    columns = [*attrs, *tracked]
    before = open_.select(*key, F.struct(*columns, *DATES).alias("old"))
    both = before.join(current.select(*key, F.struct(*columns).alias("new")), key, "full_outer")
    old, new, today = F.col("old"), F.col("new"), F.lit(period)

    def record(values: Column, start: Column, end: Column) -> Column:
        return F.struct(*[values[c].alias(c) for c in columns], start.alias("start_date"), end.alias("end_date"))

    opened, extended = record(new, today, today), record(new, old["start_date"], today)
    kept = record(old, old["start_date"], old["end_date"])
    records = (
        F.when(old.isNull(), F.array(opened))
        .when(new.isNull(), F.array(kept))
        .when(same([old[c] for c in tracked], [new[c] for c in tracked]), F.array(extended))
        .otherwise(F.array(kept, opened))
    )
    return both.select(*key, F.inline(records))
