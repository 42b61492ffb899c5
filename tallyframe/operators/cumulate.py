"""Cumulative snapshots: the state of a period is the state before it joined with its facts.

Every state and every day side has one row per entity, so no key of the full outer joins can be
hot. Rows with a NULL key are left out on both sides: a NULL never matches in a join, and would
come back as a new row in each period.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import append_item, divisor_or_one, has_all
from ..sources.tables import materialise

_PRESENT = "__present"
#: Days in one integer of :func:`build_dates`.
WORD_DAYS = 63


def cumulate_history(
    prev: DataFrame,
    today: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    item: Column,
    *,
    period_prev: str,
    period_today: str,
    history: str,
    classify: tuple[str, Column] | None = None,
    recency: str | None = None,
) -> DataFrame:
    """One step of a history that grows by one item per active period.

    ``item`` (a struct or a scalar) and ``classify`` (a column name of the state and its
    expression) are written over the columns of ``today``. An absent entity keeps its
    attributes, history and class, its period moves on by one and its recency counter rises.
    """
    key, attrs = list(key), list(attrs)
    label = [classify[1].alias("__class")] if classify else []
    t = today.where(has_all(key)).select(
        *key,
        *[F.col(a).alias(f"__t_{a}") for a in attrs],
        item.alias("__item"),
        F.col(period_today).alias("__period"),
        *label,
        F.lit(True).alias(_PRESENT),
    )
    state = [history, period_prev] + ([classify[0]] if classify else [])
    state += [recency] if recency else []
    y = prev.where(has_all(key)).select(*key, *attrs, *state)

    here = F.col(_PRESENT).isNotNull()
    out = [F.coalesce(F.col(f"__t_{a}"), F.col(a)).alias(a) for a in attrs]
    out.append(append_item(history, "__item", here).alias(history))
    if classify:
        name = classify[0]
        out.append(F.when(here, F.col("__class")).otherwise(F.col(name)).alias(name))
    if recency:
        out.append(F.when(here, F.lit(0)).otherwise(F.col(recency) + 1).alias(recency))
    out.append(F.coalesce(F.col("__period"), F.col(period_prev) + 1).alias(period_prev))
    return y.join(t, key, "full_outer").select(*key, *out)


def build_history(
    periods: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    item: Column,
    *,
    period: str,
    through: int,
    history: str,
    classify: tuple[str, Column] | None = None,
    recency: str | None = None,
) -> DataFrame:
    """The state after ``through`` in one pass, equal to :func:`cumulate_history` step by step.

    ``periods`` holds one row per entity and period. For back-fills: the plan does not grow with
    the number of periods, and an entity's array is as long as its active periods.
    """
    key, attrs = list(key), list(attrs)
    label = [classify[1].alias("c")] if classify else []
    rows = periods.where(F.col(period) <= through).where(has_all(key))
    packed = rows.groupBy(*key).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(period).alias("p"), *[F.col(a) for a in attrs], *label, item.alias("i")
                )
            )
        ).alias("__rows")
    )

    def last_known(name: str) -> Column:
        known = F.filter("__rows", lambda r: r[name].isNotNull())
        return F.get(known, F.size(known) - 1)[name].alias(name)

    out = [last_known(a) for a in attrs]
    out.append(F.transform("__rows", lambda r: r["i"]).alias(history))
    last = F.element_at("__rows", -1)
    if classify:
        out.append(last["c"].alias(classify[0]))
    if recency:
        out.append((F.lit(through) - last["p"]).cast("int").alias(recency))
    out.append(F.lit(through).alias(period))
    return packed.select(*key, *out)


def pack_items(
    facts: DataFrame,
    key: Sequence[str],
    item: Column,
    n_parts: int | None = 1,
    spread: Column | None = None,
    copies: str = "copies",
) -> DataFrame:
    """The distinct items of an entity in several arrays: rows (key, part, items).

    ``item`` is a struct; it gets a last field ``copies``, the number of its repetitions. Repetitions
    are counted before the shuffle, so they neither travel nor fill an array. An item lies in the
    part that ``spread``, an integer over the columns of ``facts``, names modulo ``n_parts`` (by
    default the hash of the item). With ``n_parts`` None the part is ``spread`` itself: where it
    numbers ranges of the items' keys, no array outgrows its range, however large an entity gets.
    Parts without items have no row.
    """
    key = list(key)
    place = F.xxhash64(item) if spread is None else spread
    place = place.cast("long") if n_parts is None else F.pmod(place, F.lit(n_parts)).cast("long")
    counted = (
        facts.where(has_all(key))
        .select(*key, place.alias("part"), item.alias("__item"))
        .groupBy(*key, "part", "__item")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    return counted.groupBy(*key, "part").agg(
        F.sort_array(F.collect_list(F.col("__item").withField(copies, F.col("__n")))).alias("items")
    )


def _with_own_parts(entities: DataFrame, items: DataFrame, key: Sequence[str], n_parts: int | None) -> DataFrame:
    """(key, part, items): all ``n_parts`` of every entity, or part 0 and those that have items."""
    parts = F.explode(F.sequence(F.lit(0), F.lit((n_parts or 1) - 1)).cast("array<long>"))
    empty = F.array().cast(items.schema["items"].dataType)
    joined = entities.select(*key, parts.alias("part")).join(items, [*key, "part"], "full_outer")
    return joined.withColumn("items", F.coalesce(F.col("items"), empty))


def cumulate_grouped(
    prev: DataFrame,
    facts: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    item: Column,
    *,
    metric: str,
    period: int,
    period_name: str,
    history: str,
    classify: tuple[str, Callable[[Column], Column]],
    active: str,
    n_parts: int | None = 1,
    spread: Column | None = None,
) -> DataFrame:
    """One step of a history to which an entity adds *all* its facts of the period.

    The class comes from the average of ``metric`` over those facts; attributes keep their first
    value. The history is spread over parts, see :func:`pack_items`: an entity has ``n_parts`` rows, or,
    where that is None, one for part 0 and one for each part with items. Class, activity and attributes
    stand on each. ``n_parts`` and ``spread`` must stay the same from step to step.
    """
    key, attrs = list(key), list(attrs)
    name, rule = classify
    today = facts.where(has_all(key)).groupBy(*key).agg(
        F.avg(F.col(metric).cast("double")).alias("__avg"), *[F.max(a).alias(f"__t_{a}") for a in attrs]
    )
    items = _with_own_parts(today, pack_items(facts, key, item, n_parts, spread), key, n_parts)
    before = prev.where(has_all(key))
    here = F.col(_PRESENT).isNotNull()
    # what stands on every part comes from part 0, which is always there
    entities = (
        before.where("part = 0").select(*key, *attrs, name, period_name)
        .join(today.withColumn(_PRESENT, F.lit(True)), key, "full_outer")
        .select(
            *key,
            *[F.coalesce(F.col(a), F.col(f"__t_{a}")).alias(a) for a in attrs],
            F.when(here, rule(F.col("__avg"))).otherwise(F.col(name)).alias(name),
            here.alias(active),
            F.when(here, F.lit(period)).otherwise(F.col(period_name) + 1).alias(period_name),
        )
    )
    grown = (
        F.when(F.col("items").isNull(), F.col(history))
        .when(F.col(history).isNull(), F.col("items"))
        .otherwise(F.concat(F.col(history), F.col("items")))
    )
    parts = before.select(*key, "part", history).join(items, [*key, "part"], "full_outer")
    return parts.select(*key, "part", grown.alias(history)).join(entities, key).select(
        *key, "part", *attrs, history, name, active, period_name
    )


def build_grouped(
    facts: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    item: Column,
    *,
    metric: str,
    period: str,
    through: int,
    history: str,
    classify: tuple[str, Callable[[Column], Column]],
    active: str,
    n_parts: int | None = 1,
    spread: Column | None = None,
) -> DataFrame:
    """The state after ``through`` in one pass, equal to :func:`cumulate_grouped` step by step.

    Items are in the order of their periods. The class comes from the last active period, the
    attributes from the first period that has a value.
    """
    key, attrs = list(key), list(attrs)
    name, rule = classify
    rows = facts.where(F.col(period) <= through).where(has_all(key))
    dated = F.struct(F.col(period).alias("p"), item.alias("i"))
    place = F.xxhash64(item) if spread is None else spread
    items = pack_items(rows, key, dated, n_parts, place).withColumn(
        "items", F.transform("items", lambda r: r["i"].withField("copies", r["copies"]))
    )
    entities = (
        rows.groupBy(*key, period)
        .agg(F.avg(F.col(metric).cast("double")).alias("__avg"), *[F.max(a).alias(a) for a in attrs])
        .groupBy(*key)
        .agg(
            F.max(F.struct(period, "__avg")).alias("__last"),
            *[F.min_by(a, F.when(F.col(a).isNotNull(), F.col(period))).alias(a) for a in attrs],
        )
    )
    return _with_own_parts(entities, items, key, n_parts).join(entities, key).select(
        *key,
        "part",
        *attrs,
        F.col("items").alias(history),
        rule(F.col("__last.__avg")).alias(name),
        (F.col(f"__last.{period}") == through).alias(active),
        F.lit(through).alias(period),
    )


def carry_forward(
    states: DataFrame, key: Sequence[str], period: str, horizon: int, active: str = "is_active"
) -> DataFrame:
    """A row for every period from an entity's first to ``horizon``.

    Idle periods repeat the last active row with ``active`` false, as the cumulative steps do.
    """
    order = Window.partitionBy(*key).orderBy(period)
    until = F.coalesce(F.lead(period).over(order) - 1, F.lit(horizon))
    others = [c for c in states.columns if c != period]
    return (
        states.where(F.col(period) <= horizon)
        .select(*others, F.col(period).alias("__from"), until.alias("__until"))
        .select(*others, "__from", F.explode(F.sequence("__from", "__until")).alias(period))
        .select(*others, period, (F.col(period) == F.col("__from")).alias(active))
    )


def history_ratio(
    df: DataFrame, history: str, field: str, keys: Sequence[str], name: str = "ratio"
) -> DataFrame:
    """Last history value over the first one (0 counts as 1), best first."""
    first = F.get(F.col(history), F.lit(0))[field]
    last = F.get(F.col(history), F.size(history) - 1)[field]
    return df.select(*keys, (last / divisor_or_one(first)).alias(name)).orderBy(
        F.col(name).desc_nulls_first(), *[F.col(k).asc_nulls_last() for k in keys]
    )


def unnest_history(df: DataFrame, keys: Sequence[str], history: str) -> DataFrame:
    """The history as rows again. Empty and NULL histories give none."""
    return df.select(*keys, F.inline(F.col(history)))


def days_between(events: DataFrame, ts: str, first: dt.date, last: dt.date) -> DataFrame:
    """Events of the days ``first`` to ``last``.

    The bounds have the type of the raw column, so the range reaches the Parquet scan.
    """
    kind = events.schema[ts].dataType
    begin = F.lit(first).cast(kind)
    end = F.lit(last + dt.timedelta(days=1)).cast(kind)
    return events.where((F.col(ts) >= begin) & (F.col(ts) < end))


def active_days(
    events: DataFrame, keys: Sequence[str], ts: str, day: dt.date, also: Sequence[str] = ()
) -> DataFrame:
    """Entities with at least one event on ``day``: rows (keys, also, active_date).

    The columns of ``also`` are told apart too, but may be NULL.
    """
    return (
        days_between(events, ts, day, day)
        .where(has_all(keys))
        .select(*keys, *also)
        .distinct()
        .withColumn("active_date", F.lit(day))
    )


def cumulate_dates(
    prev: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    dates: str,
    snapshot: str,
    active_date: str = "active_date",
) -> DataFrame:
    """One step of the list of active days. Days have to be applied in order."""
    keys = list(keys)
    t = today.where(has_all(keys)).select(*keys, F.col(active_date).alias("__day"))
    y = prev.where(has_all(keys)).select(*keys, dates, snapshot)
    day = F.col("__day")
    return y.join(t, keys, "full_outer").select(
        *keys,
        append_item(dates, day, day.isNotNull()).alias(dates),
        F.coalesce(day, F.date_add(F.col(snapshot), 1)).alias(snapshot),
    )


def build_dates(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: dt.date,
    through: dt.date,
    dates: str,
    snapshot: str,
) -> DataFrame:
    """The list of active days after ``through`` in one pass, equal to day-by-day steps.

    Days are gathered as bits of integers, one for each key and run of 63 days: plain hash aggregation
    that combines on the map side, so each map task sends one row per entity and run however many
    events it has. The plan is the same for any number of days, and what meets per entity is one
    integer for each run of days in which it was active. They become a sorted array at the end.
    """
    keys = list(keys)
    offset = F.datediff(F.to_date(ts), F.lit(start))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__offset") % WORD_DAYS)
    words = (
        days_between(events, ts, start, through)
        .where(has_all(keys))
        .select(*keys, offset.alias("__offset"))
        .groupBy(*keys, F.floor(F.col("__offset") / WORD_DAYS).cast("int").alias("__word"))
        .agg(F.bit_or(bit).alias("__bits"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("__word", "__bits"))).alias("__words"))
    )

    def days(w: Column) -> Column:
        hit = F.filter(
            F.sequence(F.lit(0), F.lit(WORD_DAYS - 1)), lambda b: F.call_function("getbit", w["__bits"], b) == 1
        )
        return F.transform(hit, lambda b: F.date_add(F.lit(start), w["__word"] * WORD_DAYS + b))

    return words.select(
        *keys, F.flatten(F.transform("__words", days)).alias(dates), F.lit(through).alias(snapshot)
    )
