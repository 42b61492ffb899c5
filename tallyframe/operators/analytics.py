"""Dashboards and rankings: grouping sets, top rows, win totals, rolling windows, streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def win_flag(team: str, home_team: str, home_wins: str) -> Column:
    """Whether the row's team won: at home with a home win, or away with a home loss.

    ``home_wins`` is 1 or 0; a NULL in any of the columns counts as no win.
    """
    at_home = F.col(team) == F.col(home_team)
    won = (at_home & (F.col(home_wins) == 1)) | (~at_home & (F.col(home_wins) == 0))
    return F.coalesce(won, F.lit(False))


def grouping_sets_agg(
    df: DataFrame,
    cols: Sequence[str],
    sets: Sequence[Sequence[str]],
    aggs: dict[str, Column],
    group_id: str = "grp_id",
) -> DataFrame:
    """Several groupings in one pass, told apart by the bit vector of the columns left out."""
    return df.groupingSets([list(s) for s in sets], *cols).agg(
        *[c.alias(name) for name, c in aggs.items()], F.grouping_id(*cols).alias(group_id)
    )


def grouping_sets_totals(
    df: DataFrame,
    cols: Sequence[str],
    sets: Sequence[Sequence[str]],
    sums: dict[str, str],
    distinct: dict[str, tuple[str, str]],
    group_id: str = "grp_id",
) -> DataFrame:
    """Sums and exact conditional distinct counts over several groupings.

    ``sums`` maps a result to the column it adds up; ``distinct`` maps a result to (item, flag): the
    number of different non-NULL items of rows whose flag is true. All pairs of ``distinct`` have the
    same item column.

    Rows are first reduced to one for each (cols, item), which combines before the shuffle. Only these
    are repeated for the sets, and reduced once more to one row for each item of a group, so that
    counting items is a sum. No step gathers a group in one task.
    """
    cols = list(cols)
    items = {item for item, _ in distinct.values()}
    if len(items) != 1:
        raise ValueError(f"distinct counts of one item column, not of {sorted(items)}")
    item = items.pop()
    totals = [F.sum(c).alias(name) for name, c in sums.items()]
    again = [F.sum(name).alias(name) for name in sums]
    either = [F.max(F.coalesce(F.col(flag), F.lit(False))).alias(name) for name, (_, flag) in distinct.items()]
    finest = df.groupBy(*cols, F.col(item).alias("__item")).agg(*totals, *either)
    each = finest.groupingSets([[*s, "__item"] for s in sets], *cols, "__item").agg(
        *again, *[F.max(name).alias(name) for name in distinct],
        F.shiftright(F.grouping_id(*cols, "__item"), 1).alias(group_id),  # the item is in every set
    )
    counted = [F.count_if(F.col(name) & F.col("__item").isNotNull()).alias(name) for name in distinct]
    return each.groupBy(*cols, group_id).agg(*again, *counted).select(*cols, *sums, *distinct, group_id)


def top_n(
    df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], by: str, n: int = 1
) -> DataFrame:
    """The ``n`` groups with the largest ``by``; ties go to the smaller key.

    Each task keeps its best ``n`` (TakeOrderedAndProject): there is no global sort.
    """
    return (
        df.groupBy(*keys)
        .agg(*[c.alias(name) for name, c in aggs.items()])
        .orderBy(F.col(by).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys])
        .limit(n)
    )


def unpivot_sides(
    games: DataFrame, home: str, away: str, home_wins: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Two rows per game, one for each side, from a single scan: (keep, team_id, win)."""
    sides = F.array(
        F.struct(F.col(home).alias("team_id"), (F.col(home_wins) == 1).alias("win")),
        F.struct(F.col(away).alias("team_id"), (F.col(home_wins) == 0).alias("win")),
    )
    return games.select(*keep, F.inline(sides))


#: Rows of a key that one window looks at, beside the rows before them that their counts need.
ROLLING_BLOCK = 100_000


def rolling_max_count(
    df: DataFrame,
    key: str,
    order: str,
    flag: str,
    n: int,
    name: str = "best",
    segment: Column | None = None,
    block: int = ROLLING_BLOCK,
) -> DataFrame:
    """Per key the most flagged rows within any ``n`` rows in a row.

    Rows count once per (key, order, flag). The count of a window is the difference of two running
    totals ``n`` rows apart: a sliding frame would add up all ``n`` rows again for each row.

    No window holds all rows of a key. They are numbered and totalled in segments, which must follow
    ``order`` (by default its day); a segment's numbers go on from the sums of those before it. By its
    number a row then falls into a block of ``block`` rows, and the last ``n`` rows of a block are
    repeated ahead of the next one, where its first rows look back to them.
    """
    part = F.to_date(order) if segment is None else segment
    rows = df.select(F.col(key).alias("__key"), F.col(order).alias("__order"), F.col(flag).alias("__flag"),
                     part.alias("__seg")).distinct()
    inside = Window.partitionBy("__key", "__seg").orderBy("__order", "__flag").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.coalesce(F.col("__flag"), F.lit(False)).cast("long")
    placed = rows.select(
        "__key", "__seg", F.row_number().over(inside).cast("long").alias("__at"), F.sum(hit).over(inside).alias("__total")
    )
    before = Window.partitionBy("__key").orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    start = (
        placed.groupBy("__key", "__seg").agg(F.max("__at").alias("n"), F.max("__total").alias("t"))
        .select(
            F.col("__key").alias("k"), F.col("__seg").alias("s"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t"),
        )
    )
    size = max(block, n)
    same = F.col("__key").eqNullSafe(F.col("k")) & F.col("__seg").eqNullSafe(F.col("s"))
    numbered = placed.join(start, same).select(
        "__key", (F.col("__at") + F.col("n") - 1).alias("__at"), (F.col("__total") + F.col("t")).alias("__total")
    )
    own = F.floor(F.col("__at") / size)
    late = F.col("__at") % size >= size - n
    blocks = numbered.withColumn("__block", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    window = Window.partitionBy("__key", "__block").orderBy("__at")
    counted = blocks.withColumn("__n", F.col("__total") - F.lag("__total", n, 0).over(window))
    # a row repeated for the next block is counted in its own
    return (
        counted.where(F.floor(F.col("__at") / size) == F.col("__block"))
        .groupBy(F.col("__key").alias(key))
        .agg(F.max("__n").alias(name))
    )


def longest_streak(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    predicate: Column,
    segment: Column,
    name: str = "streak",
    count_break: bool = False,
) -> DataFrame:
    """Per key the most rows in a row that satisfy ``predicate``.

    A key's rows are cut into segments, which must follow ``order`` (say, the month of the date
    that leads it). Each segment is reduced to its first, last and best run on its own; only
    these summaries meet per key, where runs that cross segments are joined up. The rows of one
    key are therefore spread over many tasks. With ``count_break`` a streak also counts the
    failing row that precedes it.
    """
    key, order = list(key), list(order)
    ok = F.coalesce(predicate, F.lit(False))
    rows = df.select(
        *key, segment.alias("__seg"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
        ok.cast("long").alias("__ok"),
    )
    inside = (
        Window.partitionBy(*key, "__seg")
        .orderBy(*[f"__o{i}" for i in range(len(order))])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    run, length = F.col("__run"), F.col("__len")
    extra = (run > 0).cast("long") if count_break else F.lit(0).cast("long")
    segments = (
        rows.withColumn("__run", F.sum(1 - F.col("__ok")).over(inside))
        .groupBy(*key, "__seg", "__run")
        .agg((F.sum("__ok")).alias("__len"))
        .withColumn("__len", length + extra)
        .groupBy(*key, "__seg")
        .agg(
            F.max(run).alias("__breaks"),
            F.coalesce(F.max(F.when(run == 0, length)), F.lit(0)).alias("__head"),
            F.max_by(length, run).alias("__tail"),
            F.max(length).alias("__best"),
        )
    )
    before = Window.partitionBy(*key).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    broken = F.col("__breaks") > 0
    island = F.coalesce(F.sum(broken.cast("long")).over(before), F.lit(0))
    head = F.struct(F.col("__island").alias("i"), F.col("__head").alias("n"))
    tail = F.struct((F.col("__island") + 1).alias("i"), F.col("__tail").alias("n"))
    return (
        segments.withColumn("__island", island)
        .select(
            *key, "__best", F.inline(F.when(broken, F.array(head, tail)).otherwise(F.array(head)))
        )
        .groupBy(*key, "i")
        .agg(F.sum("n").alias("__n"), F.max("__best").alias("__best"))
        .groupBy(*key)
        .agg(F.greatest(F.max("__n"), F.max("__best")).alias(name))
    )
