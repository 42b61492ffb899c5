"""Joins whose heavy keys are found in the data and spread, and rows dealt over tasks by their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of the rows from which a key counts as heavy, keys that the sketch tracks, and tasks that a
#: heavy key is spread over for each of these shares.
HEAVY_SHARE, TRACKED = 0.005, 20_000
#: Rows that one task sorts or adds up.
TASK_ROWS = 500_000


def task_count(df: DataFrame, n_rows: int) -> int:
    """Tasks of about ``TASK_ROWS`` rows each; fewer rows than that are one task."""
    wanted = -(-n_rows // TASK_ROWS)
    return max(wanted, df.sparkSession.sparkContext.defaultParallelism) if wanted > 1 else 1


def dealt(df: DataFrame, n_tasks: int, *keys: Column | str) -> DataFrame:
    """``df`` dealt by ``keys`` over ``n_tasks`` tasks; for one task Spark's own number is left.

    Adaptive execution joins partitions up to a number of compressed bytes and at first only down to
    the number of cores, so rows with few bytes meet by the million in one task. A number that is
    given stays, and with :func:`task_count` the memory of a task does not grow with the table.
    """
    return df.repartition(n_tasks, *keys) if n_tasks > 1 else df


def sorted_in(df: DataFrame, n_tasks: int, order: Sequence[Column]) -> DataFrame:
    """``df`` in the given order, cut into ``n_tasks`` ranges; for one task Spark's own number is left.

    The other columns follow where the ranges are cut, so rows that tie need not be one task.
    """
    if n_tasks == 1:
        return df.orderBy(*order)
    return df.repartitionByRange(n_tasks, *order, *df.columns).sortWithinPartitions(*order)


def _hashed(key: Sequence[str]) -> Column:
    return F.xxhash64(*key)


def heavy_keys(df: DataFrame, key: Sequence[str], share: float = HEAVY_SHARE, tracked: int = TRACKED) -> dict[int, float]:
    """Hashes of the keys with at least ``share`` of the rows, and that share, by a frequent-items sketch.

    One pass that combines in each task; the sketch has ``tracked`` entries and the result at most
    1 / share, whatever the table. A count may be too high by rows / tracked, never by more, so a
    heavy key is not missed; one that is almost heavy may be listed as well.
    """
    most = int(1 / share) + 1
    found = df.agg(
        F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", _hashed(key), F.lit(most), F.lit(tracked)).alias("top")
    ).first()
    return {r["item"]: r["count"] / found.n for r in found.top or [] if r["count"] >= share * found.n}


def spread_join(
    facts: DataFrame,
    dim: DataFrame,
    key: Sequence[str],
    how: str = "inner",
    share: float = HEAVY_SHARE,
    heavy: dict[int, float] | None = None,
) -> DataFrame:
    """``facts`` joined with ``dim`` on ``key``; rows of heavy keys are dealt over several tasks.

    A key with s of the facts is dealt into about s / share parts, by a hash of the whole row; the
    rows of ``dim`` that match it are repeated for each part. All other keys are joined as they are.
    ``how`` is inner or left. The result is exact whatever the sketch says: ``heavy`` (by default
    :func:`heavy_keys` of the facts) decides only where rows meet. Equal fact rows stay together, so
    copies should be reduced before.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a {how} join would repeat rows of the dimension")
    key = list(key)
    heavy = heavy_keys(facts, key, share) if heavy is None else heavy
    parts = F.lit(1)
    for item, part in heavy.items():
        parts = F.when(_hashed(key) == item, max(2, round(part / share))).otherwise(parts)
    dealt = facts.withColumn("__part", F.pmod(F.xxhash64(*facts.columns), parts).cast("int"))
    repeated = dim.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(repeated, [*key, "__part"], how).drop("__part")
