"""Growth accounting: how an entity's activity changes from period to period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def growth_states(
    df: DataFrame, key: str, period: str, horizon: int | None = None
) -> DataFrame:
    """A row per entity and period from its first to its last active period.

    Activity is gathered as a set of periods before the single shuffle. The gaps then fill
    themselves: each active period is followed by the idle ones up to the next, so neither a
    join with a grid nor a window is needed. With ``horizon`` the rows of an entity run on to
    that period, which reports its final retirement.
    """
    seen = F.col("__seen")
    packed = (
        df.where(F.col(key).isNotNull() & F.col(period).isNotNull())
        .groupBy(key)
        .agg(F.sort_array(F.collect_set(F.col(period).cast("int"))).alias("__seen"))
    )
    until = F.element_at(seen, -1)
    if horizon is not None:
        until = F.greatest(until, F.lit(horizon))
    spans = F.transform(
        seen,
        lambda p, i: F.struct(
            F.get(seen, i - 1).alias("before"),
            p.alias("active"),
            F.coalesce(F.get(seen, i + 1) - 1, until).alias("upto"),
        ),
    )
    active = F.col("period") == F.col("active")
    gap = F.col("active") - F.col("before")
    state = (
        F.when(active & F.col("before").isNull(), "New")
        .when(active & (gap == 1), "Continued Playing")
        .when(active, "Returned from Retirement")
        .when(F.col("period") - F.col("active") == 1, "Retired")
        .otherwise("Stayed Retired")
    )
    return (
        packed.select(key, F.get(seen, F.lit(0)).alias("first_active"), F.inline(spans))
        .select(
            key,
            "first_active",
            "before",
            "active",
            F.explode(F.sequence("active", "upto")).alias("period"),
        )
        .select(
            key,
            active.alias("is_active"),
            state.alias("state"),
            "first_active",
            F.when(active, F.col("before")).otherwise(F.col("active")).alias("last_active"),
            "period",
        )
    )
