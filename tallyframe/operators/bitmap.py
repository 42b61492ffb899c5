"""Active days as bits of one integer, and the flags read from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 32

# The bits that stand for the last month, week and day when bit 31 is the
# snapshot day.
ACTIVITY_MASKS = {
    "dim_is_monthly_active": 0xFFFFFFFF,
    "dim_is_weekly_active": 0xFE000000,
    "dim_is_daily_active": 0x80000000,
}


def day_bit(day: Column, snapshot: dt.date, anchor_bit: int) -> Column:
    """The bit of a day: ``anchor_bit`` for the snapshot day, one lower for each day before."""
    shift = F.lit(anchor_bit) - F.datediff(F.lit(snapshot), day)
    return F.call_function("shiftleft", F.lit(1).cast("long"), shift)


def datelist_int(
    df: DataFrame,
    dates: str,
    snapshot: dt.date,
    start: dt.date,
    end: dt.date,
    anchor_bit: int = WIDTH - 1,
    name: str = "datelist_int",
) -> DataFrame:
    """Adds a bitmap of the active days in ``[start, end]``.

    A narrow map over the array: no cross join with a day series and no shuffle. With
    ``anchor_bit=32`` the snapshot day gets the value 2**32, which a 32-bit mask cuts off. A range
    with days that have no bit is an error; :func:`datelist_words` takes ranges of any length.
    """
    if start < snapshot - dt.timedelta(days=anchor_bit) or end > snapshot + dt.timedelta(days=62 - anchor_bit):
        raise ValueError(f"{start} to {end} does not fit into the bits around {snapshot}")
    inside = F.filter(dates, lambda d: d.between(F.lit(start), F.lit(end)))
    bits = F.aggregate(
        inside,
        F.lit(0).cast("long"),
        lambda acc, d: acc.bitwiseOR(day_bit(d, snapshot, anchor_bit)),
    )
    return df.withColumn(name, bits)


def datelist_words(
    df: DataFrame, dates: str, snapshot: dt.date, start: dt.date, width: int = WIDTH, name: str = "datelist_words"
) -> DataFrame:
    """Adds the bitmap of the active days in ``[start, snapshot]`` as an array of integers.

    Word 0 is that of :func:`datelist_int`, ending on the snapshot day; each further word holds the
    ``width`` days before.
    """
    n = (snapshot - start).days // width + 1
    inside = F.filter(dates, lambda d: d.between(F.lit(start), F.lit(snapshot)))
    # how many days ago, so that the plan is the same for any number of words
    ago = F.transform(inside, lambda d: F.datediff(F.lit(snapshot), d))

    def word(k: Column) -> Column:
        return F.aggregate(
            F.filter(ago, lambda x: F.floor(x / width) == k),
            F.lit(0).cast("long"),
            lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(width - 1) - (x % width).cast("int"))),
        )

    return df.withColumn(name, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), word))


def activity_flags(
    df: DataFrame, bitmap: str = "datelist_int", masks: dict[str, int] | None = None
) -> DataFrame:
    """Adds one boolean per mask: whether any of its bits is set."""
    flags = {
        name: F.bit_count(F.col(bitmap).bitwiseAND(F.lit(mask).cast("long"))) > 0
        for name, mask in (masks or ACTIVITY_MASKS).items()
    }
    return df.withColumns(flags)
