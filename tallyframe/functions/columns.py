"""Column helpers. All of them are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_all(keys: Sequence[str]) -> Column:
    """No key is NULL. Each test reaches the scan, which ``dropna`` would not."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def class_by_thresholds(
    metric: Column | str, steps: Sequence[tuple[float, str]], otherwise: str
) -> Column:
    """The label of the first step that ``metric`` exceeds (strictly).

    ``steps`` run from the highest bound down. A NULL metric gets ``otherwise``.
    """
    metric = _col(metric)
    label = None
    for bound, name in steps:
        hit = metric > F.lit(bound)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(F.lit(otherwise))


def divisor_or_one(c: Column | str) -> Column:
    """``c``, or 1 where it is 0; ANSI mode raises on division by zero."""
    c = _col(c)
    return F.when(c == 0, F.lit(1)).otherwise(c)


def append_item(history: Column | str, item: Column | str, present: Column) -> Column:
    """``history`` with ``item`` at its end where ``present``; a missing history starts there."""
    history, item = _col(history), _col(item)
    one = F.array(item)
    return F.when(~present, history).when(history.isNull(), one).otherwise(F.concat(history, one))


def same(left: Sequence[Column | str], right: Sequence[Column | str]) -> Column:
    """All pairs equal, where NULL equals NULL."""
    pairs = [_col(a).eqNullSafe(_col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda a, b: a & b, pairs)


def differs(
    left: Sequence[Column | str], right: Sequence[Column | str], null_safe: bool = True
) -> Column:
    """Any pair differs. Without ``null_safe`` a comparison with NULL counts as no difference."""
    if null_safe:
        return ~same(left, right)
    pairs = [
        F.coalesce(_col(a) != _col(b), F.lit(False)) for a, b in zip(left, right, strict=True)
    ]
    return reduce(lambda a, b: a | b, pairs)


def clock_to_minutes(c: Column | str) -> Column:
    """``"MM:SS"`` in minutes. Seconds may be missing; text that is no number gives NULL."""
    c = _col(c)
    minutes = F.split_part(c, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(c, F.lit(":"), F.lit(2))
    seconds = F.when(seconds == "", F.lit(0.0)).otherwise(seconds.try_cast("double"))
    return minutes + seconds / 60


def contains_token(c: Column | str, token: str) -> Column:
    """Whether text holds ``token``; NULL text does not."""
    return F.coalesce(F.instr(_col(c), token) > 0, F.lit(False))


def json_object(**props: Column | str) -> Column:
    """A JSON object of the given properties that keeps NULL ones."""
    fields = [_col(c).alias(name) for name, c in props.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def year_start(year: Column | str) -> Column:
    """1 January of an integer year."""
    return F.make_date(_col(year), F.lit(1), F.lit(1))


def as_cents(amount: Column | str) -> Column:
    """A two-decimal amount as an integer, so that sums are exact in any order of addition."""
    return F.round(_col(amount) * 100).cast("long")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_of(duration: str) -> int:
    """Seconds of a duration such as ``"5 minutes"``; one of milliseconds has to be whole seconds."""
    number, unit = duration.split()
    if unit.rstrip("s") == "millisecond":
        if int(number) % 1000:
            raise ValueError(f"{duration} is not a whole number of seconds")
        return int(number) // 1000
    return int(number) * _UNIT_SECONDS[unit.rstrip("s")]
