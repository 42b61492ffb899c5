from .columns import (
    append_item,
    as_cents,
    class_by_thresholds,
    clock_to_minutes,
    contains_token,
    differs,
    divisor_or_one,
    has_all,
    json_object,
    same,
    seconds_of,
    year_start,
)

__all__ = [
    "append_item",
    "as_cents",
    "class_by_thresholds",
    "clock_to_minutes",
    "contains_token",
    "differs",
    "divisor_or_one",
    "has_all",
    "json_object",
    "same",
    "seconds_of",
    "year_start",
]
