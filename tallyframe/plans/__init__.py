"""The operators applied to the given tables, each with the SQL that gives the same result."""

from . import analytics, cumulative, dates, facts, layout, scd, sessions
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "analytics",
    "cumulative",
    "dates",
    "facts",
    "layout",
    "scd",
    "sessions",
]
