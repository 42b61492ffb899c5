"""Operators for training-data pipelines over texts. Nothing outside this subpackage imports it."""

from . import queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "queries"]
