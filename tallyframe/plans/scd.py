"""Validity intervals of a customer's spend class and activity. Table: orders."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2_build, scd2_merge
from ..operators.cumulate import carry_forward
from ..session import new_path
from ..sources.scd_table import Scd2Table
from .cumulative import seasons, spend_class, years_of
from .registry import query, text

KEY, ATTRS, TRACKED = ["o_custkey"], ["priority"], ["spend_class", "is_active"]


def yearly_states(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The state of every customer in every year since the first order."""
    name, rule = spend_class()
    rows = seasons(spark, folder, first, last)
    states = rows.select("o_custkey", "year", "priority", rule.alias(name))
    return carry_forward(states, KEY, "year", last)


def shown(scd: DataFrame) -> DataFrame:
    dates = ["start_date", "end_date", "snapshot_date"]
    return scd.select(*KEY, *ATTRS, *TRACKED, *[text(d).alias(d) for d in dates])


_STATES_SQL = """
WITH seasons AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS y, max(o_orderpriority) AS priority,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
limits AS (SELECT min(y) AS first, max(y) AS last FROM seasons),
classed AS (
  SELECT o_custkey, y, priority,
         CASE WHEN cents > 60000000 THEN 'star' WHEN cents > 40000000 THEN 'good'
              WHEN cents > 20000000 THEN 'average' ELSE 'bad' END AS spend_class
  FROM seasons),
years AS (SELECT unnest(range(first, last + 1)) AS year FROM limits),
states AS (
  SELECT c.o_custkey, g.year, c.priority, c.spend_class, c.y = g.year AS is_active
  FROM (SELECT *, lead(y) OVER (PARTITION BY o_custkey ORDER BY y) AS nxt FROM classed) c
  JOIN years g ON g.year >= c.y AND g.year < coalesce(c.nxt, (SELECT last + 1 FROM limits))),
"""
_LAST, _BEFORE = "(SELECT last FROM limits)", "(SELECT last - 1 FROM limits)"
_POINTS_SQL = """
points AS (
  SELECT *, lag((spend_class, is_active)) OVER (PARTITION BY o_custkey ORDER BY year)
            IS DISTINCT FROM (spend_class, is_active) AS opens
  FROM states WHERE year <= {limit}),
"""
#: An interval runs from where it opens to the year before the next one; its priority is the latest.
_BUILD_SQL = _POINTS_SQL + """
ends AS (
  SELECT o_custkey, year AS a, coalesce(lead(year) OVER (PARTITION BY o_custkey ORDER BY year) - 1, {limit}) AS b
  FROM points WHERE opens),
scd AS (
  SELECT o_custkey, priority, spend_class, is_active, a || '-01-01' AS start_date,
         b || '-01-01' AS end_date, {stamp} || '-01-01' AS snapshot_date
  FROM ends JOIN points USING (o_custkey) WHERE year = b)
"""
#: As written, an interval also splits where the priority differs.
_SPLIT_SQL = _POINTS_SQL + """
since AS (
  SELECT *, max(CASE WHEN opens THEN year END) OVER (PARTITION BY o_custkey ORDER BY year) AS opened
  FROM points),
scd AS (
  SELECT o_custkey, priority, spend_class, is_active, min(year) || '-01-01' AS start_date,
         max(year) || '-01-01' AS end_date, {stamp} || '-01-01' AS snapshot_date
  FROM since GROUP BY o_custkey, opened, priority, spend_class, is_active)
"""
_COLUMNS = "o_custkey, priority, spend_class, is_active, start_date, end_date, snapshot_date"


@query(
    "scd2_build",
    _STATES_SQL + _BUILD_SQL.format(limit=_LAST, stamp=_LAST)
    + f"SELECT {_COLUMNS} FROM scd",
)
def customer_scd2_build(spark: SparkSession, folder: str) -> DataFrame:
    first, last = years_of(spark, folder)
    return shown(scd2_build(yearly_states(spark, folder, first, last), KEY, ATTRS, TRACKED, "year", last))


@query(
    "scd2_build_as_written",
    _STATES_SQL + _SPLIT_SQL.format(limit=_LAST, stamp=1999)
    + f"SELECT {_COLUMNS} FROM scd",
)
def customer_scd2_build_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Stamped 1999, but built from all years, and split where the priority differs."""
    states = yearly_states(spark, folder, *years_of(spark, folder))
    return shown(scd2_build(states, KEY, ATTRS, TRACKED, "year", 1999, as_written=True))


def merged(spark: SparkSession, folder: str, as_written: bool) -> DataFrame:
    first, last = years_of(spark, folder)
    states = yearly_states(spark, folder, first, last)
    before = scd2_build(states, KEY, ATTRS, TRACKED, "year", last - 1)
    current = states.where(F.col("year") == last)
    return scd2_merge(
        before, current, KEY, ATTRS, TRACKED,
        dt.date(last - 1, 1, 1), dt.date(last, 1, 1), as_written,
    )


_MERGE_SQL = """
, both_sides AS (
  SELECT o_custkey, n.o_custkey IS NOT NULL AS has_new, o.o_custkey IS NOT NULL AS has_old,
         n.spend_class IS DISTINCT FROM o.spend_class AS class_moved, n.is_active IS DISTINCT FROM o.is_active AS active_moved,
         {{'priority': n.priority, 'spend_class': n.spend_class, 'is_active': n.is_active,
           'start_date': {last} || '-01-01', 'end_date': {last} || '-01-01'}} AS opened,
         {{'priority': n.priority, 'spend_class': n.spend_class, 'is_active': n.is_active,
           'start_date': o.start_date, 'end_date': {last} || '-01-01'}} AS extended,
         {{'priority': {old_priority}, 'spend_class': o.spend_class, 'is_active': o.is_active,
           'start_date': o.start_date, 'end_date': o.end_date}} AS ended
  FROM (SELECT * FROM states WHERE year = {last}) n
  FULL JOIN (SELECT * FROM scd WHERE end_date = {before} || '-01-01') o USING (o_custkey)),
made AS (SELECT o_custkey, unnest({records}) AS r FROM both_sides)
SELECT o_custkey, r.priority, r.spend_class, r.is_active, r.start_date, r.end_date, {last} || '-01-01' AS snapshot_date FROM made
UNION ALL
SELECT o_custkey, priority, spend_class, is_active, start_date, end_date, {last} || '-01-01' FROM scd WHERE end_date < {before} || '-01-01'
"""


def _merge_sql(old_priority: str, records: str) -> str:
    return _STATES_SQL + _BUILD_SQL.format(limit=_BEFORE, stamp=_BEFORE) + _MERGE_SQL.format(
        old_priority=old_priority, records=records, last=_LAST, before=_BEFORE
    )


_MERGED = _merge_sql(
    "o.priority",
    """CASE WHEN NOT has_old THEN [opened] WHEN NOT has_new THEN [ended]
       WHEN class_moved OR active_moved THEN [ended, opened] ELSE [extended] END""",
)


@query("scd2_merge", _MERGED)
def customer_scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    return shown(merged(spark, folder, as_written=False))


@query("scd2_stored", _MERGED)
def customer_scd2_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same through tables: the step reads open intervals only and appends those it closes."""
    first, last = years_of(spark, folder)
    states = yearly_states(spark, folder, first, last)
    before, now = dt.date(last - 1, 1, 1), dt.date(last, 1, 1)
    stored = Scd2Table(f"customer_scd_{uuid.uuid4().hex[:12]}", new_path(spark, "customer_scd"), KEY, ATTRS, TRACKED)
    stored.load(scd2_build(states, KEY, ATTRS, TRACKED, "year", last - 1), before)
    stored.step(spark, states.where(F.col("year") == last), before, now)
    out = stored.read(spark, now)
    stored.forget(spark)
    return shown(out)


@query(
    "scd2_merge_as_written",
    _merge_sql(
        "n.priority",
        """CASE WHEN NOT has_old THEN [opened] WHEN NOT has_new THEN []
           WHEN class_moved AND active_moved THEN [extended, ended, opened]
           WHEN class_moved OR active_moved THEN [ended, opened] ELSE [] END""",
    ),
)
def customer_scd2_merge_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Unchanged intervals vanish; doubly changed ones appear both ways."""
    return shown(merged(spark, folder, as_written=True))
