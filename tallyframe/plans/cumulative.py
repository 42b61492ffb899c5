"""Yearly histories of customers. Table: orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_cents, class_by_thresholds
from ..operators import (
    build_grouped,
    build_history,
    cumulate_grouped,
    cumulate_history,
    days_between,
    history_ratio,
    unnest_history,
)
from .registry import joined, query, table, text

KEY, ATTRS = ["o_custkey"], ["priority"]

# Cents per year, and average cents per order.
SPEND_STEPS = [(60_000_000, "star"), (40_000_000, "good"), (20_000_000, "average")]
ORDER_STEPS = [(35_000_000, "star"), (25_000_000, "good"), (15_000_000, "average")]


def years_of(spark: SparkSession, folder: str) -> tuple[int, int]:
    """The first and the last year of the orders."""
    year = F.year("o_orderdate")
    first, last = table(spark, folder, "orders").agg(F.min(year), F.max(year)).first()
    return (first, last) if last else (1, 1)  # no order at all


def orders_of(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    orders = table(spark, folder, "orders")
    rows = days_between(orders, "o_orderdate", dt.date(first, 1, 1), dt.date(last, 12, 31))
    return rows.select(
        "o_custkey",
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        as_cents("o_totalprice").alias("cents"),
        F.col("o_orderpriority").alias("priority"),
    )


def seasons(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """One row per customer and year."""
    return (
        orders_of(spark, folder, first, last)
        .groupBy("o_custkey", "year")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("cents").alias("cents"),
            F.max("priority").alias("priority"),
        )
    )


def season_item() -> Column:
    return F.struct("year", "n_orders", "cents")


def spend_class() -> tuple[str, Column]:
    return "spend_class", class_by_thresholds("cents", SPEND_STEPS, "bad")


def history_state(spark: SparkSession, folder: str) -> DataFrame:
    first, last = years_of(spark, folder)
    prev = build_history(
        seasons(spark, folder, first, last - 1), KEY, ATTRS, season_item(),
        period="year", through=last - 1, history="season_stats",
        classify=spend_class(), recency="years_since_last",
    ).withColumnRenamed("year", "current_year")
    today = seasons(spark, folder, last, last)
    return cumulate_history(
        prev, today, KEY, ATTRS, season_item(),
        period_prev="current_year", period_today="year", history="season_stats",
        classify=spend_class(), recency="years_since_last",
    )


_SEASONS_SQL = """
WITH seasons AS (
  SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
         max(o_orderpriority) AS priority
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
  GROUP BY 1, 2)
"""


@query(
    "cumulative_history",
    _SEASONS_SQL
    + """SELECT o_custkey, arg_max(priority, y) AS priority,
       string_agg(y || ':' || n || ':' || cents, ';' ORDER BY y) AS season_stats,
       CASE WHEN arg_max(cents, y) > 60000000 THEN 'star'
            WHEN arg_max(cents, y) > 40000000 THEN 'good'
            WHEN arg_max(cents, y) > 20000000 THEN 'average' ELSE 'bad' END AS spend_class,
       (SELECT max(y) FROM seasons) - max(y) AS years_since_last, (SELECT max(y) FROM seasons) AS current_year
FROM seasons GROUP BY o_custkey""",
)
def cumulative_history(spark: SparkSession, folder: str) -> DataFrame:
    def stats(s: Column) -> Column:
        return F.concat_ws(":", text(s["year"]), text(s["n_orders"]), text(s["cents"]))

    return history_state(spark, folder).select(
        "o_custkey",
        "priority",
        joined("season_stats", stats).alias("season_stats"),
        "spend_class",
        F.col("years_since_last").cast("long").alias("years_since_last"),
        F.col("current_year").cast("long").alias("current_year"),
    )


@query(
    "history_ratio",
    _SEASONS_SQL
    + """SELECT o_custkey,
       arg_max(cents, y) / CASE WHEN arg_min(cents, y) = 0 THEN 1 ELSE arg_min(cents, y) END
         AS ratio
FROM seasons GROUP BY o_custkey""",
)
def customer_history_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return history_ratio(history_state(spark, folder), "season_stats", "cents", KEY)


@query(
    "unnest_history",
    _SEASONS_SQL + "SELECT o_custkey, CAST(y AS BIGINT) AS year, n AS n_orders, cents FROM seasons",
)
def customer_unnest_history(spark: SparkSession, folder: str) -> DataFrame:
    rows = unnest_history(history_state(spark, folder), KEY, "season_stats")
    return rows.withColumn("year", F.col("year").cast("long"))


@query(
    "cumulative_scalar",
    _SEASONS_SQL
    + """SELECT o_custkey, arg_max(priority, y) AS priority,
       string_agg(CAST(cents AS VARCHAR), ';' ORDER BY y) AS cents_history,
       (SELECT max(y) FROM seasons) AS current_year FROM seasons GROUP BY o_custkey""",
)
def cumulative_scalar(spark: SparkSession, folder: str) -> DataFrame:
    """A history of plain numbers, ordered by customer."""
    cents = F.col("cents")
    first, last = years_of(spark, folder)
    prev = build_history(
        seasons(spark, folder, first, last - 1), KEY, ATTRS, cents,
        period="year", through=last - 1, history="cents_history",
    ).withColumnRenamed("year", "current_year")
    state = cumulate_history(
        prev, seasons(spark, folder, last, last), KEY, ATTRS, cents,
        period_prev="current_year", period_today="year", history="cents_history",
    )
    return state.select(
        "o_custkey",
        "priority",
        joined("cents_history").alias("cents_history"),
        F.col("current_year").cast("long").alias("current_year"),
    ).orderBy("o_custkey")


def order_item() -> Column:
    return F.struct("o_orderkey", "cents")


def order_class() -> tuple:
    return "order_class", lambda avg: class_by_thresholds(avg, ORDER_STEPS, "bad")


#: Order keys in one part of a history: an array holds as many orders at most.
PART_KEYS = 1000


def grouped_state(spark: SparkSession, folder: str, part_keys: int = PART_KEYS) -> DataFrame:
    """A customer's orders lie in parts by ranges of their keys, so no array grows with the table."""
    spread = F.floor(F.col("o_orderkey") / part_keys)
    first, last = years_of(spark, folder)
    prev = build_grouped(
        orders_of(spark, folder, first, last - 1), KEY, ATTRS, order_item(),
        metric="cents", period="year", through=last - 1, history="orders",
        classify=order_class(), active="is_active", n_parts=None, spread=spread,
    )
    return cumulate_grouped(
        prev, orders_of(spark, folder, last, last), KEY, ATTRS, order_item(),
        metric="cents", period=last, period_name="year", history="orders",
        classify=order_class(), active="is_active", n_parts=None, spread=spread,
    )


@query(
    "cumulative_grouped",
    """
WITH o AS (
  SELECT o_custkey, o_orderkey, o_orderkey // 1000 AS part, year(o_orderdate) AS y, o_orderpriority AS p,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL),
yearly AS (SELECT o_custkey, y, avg(cents) AS av, max(p) AS p FROM o GROUP BY ALL),
whole AS (
  SELECT o_custkey, arg_min(p, y) FILTER (p IS NOT NULL) AS priority, arg_max(av, y) AS av,
         max(y) = (SELECT max(y) FROM o) AS is_active
  FROM yearly GROUP BY o_custkey),
parts AS (SELECT o_custkey, part FROM o UNION SELECT o_custkey, 0 FROM o),
listed AS (
  SELECT o_custkey, part, string_agg(o_orderkey || ':' || cents || ':1', ';' ORDER BY y, o_orderkey) AS orders
  FROM o GROUP BY ALL)
SELECT o_custkey, part, priority, coalesce(orders, '') AS orders,
       CASE WHEN av > 35000000 THEN 'star' WHEN av > 25000000 THEN 'good'
            WHEN av > 15000000 THEN 'average' ELSE 'bad' END AS order_class,
       is_active, (SELECT max(y) FROM o) AS year
FROM parts JOIN whole USING (o_custkey) LEFT JOIN listed USING (o_custkey, part)
""",
)
def cumulative_grouped(spark: SparkSession, folder: str) -> DataFrame:
    def order(s: Column) -> Column:
        return F.concat_ws(":", text(s["o_orderkey"]), text(s["cents"]), text(s["copies"]))

    return grouped_state(spark, folder).select(
        "o_custkey",
        F.col("part").cast("long").alias("part"),
        "priority",
        joined("orders", order).alias("orders"),
        "order_class",
        "is_active",
        F.col("year").cast("long").alias("year"),
    )
