"""Growth states, dashboards, rankings, rolling windows, streaks. Tables: orders, lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    dealt,
    grouping_sets_totals,
    growth_states,
    longest_streak,
    rolling_max_count,
    sorted_in,
    spread_join,
    task_count,
    top_k_per_group,
    top_n,
    unpivot_sides,
    win_flag,
)
from .registry import query, table

_GROWTH_SQL = """
WITH stints AS (
  SELECT o_custkey, y, min(y) OVER (PARTITION BY o_custkey) AS entered,
         lag(y) OVER (PARTITION BY o_custkey ORDER BY y) AS earlier,
         coalesce(lead(y) OVER (PARTITION BY o_custkey ORDER BY y), {after}) - y AS n_years
  FROM (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders) WHERE o_custkey IS NOT NULL),
told AS (SELECT *, unnest(range(n_years)) AS gap FROM stints)
SELECT o_custkey, gap = 0 AS is_active,
       CASE gap WHEN 1 THEN 'Retired'
                WHEN 0 THEN CASE y - earlier WHEN 1 THEN 'Continued Playing'
                            ELSE CASE WHEN earlier IS NULL THEN 'New' ELSE 'Returned from Retirement' END END
                ELSE 'Stayed Retired' END AS state,
       CAST(entered AS BIGINT) AS first_active,
       CAST(CASE gap WHEN 0 THEN earlier ELSE y END AS BIGINT) AS last_active,
       CAST(y + gap AS BIGINT) AS period
FROM told
"""


def customer_years(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))


def states_shown(states: DataFrame) -> DataFrame:
    return states.withColumns(
        {c: F.col(c).cast("long") for c in ("first_active", "last_active", "period")}
    ).orderBy("o_custkey", "period")


@query("growth_states", _GROWTH_SQL.format(after="y + 1"))
def customer_growth_states(spark: SparkSession, folder: str) -> DataFrame:
    return states_shown(growth_states(customer_years(spark, folder), "o_custkey", "year"))


@query("growth_states_horizon", _GROWTH_SQL.format(after="(SELECT max(year(o_orderdate)) + 1 FROM orders)"))
def customer_growth_states_horizon(spark: SparkSession, folder: str) -> DataFrame:
    """Up to the last year of the table for everyone, which shows final retirements."""
    rows = customer_years(spark, folder)
    last = rows.agg(F.max("year")).first()[0]
    return states_shown(growth_states(rows, "o_custkey", "year", horizon=last))


def order_results(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as games: a home side, and whether it won. Some results are missing."""
    priority = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.to_date("o_orderdate").alias("day"),
        F.year("o_orderdate").cast("long").alias("season"),
        F.col("o_orderstatus").alias("home_side"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), 1)
        .when(priority.isin("3-MEDIUM", "4-NOT SPECIFIED"), 0)
        .alias("home_wins"),
    )


def line_results(spark: SparkSession, folder: str, n_tasks: int = 1) -> DataFrame:
    """Order lines with their season, day, points and win; orders are dealt over ``n_tasks`` tasks."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_linestatus",
        F.coalesce(F.col("l_quantity").cast("long"), F.lit(0)).alias("quantity"),
    )
    orders = dealt(order_results(spark, folder), n_tasks, "l_orderkey")
    return dealt(lines, n_tasks, "l_orderkey").join(orders, "l_orderkey").withColumn(
        "win", win_flag("l_linestatus", "home_side", "home_wins")
    )


_RESULTS_SQL = """
WITH results AS (
  SELECT l_orderkey, l_suppkey, l_partkey, CAST(o_orderdate AS DATE) AS day,
         CAST(year(o_orderdate) AS BIGINT) AS season,
         coalesce(CAST(l_quantity AS BIGINT), 0) AS quantity,
         CASE WHEN l_linestatus = o_orderstatus
                   AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN TRUE
              WHEN l_linestatus <> o_orderstatus
                   AND o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN TRUE
              ELSE FALSE END AS win
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


@query(
    "grouping_sets",
    _RESULTS_SQL
    + """SELECT season, l_suppkey, l_partkey, CAST(sum(quantity) AS BIGINT) AS points,
       count(DISTINCT CASE WHEN win THEN l_orderkey END) AS win_counts,
       CAST(grouping(season, l_suppkey, l_partkey) AS BIGINT) AS grp_id
FROM results
GROUP BY GROUPING SETS ((l_suppkey, l_partkey), (season, l_partkey), (l_suppkey))""",
)
def season_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    n_tasks = task_count(lines := table(spark, folder, "lineitem"), lines.count())
    out = grouping_sets_totals(
        line_results(spark, folder, n_tasks),
        ["season", "l_suppkey", "l_partkey"],
        [["l_suppkey", "l_partkey"], ["season", "l_partkey"], ["l_suppkey"]],
        {"points": "quantity"},
        {"win_counts": ("l_orderkey", "win")},
    )
    order = [F.col("grp_id"), F.col("points").desc_nulls_first(), F.col("win_counts").desc_nulls_first()]
    return sorted_in(out.withColumn("grp_id", F.col("grp_id").cast("long")), n_tasks, order)


@query(
    "top1_per_group",
    """
WITH t AS (SELECT l_suppkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS points
           FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, l_partkey, points FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY points DESC, l_partkey) AS rn
  FROM t) WHERE rn = 1
""",
)
def top_part_per_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """The part with the largest total quantity for each supplier."""
    totals = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("points"))
    )
    order = [F.col("points").desc_nulls_last(), F.col("l_partkey").asc_nulls_last()]
    return top_k_per_group(totals, ["l_suppkey"], order)


@query(
    "top1_per_group_as_written",
    """
SELECT l_suppkey, l_partkey, points FROM (
  SELECT l_suppkey, l_partkey, CAST(l_quantity AS BIGINT) AS points,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_partkey) AS rn
  FROM lineitem) WHERE rn = 1
""",
)
def top_line_per_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """The single line with the largest quantity for each supplier."""
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", F.col("l_quantity").cast("long").alias("points")
    )
    order = [F.col("points").desc_nulls_last(), F.col("l_partkey").asc_nulls_last()]
    return top_k_per_group(lines, ["l_suppkey"], order)


@query(
    "argmax",
    _RESULTS_SQL
    + """SELECT season, l_partkey, CAST(sum(quantity) AS BIGINT) AS points FROM results
GROUP BY 1, 2 ORDER BY points DESC, season, l_partkey LIMIT 1""",
)
def best_season(spark: SparkSession, folder: str) -> DataFrame:
    """The part with the most units in one year."""
    rows = line_results(spark, folder)
    return top_n(rows, ["season", "l_partkey"], {"points": F.sum("quantity")}, "points")


_SIDES_SQL = """
WITH won AS (SELECT CASE l_returnflag WHEN 'A' THEN l_suppkey ELSE l_partkey END AS team_id
             FROM lineitem WHERE l_returnflag IS NOT NULL)
SELECT team_id, count(*) AS total_wins FROM won GROUP BY ALL
"""


@query("side_wins", _SIDES_SQL + "ORDER BY total_wins DESC, team_id LIMIT 1")
def side_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as games between a supplier (home) and a part (away): the side with most wins."""
    games = table(spark, folder, "lineitem").withColumn(
        "home_wins", (F.col("l_returnflag") == "A").cast("int")
    )
    sides = unpivot_sides(games, "l_suppkey", "l_partkey", "home_wins")
    return top_n(
        sides, ["team_id"], {"total_wins": F.sum(F.col("win").cast("int"))}, "total_wins"
    )


@query(
    "rolling_wins",
    _RESULTS_SQL
    + """, days AS (SELECT DISTINCT l_suppkey, day, win FROM results),
w AS (SELECT l_suppkey, count(CASE WHEN win THEN 1 END) OVER (
        PARTITION BY l_suppkey ORDER BY day, win ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS n
      FROM days)
SELECT l_suppkey, max(n) AS most_wins_in_90 FROM w GROUP BY 1""",
)
def rolling_wins(spark: SparkSession, folder: str) -> DataFrame:
    best = rolling_max_count(
        line_results(spark, folder), "l_suppkey", "day", "win", 90, "most_wins_in_90", segment=F.trunc("day", "year")
    )
    return best.orderBy(F.col("most_wins_in_90").desc_nulls_first(), "l_suppkey")


_STREAK_SQL = """
WITH placed AS (
  SELECT o_custkey, coalesce(o_totalprice > 150000, FALSE) AS high, o_orderdate, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
  FROM orders),
shifted AS (
  SELECT *, place - row_number() OVER (PARTITION BY o_custkey, high ORDER BY place) AS shift FROM placed),
stretches AS (
  SELECT o_custkey, count(*) AS n, min(place) > 1 AS broken_before FROM shifted WHERE high GROUP BY o_custkey, shift),
best AS (SELECT o_custkey, max(n) AS n, max(n + CAST(broken_before AS INT)) AS n_with_break
         FROM stretches GROUP BY o_custkey)
SELECT o_custkey, CAST({length} AS BIGINT) AS streak
FROM (SELECT o_custkey, bool_or(NOT high) AS any_break FROM placed GROUP BY o_custkey)
LEFT JOIN best USING (o_custkey)
"""


def streaks(spark: SparkSession, folder: str, count_break: bool) -> DataFrame:
    return longest_streak(
        table(spark, folder, "orders"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        F.coalesce(F.col("o_totalprice"), F.lit(0)) > 150000,
        segment=F.to_date("o_orderdate"),
        count_break=count_break,
    )


@query("longest_streak", _STREAK_SQL.format(length="coalesce(n, 0)"))
def customer_longest_streak(spark: SparkSession, folder: str) -> DataFrame:
    """Most orders in a row above a price, per customer."""
    return streaks(spark, folder, count_break=False)


@query("longest_streak_as_written", _STREAK_SQL.format(length="greatest(coalesce(n_with_break, 0), CAST(any_break AS INT))"))
def customer_longest_streak_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Later streaks also count the order that broke the one before."""
    return streaks(spark, folder, count_break=True)


@query(
    "hot_key_join",
    """SELECT n_name, l_returnflag, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
)
def hot_key_join(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their supplier's nation; suppliers with many lines are found and dealt over tasks."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = spread_join(lines, suppliers.join(nations, "s_nationkey"), ["l_suppkey"])
    return joined.groupBy("n_name", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
