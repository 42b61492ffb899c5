"""Deduplication, normalised facts, graph tables, checks. Tables: lineitem, orders, part, nation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock_to_minutes, contains_token
from ..operators import (
    dedup,
    duplicate_keys,
    edges,
    member_pairs,
    member_totals,
    memberships,
    normalise_fact,
    union_all,
    values_outside,
    vertices,
)
from .registry import query, table, text

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "dedup",
    """
SELECT * EXCLUDE (rn, l_shipdate), CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem) WHERE rn = 1
""",
)
def lineitem_dedup(spark: SparkSession, folder: str) -> DataFrame:
    lines = dedup(table(spark, folder, "lineitem"), LINE_KEY)
    return lines.withColumn("l_shipdate", text(F.to_date("l_shipdate")))


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def lineitem_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem"), LINE_KEY)


@query(
    "domain_check",
    """SELECT o_orderstatus, count(*) AS n_rows FROM orders
       WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1""",
)
def order_status_domain(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that are neither finished nor open."""
    return values_outside(table(spark, folder, "orders"), "o_orderstatus", ["F", "O"])


def clock(minutes: str, part: str) -> Column:
    """A "MM:SS" text from two numbers of a line."""
    seconds = F.round(F.col(part) * 100).cast("int").cast("string")
    return F.concat(F.col(minutes).cast("int").cast("string"), F.lit(":"), F.lpad(seconds, 2, "0"))


@query(
    "fact_normalised",
    """
WITH d AS (SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_linestatus,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_discount, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1)
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dim_order_date,
       CAST(year(o_orderdate) AS BIGINT) AS dim_season,
       l_orderkey AS dim_order, CAST(l_linenumber AS BIGINT) AS dim_line,
       l_suppkey AS dim_supplier, l_partkey AS dim_part,
       l_linestatus = o_orderstatus AS dim_is_home,
       contains(o_orderpriority, 'URGENT') AS dim_is_urgent,
       contains(o_orderpriority, 'HIGH') AS dim_is_high,
       contains(o_orderpriority, 'LOW') AS dim_is_low,
       CAST(l_quantity AS BIGINT) AS m_quantity,
       CAST(CAST(l_quantity AS BIGINT) AS DOUBLE)
         + CAST(round(l_discount * 100) AS DOUBLE) / 60 AS m_minutes
FROM d JOIN orders ON l_orderkey = o_orderkey
""",
)
def fact_normalised(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order"), "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_discount", "l_linestatus",
    )
    dim = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order"), "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    return normalise_fact(
        fact,
        dim,
        on=["order"],
        key=["order", "l_linenumber"],
        columns={
            "dim_order_date": text(F.to_date("o_orderdate")),
            "dim_season": F.year("o_orderdate").cast("long"),
            "dim_order": F.col("order"),
            "dim_line": F.col("l_linenumber").cast("long"),
            "dim_supplier": F.col("l_suppkey"),
            "dim_part": F.col("l_partkey"),
            "dim_is_home": F.col("l_linestatus") == F.col("o_orderstatus"),
            "dim_is_urgent": contains_token("o_orderpriority", "URGENT"),
            "dim_is_high": contains_token("o_orderpriority", "HIGH"),
            "dim_is_low": contains_token("o_orderpriority", "LOW"),
            "m_quantity": F.col("l_quantity").cast("long"),
            "m_minutes": clock_to_minutes(clock("l_quantity", "l_discount")),
        },
    )


def plays(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in orders."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"),
        "l_returnflag",
    )


def all_vertices(spark: SparkSession, folder: str, raw_rows: bool) -> DataFrame:
    orders = table(spark, folder, "orders")
    games = vertices(
        orders,
        "o_orderkey",
        "order",
        {
            "customer": "o_custkey",
            "status": "o_orderstatus",
            "priority": F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")),
        },
    )
    totals = member_totals(
        plays(spark, folder), "l_partkey", "l_orderkey", "quantity", "l_returnflag",
        raw_rows=raw_rows,
    )
    names = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    members = vertices(
        totals.join(names, "l_partkey"),
        "l_partkey",
        "part",
        {
            "name": "p_name",
            "number_of_orders": "number_of_events",
            "total_quantity": "total_amount",
            "return_flags": "groups",
        },
    )
    nations = dedup(table(spark, folder, "nation"), ["n_nationkey"])
    teams = vertices(nations, "n_nationkey", "nation", {"name": "n_name", "region": "n_regionkey"})
    return union_all([games, members, teams])


_VERTICES_SQL = """
WITH once AS (SELECT * FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey
           ORDER BY l_suppkey, l_quantity, l_returnflag) AS rn
  FROM lineitem) WHERE rn = 1 OR {raw}),
totals AS (SELECT l_partkey, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS q,
                  list_sort(list(DISTINCT l_returnflag)) AS f
           FROM once GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS identifier, 'order' AS type,
       CAST(json_object('customer', o_custkey, 'status', o_orderstatus, 'priority',
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS VARCHAR) AS properties
FROM orders
UNION ALL
SELECT CAST(l_partkey AS VARCHAR), 'part',
       CAST(json_object('name', p_name, 'number_of_orders', n, 'total_quantity', q,
                        'return_flags', f) AS VARCHAR)
FROM totals JOIN part ON l_partkey = p_partkey
UNION ALL
SELECT CAST(n_nationkey AS VARCHAR), 'nation',
       CAST(json_object('name', n_name, 'region', n_regionkey) AS VARCHAR)
FROM (SELECT DISTINCT ON (n_nationkey) * FROM nation ORDER BY n_nationkey, n_name, n_regionkey)
"""


@query("graph_vertices", _VERTICES_SQL.format(raw="FALSE"))
def graph_vertices(spark: SparkSession, folder: str) -> DataFrame:
    return all_vertices(spark, folder, raw_rows=False)


@query("graph_vertices_as_written", _VERTICES_SQL.format(raw="TRUE"))
def graph_vertices_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over raw rows, so duplicates count."""
    return all_vertices(spark, folder, raw_rows=True)


@query(
    "graph_edges",
    """
WITH once AS (SELECT * FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey
           ORDER BY l_suppkey, l_quantity, l_returnflag) AS rn
  FROM lineitem) WHERE rn = 1)
SELECT CAST(l_partkey AS VARCHAR) AS subject_identifier, 'part' AS subject_type,
       CAST(l_orderkey AS VARCHAR) AS object_identifier, 'order' AS object_type,
       'part_of' AS edge_type,
       CAST(json_object('quantity', quantity, 'supplier', l_suppkey, 'flag', l_returnflag)
            AS VARCHAR) AS properties
FROM once
""",
)
def graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    return edges(
        plays(spark, folder),
        ("l_partkey", "part"),
        ("l_orderkey", "order"),
        "part_of",
        {"quantity": "quantity", "supplier": "l_suppkey", "flag": "l_returnflag"},
    )


_ONCE_SQL = """
WITH once AS (SELECT * FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_suppkey, CAST(l_quantity AS BIGINT)) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL) WHERE rn = 1)
"""
_PAIRS_SQL = _ONCE_SQL + """
SELECT CAST(a.l_partkey AS VARCHAR) AS subject_identifier, 'part' AS subject_type,
       CAST(b.l_partkey AS VARCHAR) AS object_identifier, 'part' AS object_type, '{name}' AS edge_type,
       CAST(json_object('num_orders', count(*), 'subject_quantity', CAST(sum(a.quantity) AS BIGINT),
                        'object_quantity', CAST(sum(b.quantity) AS BIGINT)) AS VARCHAR) AS properties
FROM once a JOIN once b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey AND a.l_suppkey {compare} b.l_suppkey
GROUP BY a.l_partkey, b.l_partkey
"""


def pair_edges(spark: SparkSession, folder: str, same: bool, name: str) -> DataFrame:
    """Edges between parts that are in orders together, from the same supplier or from different ones."""
    pairs = member_pairs(plays(spark, folder), "l_orderkey", "l_partkey", "l_suppkey", "quantity")
    return edges(
        pairs.where(F.col("same_group") == same), ("a", "part"), ("b", "part"), name,
        {"num_orders": "n_events", "subject_quantity": "a_amount", "object_quantity": "b_amount"},
        unique=True,  # pairs of one kind
    )


@query("graph_plays_against", _PAIRS_SQL.format(name="plays_against", compare="<>"))
def graph_plays_against(spark: SparkSession, folder: str) -> DataFrame:
    return pair_edges(spark, folder, False, "plays_against")


@query("graph_shares_team", _PAIRS_SQL.format(name="shares_team", compare="="))
def graph_shares_team(spark: SparkSession, folder: str) -> DataFrame:
    return pair_edges(spark, folder, True, "shares_team")


@query(
    "graph_plays_on",
    _ONCE_SQL
    + """SELECT CAST(l_partkey AS VARCHAR) AS subject_identifier, 'part' AS subject_type,
       CAST(l_suppkey AS VARCHAR) AS object_identifier, 'supplier' AS object_type, 'plays_on' AS edge_type,
       CAST(json_object('num_orders', count(*), 'quantity', CAST(sum(quantity) AS BIGINT)) AS VARCHAR) AS properties
FROM once WHERE l_suppkey IS NOT NULL GROUP BY l_partkey, l_suppkey
""",
)
def graph_plays_on(spark: SparkSession, folder: str) -> DataFrame:
    """Edges from a part to the suppliers it came from."""
    found = memberships(plays(spark, folder), "l_orderkey", "l_partkey", "l_suppkey", "quantity")
    return edges(
        found, ("member", "part"), ("group", "supplier"), "plays_on", {"num_orders": "n_events", "quantity": "total"}
    )
