"""Rows of one task: their number does not grow with the table."""

from __future__ import annotations

import datetime as dt
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from compare import duckdb_result, spark_result
from tallyframe.operators import check_layouts, compare_layouts, layout, member_pairs, skew, sorted_in, task_count

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_linestatus string, l_returnflag string"


@pytest.fixture
def folder(spark, tmp_path):
    """Orders and their lines, some of them twice and some without a key."""
    rng = random.Random(9)
    orders = [
        (o, rng.randrange(9), rng.choice("FO"), rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]), dt.datetime(1994 + o % 4, 1, 1)) for o in range(80)
    ]
    lines = [
        (rng.choice([o, o, o, o, None]), rng.randrange(12), rng.randrange(5), n, float(rng.randrange(1, 9)), rng.choice("FO"), "N")
        for o in range(80) for n in range(1, 6)
    ]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
        "lineitem": (lines + lines[:20], LINE),
        "customer": ([(c, c % 3) for c in range(9)], "c_custkey long, c_nationkey int"),
        "nation": ([(n, f"n{n}") for n in range(3)], "n_nationkey int, n_name string"),
        "region": ([(r, f"r{r}") for r in range(5)], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def oracle(folder, name):
    con = duckdb.connect()
    for table in ("orders", "lineitem", "customer", "nation", "region"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    return duckdb_result(con, oracle_sql()[name])


def plan(df):
    return df._jdf.queryExecution().toString()


def test_order_lines_are_dealt_by_their_number(spark, folder, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 20, raising=False)
    out = queries()["grouping_sets"](spark, folder)
    assert spark_result(out) == oracle(folder, "grouping_sets")
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L?, 21\), REPARTITION_BY_NUM", plan(out))
    shown = [(r.grp_id, -r.points, -r.win_counts) for r in out.collect()]
    assert shown == sorted(shown)


def test_rows_that_tie_are_sorted_in_many_tasks(spark):
    df = spark.range(4000).select(F.lit(1).alias("same"), F.col("id"))
    out = sorted_in(df, 8, [F.col("same").desc()])
    assert out.groupBy(F.spark_partition_id()).count().count() == 8
    assert task_count(df, 10) == 1 and task_count(df, 10**9) == 2000


@pytest.mark.parametrize("name", ["graph_plays_against", "graph_shares_team"])
def test_cells_of_pairs_are_dealt_by_the_number_of_facts(spark, folder, monkeypatch, name):
    monkeypatch.setattr(skew, "TASK_ROWS", 20, raising=False)
    out = queries()[name](spark, folder)
    assert spark_result(out) == oracle(folder, name)
    text = plan(out)
    assert re.search(r"hashpartitioning\(e#\d+L?, p#\d+, q#\d+, 21\), REPARTITION_BY_NUM", text)
    assert "Window" not in text.split("== Physical Plan ==")[1].split("Generate explode")[0]  # pairs of one kind are unique


def test_a_hot_event_is_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 10, raising=False)
    facts = spark.range(300).select(F.floor(F.col("id") / 1000).alias("g"), F.col("id").alias("p"), (F.col("id") % 2).alias("t"), F.lit(1).alias("x"))
    pairs = member_pairs(facts, "g", "p", "t", "x", 16)
    assert pairs.count() == 300 * 299 // 2
    assert re.search(r"hashpartitioning\(e#\d+L, p#\d+, q#\d+, 30\), REPARTITION_BY_NUM", plan(pairs))


def test_no_window_over_a_layout_holds_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100, raising=False)
    monkeypatch.setattr(layout, "FILE_BLOCK", 7, raising=False)
    df = spark.range(2000).select("id", (F.col("id") * 7919 % 13).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("b")).coalesce(1)
    orders = {"ab": ["a", "b"], "ba": ["b", "a"]}
    out = check_layouts(df, orders, str(tmp_path / "checked"), "id")
    assert sorted(tuple(r) for r in out.collect()) == [(name, 2000, 1999000, 0) for name in ("ab", "ba")]
    assert "windowspecdefinition(__file#" in plan(out) and ", __block#" in plan(out)
    files = compare_layouts(df, orders, str(tmp_path / "compared")).collect()
    assert {r.layout for r in files} == {"ab", "ba"} and all(r.files > 8 for r in files)
    assert all(spark.read.parquet(f"{tmp_path}/compared/{name}").exceptAll(df).isEmpty() for name in orders)


@pytest.mark.parametrize("block", [1, 2, 7, 10_000])
def test_rows_out_of_order_are_counted_across_blocks(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(layout, "FILE_BLOCK", block, raising=False)
    data = [random.Random(block).randrange(5) for _ in range(50)]
    monkeypatch.setattr(layout.DataFrame, "sortWithinPartitions", lambda df, *columns: df)
    df = spark.createDataFrame([(v, n) for n, v in enumerate(data)], "v int, n int").coalesce(1)
    found = check_layouts(df, {"v": ["v"]}, str(tmp_path / "checked"), "n").first()
    assert tuple(found) == ("v", 50, 1225, sum(b < a for a, b in zip(data, data[1:])))


def test_layouts_of_games(spark, folder, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 20, raising=False)
    assert spark_result(queries()["layout_compare"](spark, folder)) == oracle(folder, "layout_compare")
