"""One key holds a third of the rows, or more: results stay whole and the work is split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import (
    dedup,
    edges,
    growth_states,
    longest_streak,
    normalise_fact,
    pack_items,
    sessionize,
    top_k_per_group,
    unpaired_weights,
)

N = 6000


def hot():
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))


@pytest.fixture(scope="module")
def facts(spark):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int"))
    return spark.range(N).select(
        hot().alias("k"), F.col("id").alias("v"), day.alias("day"),
        (F.col("id") % 97 > 3).alias("ok"), F.lit("A").alias("name"),
    )


def executed(df):
    """The final plan, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_entity_is_packed_in_parts_and_keeps_all_items(spark, facts):
    packed = pack_items(facts, ["k"], F.struct("v"), n_parts=20)
    sizes = packed.where("k = 0").select("part", F.size("items")).collect()
    assert len(sizes) == 20 and max(n for _, n in sizes) < 200
    assert packed.select(F.inline("items")).distinct().count() == N


def test_arrays_of_a_hot_entity_do_not_grow_with_the_table(spark, facts):
    """Parts are ranges of the items' keys: a hundred times the rows are a hundred times the parts."""
    largest = []
    for n in (N, 100 * N):
        rows = spark.range(n).select(hot().alias("k"), F.col("id").alias("v"))
        packed = pack_items(rows, ["k"], F.struct("v"), n_parts=None, spread=F.floor(F.col("v") / 300))
        largest.append(packed.agg(F.max(F.size("items"))).first()[0])
    assert largest == [100, 100]


def test_copies_of_one_item_are_one_element(spark, facts):
    """A third of all rows are the same item of the same entity."""
    packed = pack_items(facts, ["k"], F.struct("k"), n_parts=20)
    assert [tuple(x) for x in packed.where("k = 0").first()["items"]] == [(0, N // 3)]
    assert packed.select(F.inline("items")).agg(F.sum("copies")).first()[0] == N


def test_the_parts_of_a_hot_entity_lie_in_different_tasks(spark, facts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packed = pack_items(facts, ["k"], F.struct("v"), n_parts=20)
        hot = packed.where("k = 0").select(F.spark_partition_id().alias("task")).distinct()
        assert hot.count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_are_limited_before_the_shuffle(spark, facts):
    order = [F.col("v").asc()]
    for df in (
        dedup(facts, ["k"], order),
        top_k_per_group(facts, ["k"], order),
        edges(facts, ("k", "a"), ("name", "b"), "e", {"v": "v"}),
    ):
        plan = executed(df)
        below = plan.split("== Initial Plan ==")[-1].split("Exchange hashpartitioning")[1]
        assert "WindowGroupLimit" in below and "Partial" in below
    assert dedup(facts, ["k"], order).where("k = 0").first().v == 0


def test_streaks_of_a_hot_key(spark, facts):
    expected, run = 0, 0
    for row in facts.where("k = 0").orderBy("day", "v").collect():
        run = run + 1 if row.ok else 0
        expected = max(expected, run)
    for segment in (F.col("day"), F.trunc("day", "month"), F.lit(1)):
        best = longest_streak(facts, ["k"], ["day", "v"], F.col("ok"), segment)
        assert best.where("k = 0").first().streak == expected


def test_streak_segments_are_the_shuffle_key(facts):
    df = longest_streak(facts, ["k"], ["day", "v"], F.col("ok"), F.col("day"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 2 and "__seg" in keys[-1]


def test_events_of_a_hot_key_are_counted_before_the_shuffle(spark):
    events = spark.range(N).select(
        hot().alias("ip"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
    )
    df = sessionize(events, "ts", ["ip"])
    assert df.where("ip = 0").collect()[0].event_count == N // 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    first = plan.rsplit("Exchange hashpartitioning", 1)[1]
    assert "partial_count(1)" in first


def test_growth_has_one_shuffle_after_a_partial_set(facts):
    df = growth_states(facts.withColumn("p", F.year("day")), "k", "p")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert "partial_collect_set" in plan.split("Exchange ")[1]
    assert "Window" not in plan and "Join" not in plan


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few kilobytes count as a skewed partition."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adaptive_execution_splits_a_hot_join_key(spark, facts, small_partitions):
    """A join of facts with their dimension, followed by a grouping on other columns."""
    dim = spark.range(N).select(F.col("id").alias("k"), (F.col("id") % 5).alias("season"))
    rows = facts.repartition(8).join(dim, "k").groupBy("season").agg(F.sum("v").alias("s"))
    plan = executed(rows)
    assert "skew=true" in plan
    assert sum(r.s for r in rows.collect()) == sum(range(N))


def test_normalised_facts_split_a_hot_game(spark, facts, small_partitions):
    games = spark.range(N).select(F.col("id").alias("k"), (F.col("id") % 5).alias("season"))
    out = normalise_fact(
        facts.repartition(8), games, ["k"], ["k", "v"], {"season": F.col("season"), "v": F.col("v")}
    )
    assert "skew=true" in executed(out)
    assert out.count() == N


def test_weights_split_a_hot_match(spark, facts, small_partitions):
    medals = facts.select("k").distinct().crossJoin(spark.range(2))
    out = unpaired_weights(facts.repartition(8), medals, "k", F.col("v"), 16)
    assert out.agg(F.sum("weight")).first()[0] == 2 * N
    assert out.where("k = 0").select(F.spark_partition_id()).distinct().count() > 3
