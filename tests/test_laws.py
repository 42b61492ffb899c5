"""Steps taken one by one equal the result built at once, and steps can run again."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyframe.functions import class_by_thresholds
from tallyframe.operators import (
    active_days,
    build_dates,
    build_grouped,
    build_history,
    build_monthly,
    carry_forward,
    cumulate_dates,
    cumulate_grouped,
    cumulate_history,
    reduce_monthly,
    scd2_build,
    scd2_merge,
)
from tallyframe.sources import empty_state, materialise

YEARS = range(2000, 2006)
DAYS = [dt.date(2024, 1, d) for d in range(1, 13)]


def plain(value):
    if isinstance(value, Row):
        return tuple(plain(v) for v in value)
    return [plain(v) for v in value] if isinstance(value, list) else value


def content(df):
    columns = sorted(df.columns)
    return sorted((plain(r) for r in df.select(*columns).collect()), key=repr)


def saved(df):
    """Each step is written, as a job would do; otherwise the plan grows with every step."""
    return materialise(df, "step")


@pytest.fixture(scope="module")
def seasons(spark):
    rng = random.Random(7)
    data = [
        (f"p{p}", rng.choice(["A", "B", None]), float(rng.randint(0, 25)), year)
        for p in range(30) for year in YEARS if rng.random() < 0.5
    ]
    return spark.createDataFrame(data, "name string, college string, pts double, season int")


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    data = [
        (rng.choice([None, *range(12)]), rng.choice("xyz"),
         dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(12 * 1440)))
        for _ in range(400)
    ]
    return spark.createDataFrame(data, "user int, host string, ts timestamp_ntz")


def spend_rule():
    return "class", class_by_thresholds("pts", [(20, "star"), (10, "good")], "bad")


def test_history_steps_equal_build(spark, seasons):
    item = F.struct("season", "pts")
    state = empty_state(
        spark, "name string, college string, stats array<struct<season:int,pts:double>>, "
        "class string, idle int, season int",
    )
    for year in YEARS:
        state = saved(cumulate_history(
            state, seasons.where(F.col("season") == year), ["name"], ["college"], item,
            period_prev="season", period_today="season", history="stats",
            classify=spend_rule(), recency="idle",
        ))
    whole = build_history(
        seasons, ["name"], ["college"], item, period="season", through=YEARS[-1],
        history="stats", classify=spend_rule(), recency="idle",
    )
    assert content(state) == content(whole)


@pytest.mark.parametrize("n_parts", [1, 5, None])
def test_grouped_steps_equal_build(spark, seasons, n_parts):
    """All columns, with attributes that change; also with histories spread over parts."""
    films = seasons.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(4)))).withColumn(
        "rating", F.col("pts") + F.col("n")
    )
    rule = ("class", lambda a: class_by_thresholds(a, [(20, "star"), (10, "good")], "bad"))
    item = F.struct("season", "n", "rating")
    spread = F.floor(F.col("n") / 3) + 7 if n_parts is None else None
    state = empty_state(
        spark, "name string, part long, college string, class string, active boolean, season int, "
        "films array<struct<season:int,n:int,rating:double,copies:long>>",
    )
    for year in YEARS:
        state = saved(cumulate_grouped(
            state, films.where(F.col("season") == year), ["name"], ["college"], item,
            metric="rating", period=year, period_name="season", history="films",
            classify=rule, active="active", n_parts=n_parts, spread=spread,
        ))
    whole = build_grouped(
        films, ["name"], ["college"], item, metric="rating", period="season",
        through=YEARS[-1], history="films", classify=rule, active="active", n_parts=n_parts, spread=spread,
    )
    columns = sorted(state.columns)
    assert content(state.select(columns)) == content(whole.select(columns))
    rows = films.where("name IS NOT NULL").groupBy("name", "season", "n", "rating").count()
    assert content(whole.select("name", F.inline("films"))) == content(rows)


@pytest.mark.parametrize("keys", [["user"], ["user", "host"], ["host"]])
def test_date_steps_equal_build(spark, events, keys):
    kinds = ", ".join(f"{k} {events.schema[k].dataType.simpleString()}" for k in keys)
    state = empty_state(spark, f"{kinds}, dates array<date>, day date")
    for day in DAYS:
        today = active_days(events, keys, "ts", day)
        state = saved(cumulate_dates(state, today, keys, "dates", "day"))
    whole = build_dates(events, keys, "ts", DAYS[0], DAYS[-1], "dates", "day")
    assert content(state) == content(whole)


def test_dates_beyond_one_word(spark):
    start = dt.date(2023, 1, 1)
    days = [start + dt.timedelta(days=n) for n in (0, 62, 63, 64, 125, 126, 199)]
    stamps = [(1, dt.datetime(d.year, d.month, d.day, 23, 59)) for d in days]
    df = spark.createDataFrame(stamps, "user int, ts timestamp_ntz")
    end = start + dt.timedelta(days=199)
    assert build_dates(df, ["user"], "ts", start, end, "dates", "day").first().dates == days


def daily(events):
    return events.where("user IS NOT NULL").groupBy("user", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("host").alias("hosts")
    )


def test_monthly_steps_equal_build_and_run_again(spark, events):
    metrics = {"hits": "n", "hosts_array": "hosts"}
    rows = daily(events)
    state = empty_state(
        spark, "user int, month date, hits array<long>, hosts_array array<long>"
    )
    for day in DAYS:
        today = rows.where(F.col("day") == F.lit(day))
        state = saved(reduce_monthly(state, today, ["user"], day, metrics))
    whole = build_monthly(rows, ["user"], "day", DAYS[-1], metrics)
    assert content(state) == content(whole)
    again = reduce_monthly(state, today, ["user"], DAYS[-1], metrics)
    assert content(again) == content(state)


def test_scd_increments_equal_rebuild(spark, seasons):
    key, attrs, tracked = ["name"], ["college"], ["class", "is_active"]
    rows = seasons.select("name", "season", "college", spend_rule()[1].alias("class"))
    states = carry_forward(rows, key, "season", YEARS[-1])
    scd = scd2_build(states, key, attrs, tracked, "season", YEARS[0])
    for year in YEARS[1:]:
        scd = saved(scd2_merge(
            scd, states.where(F.col("season") == year), key, attrs, tracked,
            dt.date(year - 1, 1, 1), dt.date(year, 1, 1),
        ))
        rebuilt = scd2_build(states, key, attrs, tracked, "season", year)
        assert content(scd) == content(rebuilt)


def test_carry_forward_stops_at_the_horizon(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 9, "z")],
                                 "k string, p int, v string")
    got = carry_forward(rows, ["k"], "p", 4)
    assert sorted(tuple(r) for r in got.select("k", "p", "v", "is_active").collect()) == [
        ("a", 1, "x", True), ("a", 2, "x", False), ("a", 3, "y", True), ("a", 4, "y", False)
    ]
