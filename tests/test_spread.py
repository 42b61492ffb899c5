"""Operators that spread hot keys or grow by time: results against plain versions, and their plans."""

import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyframe.models import games
from tallyframe.operators import (
    build_dates,
    build_months,
    carry_forward,
    clean_counted,
    counted,
    datelist_words,
    grouping_sets_agg,
    grouping_sets_totals,
    heavy_keys,
    member_pairs,
    memberships,
    normalise_fact,
    null_keys,
    outside_domain,
    reduce_monthly,
    rolling_max_count,
    scd2_build,
    sessionize,
    spread_join,
)
from tallyframe.plans import QUERIES
from tallyframe.sources import empty_state, materialise, read_finished, staged_sink
from tallyframe.sources.scd_table import Scd2Table

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- months in one pass


@pytest.fixture(scope="module")
def hits(spark):
    rng = random.Random(2)
    days = [dt.date(2023, 12, 28) + dt.timedelta(days=n) for n in range(50)]
    data = [(rng.choice(["a", "b", "c", None]), rng.choice([*days, None]), rng.randint(1, 3), rng.choice([1, None])) for _ in range(300)]
    return spark.createDataFrame(data, "host string, day date, n int, m int")


def test_all_months_equal_daily_steps(spark, hits):
    through = dt.date(2024, 2, 5)
    metrics = {"hits": "n", "others": "m"}
    state = empty_state(spark, "host string, month date, hits array<long>, others array<long>")
    daily = hits.groupBy("host", "day").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where("day IS NOT NULL")
    day = dt.date(2023, 12, 28)
    months = []
    while day <= through:
        if day.day == 1:
            months.append(state)
            state = empty_state(spark, "host string, month date, hits array<long>, others array<long>")
        state = materialise(reduce_monthly(state, daily.where(F.col("day") == F.lit(day)), ["host"], day, metrics), "step")
        day += dt.timedelta(days=1)
    for month in months:
        state = state.unionByName(month)
    expected = {(r.host, r.month): (r.hits, r.others) for r in state.collect()}
    found = {(r.host, r.month): (r.hits, r.others) for r in build_months(hits, ["host"], "day", through, metrics).collect()}
    assert found == expected
    assert [len(found["a", dt.date(y, m, 1)][0]) for y, m in ((2023, 12), (2024, 1), (2024, 2))] == [31, 31, 5]


def test_months_are_one_grouping_whatever_their_number(spark, hits):
    months = build_months(hits, ["host"], "day", dt.date(2024, 2, 5), {"hits": "n"})
    text = plan(months)
    assert text.count("Exchange ") == 1 and "partial_sum" in text.split("Exchange ")[1]
    assert "Union" not in text and "Join" not in text


@pytest.mark.parametrize("name,scans", [("array_lengths", 1), ("monthly_reduced", 1), ("monthly_unpacked", 1), ("monthly_metric", 3)])
def test_scans_do_not_grow_with_the_months(spark, later_events, name, scans):
    text = plan(QUERIES[name](spark, later_events))
    assert text.count("FileScan parquet") <= scans


@pytest.fixture(scope="module")
def later_events(spark, tmp_path_factory):
    """Events over two years."""
    folder = str(tmp_path_factory.mktemp("later"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    moved = events.withColumn("ts", F.timestamp_add("DAY", (F.col("event_id") % 24) * 30, "ts").cast(events.schema["ts"].dataType))
    moved.write.parquet(f"{folder}/events.parquet")
    return folder


# --- long histories


def test_dates_of_three_years(spark):
    rng = random.Random(3)
    start = dt.date(2021, 2, 3)
    days = {u: sorted(rng.sample(range(1100), rng.choice([1, 5, 400]))) for u in range(6)}
    data = [(u, dt.datetime.combine(start + dt.timedelta(days=d), dt.time(rng.randrange(24)))) for u, ds in days.items() for d in ds]
    events = spark.createDataFrame(data * 2, "user int, ts timestamp_ntz")
    end = start + dt.timedelta(days=1099)
    built = build_dates(events, ["user"], "ts", start, end, "dates", "day")
    assert {r.user: r.dates for r in built.collect()} == {u: [start + dt.timedelta(days=d) for d in ds] for u, ds in days.items()}
    words = datelist_words(built, "dates", end, start)
    for r in words.collect():
        bits = {(w, b) for w, x in enumerate(r.datelist_words) for b in range(32) if x >> (31 - b) & 1}
        assert bits == {divmod(1099 - d, 32) for d in days[r.user]}
        assert len(r.datelist_words) == 35


def test_the_plan_of_dates_has_one_width(spark):
    events = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "user int, ts timestamp_ntz")
    sizes = []
    for n in (5, 4000):
        built = build_dates(events, ["user"], "ts", dt.date(2024, 1, 1), dt.date(2024, 1, 1) + dt.timedelta(days=n), "dates", "day")
        sizes.append(plan(built).count("bit_or"))
    assert sizes[0] == sizes[1]


# --- pairs of members


def expected_pairs(data):
    games_, out = defaultdict(dict), Counter()
    for game, player, team, pts in sorted(data, key=lambda r: (r[0], r[1], r[2] is None, r[2], r[3])):
        games_[game].setdefault(player, (team, pts))
    totals = defaultdict(lambda: [0, 0, 0])
    for members in games_.values():
        for a, b in combinations(sorted(members), 2):
            (ta, xa), (tb, xb) = members[a], members[b]
            if ta is not None and tb is not None:
                t = totals[a, b, ta == tb]
                t[0], t[1], t[2] = t[0] + 1, t[1] + xa, t[2] + xb
    del out
    return sorted(((*k, *v) for k, v in totals.items()), key=repr)


@pytest.mark.parametrize("block", [3, 64])
def test_pairs_of_a_hot_game(spark, block):
    rng = random.Random(4)
    data = [(g, rng.randrange(40), rng.choice(["x", "y", None]), rng.randrange(9)) for g in (*range(20), *[7] * 60) for _ in range(3)]
    facts = spark.createDataFrame(data, "game int, player int, team string, pts int")
    extra = facts.unionByName(spark.createDataFrame([(None, 1, "x", 1), (3, None, "x", 1)], facts.schema))
    assert rows(member_pairs(extra, "game", "player", "team", "pts", block)) == expected_pairs(data)


def test_a_hot_game_is_many_cells(spark):
    facts = spark.range(300).select(F.floor(F.col("id") / 1000).alias("g"), F.col("id").alias("p"), (F.col("id") % 2).alias("t"), F.lit(1).alias("x"))
    pairs = member_pairs(facts, "g", "p", "t", "x", 16)
    assert pairs.count() == 300 * 299 // 2
    text = plan(pairs)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    last = text.split("Exchange hashpartitioning(a#")[1]
    assert "partial_count(1)" in last


def test_edge_types(spark):
    details = spark.createDataFrame(
        [(1, "t", 1, 10), (1, "t", 2, 5), (1, "u", 3, 7), (2, "t", 1, 1), (2, "t", 2, None), (2, "t", 2, None)],
        "game_id int, team_id string, player_id int, pts int",
    )
    found = rows(games.player_edges(details, True)) + rows(games.player_edges(details, False)) + rows(games.team_edges(details))
    assert [(r[0], r[2], r[4]) for r in found] == [
        ("1", "2", "shares_team"), ("1", "3", "plays_against"), ("2", "3", "plays_against"),
        ("1", "t", "plays_on"), ("2", "t", "plays_on"), ("3", "u", "plays_on"),
    ]
    assert found[0][5] == '{"num_games":2,"subject_points":11,"object_points":5}'
    assert found[3][5] == '{"num_games":2,"points":11}'
    assert memberships(details.limit(0), "game_id", "player_id", "team_id", "pts").count() == 0


# --- grouping sets


def test_totals_equal_grouping_sets_with_distinct(spark):
    rng = random.Random(5)
    data = [(rng.choice([1, 2, None]), rng.choice("tu"), rng.choice("pq"), rng.choice([1, 2, 3, None]), rng.choice([True, False, None]), rng.randint(0, 9))
            for _ in range(200)]
    df = spark.createDataFrame(data, "season int, team string, player string, game int, win boolean, pts int")
    cols, sets = ["season", "team", "player"], [["team", "player"], ["season", "player"], ["team"]]
    plain = grouping_sets_agg(df, cols, sets, {"pts": F.sum("pts"), "wins": F.count_distinct(F.when(F.col("win"), F.col("game")))})
    found = grouping_sets_totals(df, cols, sets, {"pts": "pts"}, {"wins": ("game", "win")})
    names = [*cols, "pts", "wins", "grp_id"]
    assert rows(found.select(names)) == rows(plain.select(names))
    with pytest.raises(ValueError):
        grouping_sets_totals(df, cols, sets, {}, {"a": ("game", "win"), "b": ("pts", "win")})


def test_rows_are_reduced_before_they_are_repeated(spark):
    df = spark.range(9000).select(*[(F.col("id") % n).alias(c) for n, c in ((2, "a"), (3, "b"), (5, "item"))], F.lit(True).alias("f"), F.lit(1).alias("x"))
    out = grouping_sets_totals(df, ["a", "b"], [["a"], ["b"]], {"x": "x"}, {"n": ("item", "f")})
    out.collect()
    text = plan(out).split("== Initial Plan ==")[0]
    below = text.split("Expand")[1]
    assert "partial_sum" in below and "Exchange" in below
    assert rows(out) == sorted([(k, None, 4500, 5, 1) for k in (0, 1)] + [(None, k, 3000, 5, 2) for k in (0, 1, 2)], key=repr)


# --- rolling counts


def rolling(data, n):
    best = {}
    for key in {r[0] for r in data}:
        flags = [bool(f) for _, _, f in sorted({r for r in data if r[0] == key}, key=lambda r: (r[1], (r[2] is not None, r[2])))]
        best[key] = max(sum(flags[max(0, i - n + 1) : i + 1]) for i in range(len(flags)))
    return best


@pytest.mark.parametrize("n,block", [(1, 1), (5, 5), (5, 7), (90, 10), (500, 1000)])
def test_rolling_counts_across_blocks(spark, n, block):
    rng = random.Random(n + block)
    start = dt.datetime(2024, 1, 1)
    data = [(rng.choice(["hot", "hot", "hot", "x", None]), start + dt.timedelta(hours=rng.randrange(400)), rng.choice([True, False, None])) for _ in range(900)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, win boolean")
    found = rolling_max_count(df, "k", "ts", "win", n, block=block)
    assert {r.k: r.best for r in found.collect()} == rolling(data, n)


def test_no_rolling_window_holds_a_whole_key(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.lit(True).alias("w"))
    found = rolling_max_count(df, "k", "ts", "w", 90, block=100)
    assert rows(found) == [(1, 90)]
    windows = [line for line in plan(found).splitlines() if "Window [" in line and "__total" in line]
    assert windows and all("__seg" in line or "__block" in line for line in windows)


# --- slowly changing dimensions as tables


def test_stored_steps_equal_the_rebuild(spark, tmp_path):
    rng = random.Random(6)
    data = [(f"p{p}", rng.choice("AB"), rng.choice(["good", "bad", None]), y) for p in range(25) for y in range(2000, 2006) if rng.random() < 0.6]
    seasons = spark.createDataFrame(data, "name string, college string, class string, season int")
    key, attrs, tracked = ["name"], ["college"], ["class", "is_active"]
    states = carry_forward(seasons, key, "season", 2005)
    stored = Scd2Table("scd_of_players", str(tmp_path / "scd"), key, attrs, tracked, 4)
    year = lambda y: dt.date(y, 1, 1)
    columns = [*key, *attrs, *tracked, "start_date", "end_date", "snapshot_date"]
    try:
        stored.load(scd2_build(states, key, attrs, tracked, "season", 2000), year(2000))
        for y in range(2001, 2006):
            for _ in range(2 if y == 2003 else 1):  # a step can run again
                stored.step(spark, states.where(F.col("season") == y), year(y - 1), year(y))
        for y in (2002, 2005):
            assert rows(stored.read(spark, year(y)).select(columns)) == rows(scd2_build(states, key, attrs, tracked, "season", y).select(columns))
        step = stored.stepped(spark, states.where(F.col("season") == 2005), year(2004), year(2005))
        read = {f.split("/scd/")[1].split("/")[0:2][0] + "/" + f.split("/scd/")[1].split("/")[1] for f in step.inputFiles() if "/scd/" in f}
        assert read and all(r.startswith("open/") for r in read)
        text = plan(step)
        assert "/closed" not in text and "snapshot_date" in text
    finally:
        stored.forget(spark)
    assert not spark.catalog.tableExists("scd_of_players")


# --- joins with heavy keys


@pytest.fixture
def plain_joins(spark):
    """Neither broadcasts nor adaptive execution."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_heavy_keys_are_spread_and_others_are_not(spark, plain_joins):
    facts = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    dim = spark.range(-1, 8000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    heavy = heavy_keys(facts, ["k"], share=0.05)
    assert [round(s, 2) for s in heavy.values()] == [0.33]
    joined = spread_join(facts, dim, ["k"], share=0.05)
    assert rows(joined) == rows(facts.join(dim, "k"))
    assert joined.where("k = -1").select(F.spark_partition_id()).distinct().count() > 3
    assert plan(joined).count("Exchange hashpartitioning(k") == 2
    left = spread_join(facts, dim.where("k < 100"), ["k"], "left", share=0.05)
    assert rows(left) == rows(facts.join(dim.where("k < 100"), "k", "left"))
    # a list that is wrong changes nothing but where rows meet
    some = spread_join(facts, dim, ["k"], heavy={123: 0.9})
    assert rows(some) == rows(joined)
    with pytest.raises(ValueError):
        spread_join(facts, dim, ["k"], "full_outer")


def test_heavy_keys_of_small_and_null_tables(spark):
    empty = spark.createDataFrame([], "k string, j int, v int")
    assert heavy_keys(empty, ["k", "j"]) == {}
    assert spread_join(empty, empty.drop("v"), ["k", "j"]).count() == 0
    nulls = spark.createDataFrame([(None, 1)] * 50 + [("a", 2)], "k string, v int")
    assert rows(spread_join(nulls, spark.createDataFrame([("a", 9), (None, 8)], "k string, d int"), ["k"])) == [("a", 2, 9)]


def test_a_unique_dimension_is_not_sorted_by_its_columns(spark):
    fact = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (2, 1, 6)], "g int, p int, x int")
    dim = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "g int, n string, z int")
    columns = {"g": F.col("g"), "n": F.col("n"), "x": F.col("x")}
    unique = normalise_fact(fact, dim, ["g"], ["g", "p"], columns)
    sorting = normalise_fact(fact, dim, ["g"], ["g", "p"], columns, dim_unique=False)
    assert plan(unique).count("WindowGroupLimit") < plan(sorting).count("WindowGroupLimit")
    assert rows(unique) == rows(sorting) == [(1, "a", 5), (2, "b", 6)]
    twice = dim.unionByName(spark.createDataFrame([(1, "A", 3)], dim.schema))
    assert rows(normalise_fact(fact, twice, ["g"], ["g", "p"], columns)) == [(1, "A", 5), (2, "b", 6)]


# --- repeated messages, rejected rows, repeated batches


def test_repeated_events_count_once(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, "a", t), (2, "a", t + dt.timedelta(minutes=3)), (1, "a", t), (3, "a", None), (4, "b", t)]
    events = spark.createDataFrame(data * 2, "id int, ip string, ts timestamp")
    assert sorted(tuple(r)[2:] for r in sessionize(events, "ts", ["ip"], once=["id", "ts"]).collect()) == [("a", 2), ("b", 1)]


def test_stream_of_replayed_messages_equals_batch(spark, tmp_path):
    rng = random.Random(7)
    t = dt.datetime(2024, 1, 1)
    data = [(k, rng.choice("ab"), t + dt.timedelta(seconds=20 * k)) for k in range(60)] + [(99, "z", t + dt.timedelta(hours=9)), (100, "z", t + dt.timedelta(hours=20))]
    schema = "id int, ip string, ts timestamp"
    folder = str(tmp_path / "in")
    for k in range(0, len(data), 10):  # each file repeats messages of its own and of the one before
        part = data[k : k + 10]
        spark.createDataFrame(part + part[:5] + data[max(0, k - 1) : k], schema).coalesce(1).write.mode("append").parquet(folder)
    from tallyframe.streaming import sessions_to_batches

    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    sessions_to_batches(events, "ts", ["ip"], str(tmp_path / "out"), str(tmp_path / "check"), watermark="10 minutes", once=["id", "ts"]).awaitTermination()
    found = read_finished(spark, str(tmp_path / "out"), "session_start timestamp, session_end timestamp, ip string, event_count long").drop("batch_id")
    whole = sessionize(spark.createDataFrame(data, schema), "ts", ["ip"])
    assert rows(found.where("ip <> 'z'")) == rows(whole.where("ip <> 'z'"))


def test_a_broken_and_repeated_batch_counts_once(spark, tmp_path):
    sink, path = staged_sink(str(tmp_path)), str(tmp_path)
    first, second = (spark.createDataFrame([(k, f"b{k}")], "k int, v string") for k in (1, 2))
    sink(first, 0)
    sink(first, 0)  # repeated
    second.write.parquet(f"{path}/rows/batch_id=1")  # rows written, then the batch broke off
    assert rows(read_finished(spark, path, "k int, v string")) == [(0, 1, "b1")]
    sink(second, 1)
    sink(second.limit(0), 2)
    assert rows(read_finished(spark, path, "k int, v string")) == [(0, 1, "b1"), (1, 2, "b2")]


def test_rejects_are_counted_in_the_write(spark, tmp_path):
    texts = spark.createDataFrame([("1", "true", "x"), ("one", "TRUE", "y"), (None, "maybe", "z"), ("", None, "x")], "n string, b string, s string")
    typed, counts = clean_counted(texts, {"n": "int", "b": "boolean"})
    typed.write.parquet(str(tmp_path / "typed"))
    assert counts.get == {"rows": 4, "bad_n": 2, "bad_b": 1}
    seen, found = counted(texts, **null_keys(["n", "b"]), **outside_domain("s", ["x", "y"]))
    assert seen.count() == 4
    assert found.get == {"rows": 4, "null_n": 1, "null_b": 1, "outside_s": 1}
