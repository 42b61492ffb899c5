"""Small cases with known results, one or more per operator and per known pitfall."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyframe.functions import class_by_thresholds, clock_to_minutes
from tallyframe.operators import (
    activity_flags,
    array_length_histogram,
    assert_domain,
    assert_unique,
    bucket_join,
    clean_typed,
    cumulate_dates,
    cumulate_grouped,
    cumulate_history,
    datelist_int,
    datelist_words,
    dedup,
    edges,
    enrich_broadcast,
    enrich_left,
    grouping_sets_agg,
    growth_states,
    history_ratio,
    longest_streak,
    member_totals,
    normalise_fact,
    reduce_monthly,
    rolling_max_count,
    scd2_build,
    scd2_merge,
    top_k_per_group,
    top_n,
    unnest_history,
    unpack_monthly,
    unpaired_weights,
    unpivot_sides,
    vertices,
    win_flag,
)
from tallyframe.sources import empty_state


def D(day, month=1, year=2024):
    return dt.date(year, month, day)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain(value):
    """Structs and arrays of them as tuples and lists."""
    if isinstance(value, Row):
        return tuple(plain(v) for v in value)
    return [plain(v) for v in value] if isinstance(value, list) else value


# dedup and fact normalisation


def test_dedup_keeps_one_of_many_copies_and_null_keys(spark):
    kept = [(None, "x", 1.5), (4, None, 0.0), (4, "x", 2.0), (4, "y", 2.0)]
    copies = [row for k, row in enumerate(kept) for _ in range(k + 1)]
    df = spark.createDataFrame(copies, "shop int, till string, sum double")
    assert rows(dedup(df, ["shop", "till"])) == sorted(kept, key=repr)
    assert rows(dedup(df.limit(0), ["shop", "till"])) == []


def test_dedup_survivor_does_not_depend_on_row_order(spark):
    data = [(1, "b", 2), (1, "a", 9), (1, None, 1)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, v string, w int")
        assert rows(dedup(df, ["k"])) == [(1, "a", 9)]
        assert rows(dedup(df, ["k"], [F.col("w").desc()])) == [(1, "a", 9)]


def test_dedup_by_all_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedup(df, ["k"])) == [(1,), (2,)]


def test_normalise_fact_keeps_one_row_per_key_and_drops_unmatched(spark):
    fact = spark.createDataFrame(
        [(1, 7, "DNP - rest", "35"), (1, 7, "DNP - rest", "35"), (9, 7, None, "1:30")],
        "game int, player int, comment string, min string",
    )
    dim = spark.createDataFrame([(1, 2003)], "game int, season int")
    out = normalise_fact(
        fact, dim, ["game"], ["game", "player"],
        {"dim_season": F.col("season"), "m_minutes": clock_to_minutes("min")},
    )
    assert rows(out) == [(2003, 35.0)]
    with pytest.raises(ValueError):
        normalise_fact(fact, dim, ["game"], ["player"], {})


def test_clock_without_seconds_and_without_numbers(spark):
    df = spark.createDataFrame([("12:30",), ("35",), ("x",), (None,), ("",)], "c string")
    got = [r[0] for r in df.select(clock_to_minutes("c")).collect()]
    assert got == [12.5, 35.0, None, None, None]


# cumulative histories

STATE = "name string, college string, stats array<struct<season:int,pts:double>>, " \
        "class string, idle int, season int"
STEPS = [(20, "star"), (15, "good"), (10, "average")]


def step(prev, today):
    return cumulate_history(
        prev, today, ["name"], ["college"], F.struct("season", "pts"),
        period_prev="season", period_today="season", history="stats",
        classify=("class", class_by_thresholds("pts", STEPS, "bad")), recency="idle",
    )


def test_history_three_cases(spark):
    prev = spark.createDataFrame(
        [("both", "A", [(1999, 9.0)], "bad", 2, 2000), ("gone", "B", [(2000, 16.0)], "good", 0, 2000)],
        STATE,
    )
    today = spark.createDataFrame(
        [("both", None, 20.5, 2001), ("new", "C", None, 2001), (None, "D", 1.0, 2001)],
        "name string, college string, pts double, season int",
    )
    got = {r.name: plain(r)[1:] for r in step(prev, today).collect()}
    assert got == {
        "both": ("A", [(1999, 9.0), (2001, 20.5)], "star", 0, 2001),
        "gone": ("B", [(2000, 16.0)], "good", 1, 2001),
        "new": ("C", [(2001, None)], "bad", 0, 2001),
    }


def test_history_first_run_on_empty_state_with_text_numbers(spark):
    seasons = spark.createDataFrame(
        [("Ann Bay", "None", "7", 1996), ("Cy Dow", "Undrafted", "14.8", 1996)],
        "name string, college string, pts string, season long",
    )
    prev = empty_state(spark, "name string, college string, stats array<double>, season int")
    out = cumulate_history(
        prev, seasons, ["name"], ["college"], F.col("pts").try_cast("double"),
        period_prev="season", period_today="season", history="stats",
    )
    assert out.schema["stats"].dataType.simpleString() == "array<double>"
    assert [plain(r) for r in out.orderBy("name").collect()] == [
        ("Ann Bay", "None", [7.0], 1996), ("Cy Dow", "Undrafted", [14.8], 1996),
    ]


def test_history_null_history_without_current_row_stays_null(spark):
    prev = spark.createDataFrame([("a", "A", None, "bad", 0, 2000)], STATE)
    today = spark.createDataFrame([], "name string, college string, pts double, season int")
    assert rows(step(prev, today)) == [("a", "A", None, "bad", 1, 2001)]


def test_ratio_guards_zero_and_puts_missing_first(spark):
    df = spark.createDataFrame(
        [("zero", [(1, 0.0), (2, 8.0)]), ("half", [(1, 4.0), (2, 2.0)]), ("none", None)],
        "name string, h array<struct<s:int,pts:double>>",
    )
    got = [tuple(r) for r in history_ratio(df, "h", "pts", ["name"]).collect()]
    assert got == [("none", None), ("zero", 8.0), ("half", 0.5)]
    assert rows(unnest_history(df, ["name"], "h")) == [
        ("half", 1, 4.0), ("half", 2, 2.0), ("zero", 1, 0.0), ("zero", 2, 8.0)
    ]


GROUPED = "id string, part int, name string, films array<struct<film:string,rating:double,copies:long>>, " \
          "class string, active boolean, year int"


def grouped_step(prev, facts, year, **more):
    return cumulate_grouped(
        prev, facts, ["id"], ["name"], F.struct("film", "rating"),
        metric="rating", period=year, period_name="year", history="films",
        classify=("class", lambda a: class_by_thresholds(
            a, [(8, "star"), (7, "good"), (6, "average")], "bad")),
        active="active", **more,
    )


@pytest.mark.parametrize("n_parts", [1, 3])
def test_grouped_history_and_renamed_entity(spark, n_parts):
    def old(who, name, film, label):
        return [(who, part, name, [(*film, 1)] if part == 0 else [], label, True, 1990) for part in range(n_parts)]

    prev = spark.createDataFrame(
        old("a", "Al", ("f0", 6.5), "average") + old("b", "Bo", ("g0", 9.0), "star"), GROUPED
    )
    facts = spark.createDataFrame(
        [("a", "Al", "f2", 9.0), ("a", "Al B.", "f1", 7.0), ("a", "Al", "f2", 9.0), ("c", "Cy", "h1", 7.5)],
        "id string, name string, film string, rating double",
    )
    out = grouped_step(prev, facts, 1991, n_parts=n_parts).collect()
    heads = {r.id: (r.name, r["class"], r.active, r.year) for r in out}
    assert heads == {"a": ("Al", "star", True, 1991), "b": ("Bo", "star", False, 1991), "c": ("Cy", "good", True, 1991)}
    assert len({(r.id, r.part) for r in out}) == len(out) == 3 * n_parts
    films = {k: sorted(f for r in out if r.id == k for f in plain(r.films)) for k in heads}
    assert films == {
        "a": [("f0", 6.5, 1), ("f1", 7.0, 1), ("f2", 9.0, 2)], "b": [("g0", 9.0, 1)], "c": [("h1", 7.5, 1)]
    }


def test_bitmaps_beyond_one_word(spark):
    df = spark.createDataFrame([(1, [D(1), D(25, 2)])], "u int, dates array<date>")
    with pytest.raises(ValueError, match="does not fit"):
        datelist_int(df, "dates", D(25, 2), D(1), D(25, 2))
    assert datelist_words(df, "dates", D(25, 2), D(1)).first().datelist_words == [1 << 31, 1 << (31 - (55 - 32))]


def test_normalise_fact_with_copies_on_both_sides(spark):
    fact = spark.createDataFrame([(1, 7, "35")] * 3, "game int, player int, min string")
    dim = spark.createDataFrame([(1, 2003)] * 2, "game int, season int")
    out = normalise_fact(fact, dim, ["game"], ["game", "player"], {"s": F.col("season"), "p": F.col("player")})
    assert rows(out) == [(2003, 7)]


# active days


def test_dates_with_two_keys_gap_and_null_key(spark):
    prev = spark.createDataFrame(
        [(1, "x", [D(1)], D(1)), (2, "x", [D(1)], D(1)), (None, "x", [D(1)], D(1))],
        "u int, b string, dates array<date>, day date",
    )
    today = spark.createDataFrame(
        [(1, "x", D(2)), (1, "y", D(2)), (None, "x", D(2))], "u int, b string, active_date date"
    )
    got = rows(cumulate_dates(prev, today, ["u", "b"], "dates", "day"))
    assert got == [
        (1, "x", [D(1), D(2)], D(2)), (1, "y", [D(2)], D(2)), (2, "x", [D(1)], D(2))
    ]


def test_left_enrichment_defaults(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "d int")
    dim = spark.createDataFrame([(1, "web"), (2, None)], "d int, kind string")
    assert rows(enrich_left(facts, dim, "d", {"kind": "Unknown"})) == [
        (1, "web"), (2, "Unknown"), (3, "Unknown")
    ]


# bitmaps


@pytest.mark.parametrize(
    "days, anchor, flags",
    [
        ([31], 31, (True, True, True)),
        ([25], 31, (True, True, False)),
        ([24], 31, (True, False, False)),
        ([], 31, (False, False, False)),
        ([31], 32, (False, False, False)),
        ([30], 32, (True, True, True)),
        ([24], 32, (True, True, False)),
    ],
)
def test_activity_flags(spark, days, anchor, flags):
    df = spark.createDataFrame([([D(d) for d in days],)], "dates array<date>")
    bits = datelist_int(df, "dates", D(31), D(1), D(31), anchor)
    assert bits.first().datelist_int == sum(2 ** (anchor - (31 - d)) for d in days)
    assert tuple(activity_flags(bits).drop("dates", "datelist_int").first()) == flags


def test_bitmap_ignores_days_outside_the_series(spark):
    old = dt.date(2023, 11, 1)
    df = spark.createDataFrame([([old, D(2), D(30), D(31)],)], "dates array<date>")
    bits = datelist_int(df, "dates", D(31), D(1), D(30))
    assert bits.first().datelist_int == 2**30 + 2**2


# monthly arrays

MONTH = "h string, month date, hits array<long>"


def month_step(spark, prev, today, day, **more):
    prev = spark.createDataFrame(prev, MONTH)
    today = spark.createDataFrame(today, "h string, n long")
    return rows(reduce_monthly(prev, today, ["h"], D(day), {"hits": "n"}, **more))


def test_monthly_append_pad_and_zero(spark):
    prev = [("a", D(1), [4, 0]), ("b", D(1), [1, 2]), ("old", D(1, year=2023), [9])]
    assert month_step(spark, prev, [("a", 7), ("c", 3), (None, 1)], 3) == [
        ("a", D(1), [4, 0, 7]), ("b", D(1), [1, 2, 0]), ("c", D(1), [0, 0, 3])
    ]
    assert month_step(spark, [], [("a", 5)], 1) == [("a", D(1), [5])]


def test_monthly_same_day_again_and_skipped_day(spark):
    assert month_step(spark, [("a", D(1), [4, 5])], [("a", 9)], 2) == [("a", D(1), [4, 9])]
    assert month_step(spark, [("a", D(1), [4])], [("a", 9)], 3) == [("a", D(1), [4, 0, 9])]
    again = month_step(spark, [("a", D(1), [4, 5])], [("a", 9)], 2, as_written=True)
    assert again == [("a", D(1), [4, 5, 9])]


def test_monthly_metrics_do_not_mix(spark):
    prev = spark.createDataFrame(
        [("a", "hits", D(1), [1]), ("a", "errors", D(1), [8])],
        "h string, metric string, month date, v array<long>",
    )
    today = spark.createDataFrame([("a", "hits", 2)], "h string, metric string, n long")
    got = rows(reduce_monthly(prev, today, ["h", "metric"], D(2), {"v": "n"}))
    assert got == [("a", "errors", D(1), [8, 0]), ("a", "hits", D(1), [1, 2])]


def test_unpack_and_lengths(spark):
    df = spark.createDataFrame([("a", D(1), [1, 2]), ("b", D(1), [10])], MONTH).withColumn(
        "metric", F.lit("m")
    )
    assert rows(unpack_monthly(df, ["metric"], "month", "hits")) == [
        ("m", D(1), 11), ("m", D(2), 2)
    ]
    late = unpack_monthly(df, ["metric"], "month", "hits", first_offset=1)
    assert rows(late) == [("m", D(2), 11), ("m", D(3), 2)]
    assert rows(array_length_histogram(df, "hits")) == [(1, 1), (2, 1)]


# slowly changing dimensions

TRACKED = ["class", "active"]
STATES = "id string, name string, class string, active boolean, year int"


def Y(year):
    return dt.date(year, 1, 1)


def build(spark, data, snapshot, **more):
    df = spark.createDataFrame(data, STATES)
    out = scd2_build(df, ["id"], ["name"], TRACKED, "year", snapshot, **more)
    return rows(out.select("id", *TRACKED, "start_date", "end_date"))


def test_scd_build_with_nulls_gap_and_return(spark):
    data = [
        ("a", "A", "bad", True, 1988), ("a", "A", "bad", True, 1989),
        ("a", "A", None, True, 1990), ("a", "A", "bad", True, 1992), ("a", "A", "star", True, 1993),
    ]
    assert build(spark, data, 1992) == [
        ("a", "bad", True, Y(1988), Y(1989)),
        ("a", "bad", True, Y(1992), Y(1992)),
        ("a", None, True, Y(1990), Y(1990)),
    ]
    # Changes from and to NULL are no changes here, and years after the snapshot are read.
    assert build(spark, data, 1992, as_written=True) == [
        ("a", "bad", True, Y(1988), Y(1992)),
        ("a", "star", True, Y(1993), Y(1993)),
        ("a", None, True, Y(1990), Y(1990)),
    ]


SCD = "id string, name string, class string, active boolean, start_date date, end_date date, " \
      "snapshot_date date"


def merge(spark, current, **more):
    scd = spark.createDataFrame(
        [
            ("hist", "H", "bad", True, Y(1980), Y(1985), Y(1990)),
            ("same", "S", "good", True, Y(1988), Y(1990), Y(1990)),
            ("diff", "D", "good", True, Y(1989), Y(1990), Y(1990)),
            ("null", "N", None, True, Y(1989), Y(1990), Y(1990)),
            ("lost", "L", "bad", True, Y(1990), Y(1990), Y(1990)),
            ("same", "S", "bad", False, Y(1980), Y(1981), Y(1989)),
        ],
        SCD,
    )
    now = spark.createDataFrame(current, STATES)
    out = scd2_merge(scd, now, ["id"], ["name"], TRACKED, Y(1990), Y(1991), **more)
    assert {r.snapshot_date for r in out.collect()} == {Y(1991)}
    return rows(out.select("id", *TRACKED, "start_date", "end_date"))


CURRENT = [
    ("same", "S", "good", True, 1991), ("diff", "D", "star", False, 1991),
    ("null", "N", "bad", True, 1991), ("new", "W", "bad", True, 1991),
]


def test_scd_merge(spark):
    assert merge(spark, CURRENT) == sorted([
        ("hist", "bad", True, Y(1980), Y(1985)),
        ("same", "good", True, Y(1988), Y(1991)),
        ("diff", "good", True, Y(1989), Y(1990)),
        ("diff", "star", False, Y(1991), Y(1991)),
        ("null", None, True, Y(1989), Y(1990)),
        ("null", "bad", True, Y(1991), Y(1991)),
        ("lost", "bad", True, Y(1990), Y(1990)),
        ("new", "bad", True, Y(1991), Y(1991)),
    ], key=repr)


def test_scd_merge_as_written(spark):
    """Equal and NULL-changed rows are lost, doubly changed ones also get extended."""
    assert merge(spark, CURRENT, as_written=True) == sorted([
        ("hist", "bad", True, Y(1980), Y(1985)),
        ("diff", "star", False, Y(1989), Y(1991)),
        ("diff", "good", True, Y(1989), Y(1990)),
        ("diff", "star", False, Y(1991), Y(1991)),
        ("new", "bad", True, Y(1991), Y(1991)),
    ], key=repr)


# graph


def test_vertices_keep_null_properties(spark):
    df = spark.createDataFrame([(1, None, ["x"])], "id long, city string, teams array<string>")
    assert rows(vertices(df, "id", "team", {"city": "city", "teams": "teams"})) == [
        ("1", "team", '{"city":null,"teams":["x"]}')
    ]


def test_duplicate_facts_count_once(spark):
    facts = spark.createDataFrame(
        [(1, 7, 10, "x"), (1, 7, 10, "x"), (2, 7, 5, "y")],
        "game int, player int, pts int, team string",
    )
    assert rows(member_totals(facts, "player", "game", "pts", "team")) == [(7, 2, 15, ["x", "y"])]
    raw = member_totals(facts, "player", "game", "pts", "team", raw_rows=True)
    assert rows(raw) == [(7, 3, 25, ["x", "y"])]
    links = edges(facts, ("player", "player"), ("game", "game"), "plays_in", {"pts": "pts"})
    assert rows(links) == [
        ("7", "player", "1", "game", "plays_in", '{"pts":10}'),
        ("7", "player", "2", "game", "plays_in", '{"pts":5}'),
    ]


# growth


def test_growth_states(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("a", 5), (None, 3), ("b", 4)], "p string, s int"
    )
    got = [tuple(r) for r in growth_states(df, "p", "s").orderBy("p", "period").collect()]
    assert got == [
        ("a", True, "New", 1, None, 1),
        ("a", True, "Continued Playing", 1, 1, 2),
        ("a", False, "Retired", 1, 2, 3),
        ("a", False, "Stayed Retired", 1, 2, 4),
        ("a", True, "Returned from Retirement", 1, 2, 5),
        ("b", True, "New", 4, None, 4),
    ]
    longer = growth_states(df, "p", "s", horizon=6).where("p = 'b'").orderBy("period").collect()
    assert [r.state for r in longer] == ["New", "Retired", "Stayed Retired"]


# analytics


def test_win_flag_is_false_for_missing_results(spark):
    df = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (2, 1, 0), (2, 1, 1), (1, 1, None), (None, 1, 0)],
        "t int, home int, won int",
    )
    got = [r[0] for r in df.select(win_flag("t", "home", "won")).collect()]
    assert got == [True, False, True, False, False, False]


def test_grouping_sets_ids_and_distinct_wins(spark):
    df = spark.createDataFrame(
        [(1, "t", "p", 10, True, 5), (1, "t", "p", 10, True, 6), (2, "t", "q", 11, False, 7)],
        "season int, team string, player string, game int, win boolean, pts int",
    )
    out = grouping_sets_agg(
        df, ["season", "team", "player"],
        [["team", "player"], ["season", "player"], ["team"]],
        {"pts": F.sum("pts"), "wins": F.count_distinct(F.when(F.col("win"), F.col("game")))},
    )
    assert rows(out) == sorted([
        (None, "t", "p", 11, 1, 4), (None, "t", "q", 7, 0, 4),
        (1, None, "p", 11, 1, 2), (2, None, "q", 7, 0, 2),
        (None, "t", None, 18, 1, 5),
    ], key=repr)


def test_ties_go_to_the_smaller_key(spark):
    df = spark.createDataFrame([("t", 2, 9), ("t", 1, 9), ("u", 3, 1)], "t string, p int, n int")
    best = top_k_per_group(df, ["t"], [F.col("n").desc(), F.col("p").asc()])
    assert rows(best) == [("t", 1, 9), ("u", 3, 1)]
    assert rows(top_n(df, ["p"], {"n": F.sum("n")}, "n")) == [(1, 9)]


def test_unpivot_counts_a_missing_result_for_nobody(spark):
    games = spark.createDataFrame([(1, 2, 1), (2, 1, 1), (3, 1, None)], "h int, a int, w int")
    wins = unpivot_sides(games, "h", "a", "w").groupBy("team_id").agg(
        F.sum(F.col("win").cast("int")).alias("n")
    )
    assert rows(wins) == [(1, 1), (2, 1), (3, None)]


def test_rolling_window(spark):
    data = [("t", D(d), d in (1, 2, 5, 6, 7)) for d in range(1, 9)] + [("t", D(1), True)]
    df = spark.createDataFrame(data + [("u", D(1), None)], "t string, d date, w boolean")
    assert rows(rolling_max_count(df, "t", "d", "w", 3)) == [("t", 3), ("u", 0)]
    assert rows(rolling_max_count(df, "t", "d", "w", 2)) == [("t", 2), ("u", 0)]


def test_streak_broken_in_the_middle(spark):
    flags = {"p": [1, 1, 0, 1, 1, 1, 0], "q": [0, 0], "r": [1], "s": [None, 1]}
    data = [(k, D(i + 1), v) for k, vs in flags.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "k string, d date, v int")

    def run(segment, **more):
        return dict(rows(longest_streak(df, ["k"], ["d"], F.col("v") == 1, segment, **more)))

    for segment in (F.lit(0), F.col("d"), F.floor(F.dayofmonth("d") / 2), F.dayofmonth("d") > 4):
        assert run(segment) == {"p": 3, "q": 0, "r": 1, "s": 1}
        assert run(segment, count_break=True) == {"p": 4, "q": 1, "r": 1, "s": 2}


# cleansing and joins


def test_clean_typed(spark):
    df = spark.createDataFrame(
        [("1", "TRUE", "2015-11-05 00:00:00.000000"), ("x", "0", "soon"), (None, "maybe", None)],
        "n string, flag string, at string",
    )
    out = clean_typed(
        df, {"n": "int", "flag": "boolean", "at": "timestamp:yyyy-MM-dd HH:mm:ss.SSSSSS"}
    )
    assert [tuple(r) for r in out.collect()] == [
        (1, True, dt.datetime(2015, 11, 5)), (None, False, None), (None, None, None)
    ]


def test_enrichment_leaves_the_join_to_spark(spark):
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = enrich_broadcast(facts, dim, "k")
    assert rows(out) == [(1, "a"), (2, "b")]
    assert "hint" not in out._jdf.queryExecution().analyzed().toString().lower()


def test_medals_meet_their_own_player(spark):
    details = spark.createDataFrame([(1, "a", 9), (1, "b", 3)], "m int, p string, kills int")
    matches = spark.createDataFrame([(1, "map")], "m int, mapid string")
    medals = spark.createDataFrame([(1, "a", "x", 2), (1, "a", "y", 1)],
                                   "m int, p string, medal string, n int")
    assert rows(bucket_join(details, matches, medals, "m", "p")) == [
        (1, "a", 9, "x", 2, "map"), (1, "a", 9, "y", 1, "map")
    ]
    assert rows(unpaired_weights(details, medals, "m")) == [(1, "a", 9, 2), (1, "b", 3, 2)]


# checks


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert assert_domain(df, "v", ["a", "b"]) is df
    assert assert_unique(df, ["k", "v"]) is df
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(df, ["k"])
    with pytest.raises(ValueError, match="outside"):
        assert_domain(df, "v", ["a"])
