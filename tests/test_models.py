"""The ready-made models on small tables with their own columns."""

import datetime as dt

import pytest
from pyspark.sql import Row

from tallyframe.models import actors, games, matches, players, web
from tallyframe.sources import empty_state


def plain(value):
    if isinstance(value, Row):
        return tuple(plain(v) for v in value)
    return [plain(v) for v in value] if isinstance(value, list) else value


def rows(df):
    return sorted((plain(r) for r in df.collect()), key=repr)


# players


@pytest.fixture(scope="module")
def seasons(spark):
    data = [
        ("Ann", "6-1", "None", "USA", "1999", "1", "2", 70, 10.0, 4.0, 2.0, 2000),
        ("Ann", "6-1", "None", "USA", "1999", "1", "2", 71, 21.0, 5.0, 3.0, 2001),
        ("Bob", "6-9", "Yale", "USA", "Undrafted", "Undrafted", "Undrafted", 9, 12.0, 1.0, 1.0,
         2000),
        ("Bob", "6-9", "Yale", "USA", "Undrafted", "Undrafted", "Undrafted", 8, 3.0, 1.0, 1.0,
         2002),
    ]
    names = ["player_name", *players.ATTRS, "gp", "pts", "reb", "ast", "season"]
    kinds = ["string"] * 7 + ["float"] * 4 + ["int"]
    data = [(*r[:7], *map(float, r[7:11]), r[11]) for r in data]
    return spark.createDataFrame(
        data, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    )


def test_players(spark, seasons):
    state = empty_state(spark, players.PLAYERS_SCHEMA)
    for season in (2000, 2001):
        state = players.players_step(state, seasons, season)
    got = {r.player_name: plain(r)[7:] for r in state.collect()}
    assert got == {
        "Ann": (
            [(2000, 70.0, 10.0, 4.0, 2.0), (2001, 71.0, 21.0, 5.0, 3.0)], "star", 0, 2001
        ),
        "Bob": ([(2000, 9.0, 12.0, 1.0, 1.0)], "average", 1, 2001),
    }
    assert [tuple(r) for r in players.player_improvement(state, 2001).collect()] == [
        ("Ann", pytest.approx(2.1)), ("Bob", 1.0)
    ]
    assert players.player_seasons(state, 2001).count() == 3


def test_player_points_on_first_run(spark, seasons):
    attrs = ", ".join(f"{a} string" for a in players.ATTRS)
    state = empty_state(
        spark, f"player_name string, {attrs}, season_stats array<double>, current_season int"
    )
    out = players.player_points_step(state, seasons.withColumn("pts", seasons.pts.cast("string")),
                                     2000)
    got = [(r.player_name, r.season_stats, r.current_season) for r in out.collect()]
    assert got == [("Ann", [10.0], 2000), ("Bob", [12.0], 2000)]


def test_player_states(seasons):
    states = players.player_states(seasons).collect()
    got = [(r.player_name, r.player_state, r.season) for r in states]
    assert got == [
        ("Ann", "New", 2000), ("Ann", "Continued Playing", 2001),
        ("Bob", "New", 2000), ("Bob", "Retired", 2001), ("Bob", "Returned from Retirement", 2002),
    ]


# games

HOME, AWAY = 10, 20


@pytest.fixture(scope="module")
def league(spark):
    results = {1: 1, 2: 0, 3: 1, 4: None}
    game_rows = [
        (dt.date(2003, 1, g), g, HOME, AWAY, 2003, 90.0, 80.0, won) for g, won in results.items()
    ]
    game_table = spark.createDataFrame(
        game_rows,
        "game_date_est date, game_id int, home_team_id int, visitor_team_id int, season int, "
        "pts_home double, pts_away double, home_team_wins int",
    )
    points = {1: 30.0, 2: 5.0, 3: 12.0, 4: 11.0}
    columns = (
        "game_id int, team_id int, team_abbreviation string, player_id int, player_name string, "
        "start_position string, comment string, min string, pts double, "
        + ", ".join(f"`{c}` double" for c in games.MEASURES.values())
    )
    extra = [1.0] * len(games.MEASURES)
    details = [
        (g, HOME, "HOM", 7, "Kay", "F", None, "30:30", p, *extra) for g, p in points.items()
    ]
    details += [
        (g, AWAY, "AWY", 8, "Lou", None, "DNP - rest", None, None, *extra) for g in points
    ]
    details.append(details[0])
    return spark.createDataFrame(details, columns), game_table


def test_game_facts(league):
    details, table = league
    assert games.dedup_details(details).count() == 8
    facts = games.game_facts(details, table)
    assert facts.count() == 8
    kay = facts.where("dim_player_id = 7 AND dim_game_date = '2003-01-01'").first()
    assert (kay.dim_is_playing_at_home, kay.m_minutes, kay.m_turnovers) == (True, 30.5, 1)
    lou = facts.where("dim_player_id = 8").first()
    assert (lou.dim_did_not_play, lou.dim_did_not_dress, lou.m_minutes) == (True, False, None)


def test_graph(spark, league):
    details, table = league
    teams = spark.createDataFrame(
        [(HOME, "HOM", "Homers", "X", None, 1950)] * 2,
        "team_id int, abbreviation string, nickname string, city string, arena string, "
        "yearfounded int",
    )
    got = {(r.identifier, r.type): r.properties
           for r in games.graph_vertices(table, details, teams).collect()}
    assert len(got) == 4 + 2 + 1
    assert got["2", "game"] == '{"pts_home":90.0,"pts_away":80.0,"winning_team":20}'
    assert got["7", "player"] == (
        '{"player_name":"Kay","number_of_games":4,"total_points":58.0,"teams":[10]}'
    )
    assert '"arena":null' in got["10", "team"]
    links = games.graph_edges(details)
    assert links.count() == 8
    assert links.where("subject_identifier = '7' AND object_identifier = '1'").first()[
        "properties"
    ] == '{"start_position":"F","pts":30.0,"team_id":10,"team_abbreviation":"HOM"}'


def test_game_questions(league):
    details, table = league
    details = games.dedup_details(details)
    board = {(r.grp_id, r.season, r.team_id, r.player_id): (r.points, r.win_counts)
             for r in games.dashboard(details, table).collect()}
    assert board[4, None, HOME, 7] == (58.0, 2)
    assert board[2, 2003, None, 8] == (0.0, 1)
    assert board[5, None, HOME, None] == (58.0, 2)
    assert rows(games.best_scorer_per_team(details)) == [(HOME, 7, 58.0), (AWAY, 8, 0.0)]
    assert rows(games.best_scorer_per_team(details, single_game=True))[0] == (HOME, 7, 30.0)
    assert rows(games.best_season(details, table)) == [(2003, 7, 58.0)]
    assert rows(games.most_wins(table)) == [(HOME, 2)]
    assert [tuple(r) for r in games.wins_in_a_stretch(details, table).collect()] == [
        (HOME, 2), (AWAY, 1)
    ]
    assert rows(games.longest_scoring_streak(details, table, "Kay")) == [(2,)]
    assert rows(games.longest_scoring_streak(details, table, "Kay", count_break=True)) == [(3,)]


# actors


def test_actors(spark):
    films = spark.createDataFrame(
        [
            ("a", "Al", 1990, "f1", 10, 9.0, "1"), ("a", "Al", 1990, "f2", 10, 8.0, "2"),
            ("a", "Al", 1992, "f3", 10, 5.0, "3"), ("b", "Bo", 1991, "g1", 10, 6.5, "4"),
        ],
        "actorid string, actor string, year int, film string, votes int, rating float, "
        "filmid string",
    )
    state, table, history = empty_state(spark, actors.ACTORS_SCHEMA), None, None
    for year in (1990, 1991, 1992):
        state = actors.actors_step(state, films, year)
        table = state if table is None else table.unionByName(state)
        if history is None:
            history = actors.actors_history(table, year)
        else:
            history = actors.actors_history_step(history, table, year)
    assert {r.actorid: (len(r.films), r.quality_class, r.is_active) for r in state.collect()} == {
        "a": (3, "bad", True), "b": (1, "average", False)
    }
    expected = [
        ("a", "star", True, 1990, 1990), ("a", "star", False, 1991, 1991),
        ("a", "bad", True, 1992, 1992), ("b", "average", True, 1991, 1991),
        ("b", "average", False, 1992, 1992),
    ]
    for df in (history, actors.actors_history(table, 1992)):
        got = [
            (r.actorid, r.quality_class, r.is_active, r.start_date.year, r.end_date.year)
            for r in df.collect()
        ]
        assert sorted(got) == sorted(expected)


# web


@pytest.fixture(scope="module")
def traffic(spark):
    events = spark.createDataFrame(
        [
            (1, 100, "h1", "2023-01-01 10:00:00.000000"), (1, 101, "h1", "2023-01-01 11:00:00"),
            (1, 100, "h2", "2023-01-02 10:00:00"), (None, 100, "h1", "2023-01-02 10:00:00"),
            (2, 999, "h1", "2023-01-03 23:59:59"), (2, None, "h1", "2023-01-03 00:00:00"),
            (3, 100, "h1", "not a time"),
        ],
        "user_id long, device_id long, host string, event_time string",
    )
    devices = spark.createDataFrame(
        [(100, "Firefox"), (101, "Firefox")], "device_id long, browser_type string"
    )
    return events, devices


DAYS = [dt.date(2023, 1, d) for d in (1, 2, 3)]


def test_active_days_and_bitmaps(spark, traffic):
    events, devices = traffic
    by_browser = empty_state(spark, web.USER_DEVICES_SCHEMA)
    hosts, users = empty_state(spark, web.HOSTS_SCHEMA), empty_state(spark, web.USERS_SCHEMA)
    for day in DAYS:
        by_browser = web.user_devices_step(by_browser, events, devices, day)
        hosts = web.hosts_step(hosts, events, day)
        users = web.users_step(users, events, day)
    assert rows(by_browser) == [
        (1, "Firefox", DAYS[:2], DAYS[2]), (2, "Unknown", DAYS[2:], DAYS[2])
    ]
    assert rows(hosts) == [("h1", DAYS, DAYS[2]), ("h2", [DAYS[1]], DAYS[2])]
    assert rows(users) == [("1", DAYS[:2], DAYS[2]), ("2", DAYS[2:], DAYS[2])]
    bits = web.device_bitmaps(by_browser, DAYS[2], DAYS[0]).collect()
    assert {r.user_id: r.datelist_int for r in bits} == {1: 2**29 + 2**30, 2: 2**31}
    assert rows(web.user_activity(users, DAYS[2], DAYS[0])) == [
        ("1", True, True, False), ("2", True, True, True)
    ]


def test_monthly_arrays(spark, traffic):
    events, _ = traffic
    hosts = empty_state(spark, web.HOST_MONTH_SCHEMA)
    users = empty_state(spark, web.USER_MONTH_SCHEMA)
    for day in DAYS:
        hosts = web.host_month_step(hosts, events, day)
        users = web.user_month_step(users, events, day)
    assert rows(hosts) == [
        ("h1", DAYS[0], [2, 1, 2], [1, 0, 1]), ("h2", DAYS[0], [0, 1, 0], [0, 1, 0])
    ]
    assert rows(users) == [
        (1, "site_hits", DAYS[0], [2, 1, 0]), (2, "site_hits", DAYS[0], [0, 0, 2])
    ]
    assert rows(web.user_month_lengths(users)) == [(3, 2)]
    assert rows(web.daily_totals(users)) == [
        ("site_hits", day, n) for day, n in zip(DAYS, (2, 1, 2), strict=True)
    ]


# matches


def test_matches_from_csv(spark, tmp_path):
    files = {
        "matches": "match_id,mapid,is_team_game,playlist_id,completion_date\n"
                   "m1,a,true,p,2016-01-01 00:00:00.000000\nm2,a,0,p,bad\nm3,b,,q,\n",
        "maps": "mapid,name\na,Alpha\nb,Beta\n",
        "match_details": "match_id,player_gamertag,player_total_kills,player_total_deaths\n"
                         "m1,x,10,1\nm1,y,20,2\nm2,x,40,3\nm3,y,none,3\n",
        "medals_matches_players": "match_id,player_gamertag,medal_id,count\n"
                                  "m1,x,1,2\nm1,x,2,1\nm3,y,1,5\n",
        "medals": "medal_id,name\n1,Killing Spree\n2,Other\n",
    }
    for name, content in files.items():
        (tmp_path / f"{name}.csv").write_text(content)
    details, match, medals = matches.bucket_tables(
        *matches.read_tables(spark, str(tmp_path)), str(tmp_path / "tables"), "csv_test_"
    )
    got = {r.match_id: (r.is_team_game, r.completion_date) for r in match.collect()}
    assert got == {"m1": (True, dt.datetime(2016, 1, 1)), "m2": (False, None), "m3": (None, None)}
    together = matches.joined(details, match, medals)
    assert together.count() == 3
    assert rows(matches.most_kills(details)) == [("x", 25.0)]
    assert rows(matches.most_kills_per_medal_row(details, medals)) == [("y", 20.0)]
    assert rows(matches.most_played(match, details, "playlist_id")) == [("p", 2)]
    assert rows(matches.most_played(match, details, "mapid")) == [("a", 2)]
    assert rows(matches.map_with_most_medals(match, medals)) == [("b", 5)]
    report = matches.layouts(together, str(tmp_path / "layouts"))
    assert {r.layout: r.files > 0 for r in report.collect()} == {
        "playlist_sorted_first": True, "mapid_sorted_first": True
    }
    for name in ("match_details", "matches", "medal_matches_players"):
        spark.sql(f"DROP TABLE csv_test_{name}_bucketed")
