"""Games, what players did in them, and teams.

``details``: game_id, team_id, team_abbreviation, player_id, player_name, start_position, comment,
min, fgm .. plus_minus, pts. ``games``: game_date_est, game_id, home_team_id, visitor_team_id,
season, pts_home, pts_away, home_team_wins. ``teams``: team_id, abbreviation, nickname, city,
arena, yearfounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock_to_minutes, contains_token
from ..operators import (
    dedup,
    edges,
    grouping_sets_totals,
    longest_streak,
    member_pairs,
    member_totals,
    memberships,
    normalise_fact,
    rolling_max_count,
    top_k_per_group,
    top_n,
    union_all,
    unpivot_sides,
    vertices,
    win_flag,
)

DETAIL_KEY = ["game_id", "team_id", "player_id"]

# Marks in the comment of a player who did not play.
ABSENCES = {"dim_did_not_play": "DNP", "dim_did_not_dress": "DND", "dim_not_with_team": "NWT"}

# Counted columns of a fact and the columns they come from.
MEASURES = {
    "m_fgm": "fgm",
    "m_fga": "fga",
    "m_fg3m": "fg3m",
    "m_fg3a": "fg3a",
    "m_ftm": "ftm",
    "m_fta": "fta",
    "m_oreb": "oreb",
    "m_dreb": "dreb",
    "m_reb": "reb",
    "m_ast": "ast",
    "m_stl": "stl",
    "m_blk": "blk",
    "m_turnovers": "TO",
    "m_pf": "pf",
    "m_plus_minus": "plus_minus",
}


def dedup_details(details: DataFrame) -> DataFrame:
    """One row per game, team and player."""
    return dedup(details, DETAIL_KEY)


def game_facts(details: DataFrame, games: DataFrame) -> DataFrame:
    """Typed facts per game date, team and player."""
    dim = games.select("game_id", "game_date_est", "season", "home_team_id")
    columns = {
        "dim_game_date": F.col("game_date_est"),
        "dim_season": F.col("season"),
        "dim_team_id": F.col("team_id"),
        "dim_player_id": F.col("player_id"),
        "dim_player_name": F.col("player_name"),
        "dim_start_position": F.col("start_position"),
        "dim_is_playing_at_home": F.col("team_id") == F.col("home_team_id"),
        **{name: contains_token("comment", mark) for name, mark in ABSENCES.items()},
        "m_minutes": clock_to_minutes("min"),
        **{name: F.col(source).cast("int") for name, source in MEASURES.items()},
    }
    return normalise_fact(details, dim, ["game_id"], DETAIL_KEY, columns)


def graph_vertices(
    games: DataFrame, details: DataFrame, teams: DataFrame, raw_rows: bool = False
) -> DataFrame:
    """Games, players and teams. With ``raw_rows`` duplicates count in a player's totals."""
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(
        F.col("visitor_team_id")
    )
    players = member_totals(
        details, "player_id", "game_id", "pts", "team_id", ["player_name"], raw_rows
    )
    return union_all(
        [
            vertices(
                games,
                "game_id",
                "game",
                {"pts_home": "pts_home", "pts_away": "pts_away", "winning_team": winner},
            ),
            vertices(
                players,
                "player_id",
                "player",
                {
                    "player_name": "player_name",
                    "number_of_games": "number_of_events",
                    "total_points": "total_amount",
                    "teams": "groups",
                },
            ),
            vertices(
                dedup(teams, ["team_id"]),
                "team_id",
                "team",
                {
                    "abbreviation": "abbreviation",
                    "nickname": "nickname",
                    "city": "city",
                    "arena": "arena",
                    "year_founded": "yearfounded",
                },
            ),
        ]
    )


def graph_edges(details: DataFrame) -> DataFrame:
    """Players in games."""
    names = ["start_position", "pts", "team_id", "team_abbreviation"]
    return edges(
        details.select("game_id", "player_id", *names),
        ("player_id", "player"),
        ("game_id", "game"),
        "plays_in",
        {name: name for name in names},
    )


def player_edges(details: DataFrame, same_team: bool) -> DataFrame:
    """Pairs of players in the same games, as team mates (shares_team) or opponents (plays_against).

    The player with the smaller id is the subject.
    """
    pairs = member_pairs(details, "game_id", "player_id", "team_id", "pts")
    return edges(
        pairs.where(F.col("same_group") == same_team),
        ("a", "player"),
        ("b", "player"),
        "shares_team" if same_team else "plays_against",
        {"num_games": "n_events", "subject_points": "a_amount", "object_points": "b_amount"},
        unique=True,  # pairs of one kind
    )


def team_edges(details: DataFrame) -> DataFrame:
    """Players and the teams they played for (plays_on)."""
    found = memberships(details, "game_id", "player_id", "team_id", "pts")
    return edges(
        found, ("member", "player"), ("group", "team"), "plays_on", {"num_games": "n_events", "points": "total"}
    )


def results(details: DataFrame, games: DataFrame) -> DataFrame:
    """Details with the season, date and result of their game."""
    return (
        details.select(*DETAIL_KEY, F.coalesce("pts", F.lit(0)).alias("points"))
        .join(
            games.select("game_id", "game_date_est", "season", "home_team_id", "home_team_wins"),
            "game_id",
        )
        .withColumn("win", win_flag("team_id", "home_team_id", "home_team_wins"))
    )


def dashboard(details: DataFrame, games: DataFrame) -> DataFrame:
    """Points and wins by team and player, season and player, and team."""
    return grouping_sets_totals(
        results(details, games),
        ["season", "team_id", "player_id"],
        [["team_id", "player_id"], ["season", "player_id"], ["team_id"]],
        {"points": "points"},
        {"win_counts": ("game_id", "win")},
    ).orderBy("grp_id", F.col("points").desc_nulls_first(), F.col("win_counts").desc_nulls_first())


def best_scorer_per_team(details: DataFrame, single_game: bool = False) -> DataFrame:
    """The player with the most points for each team, in total or in one game."""
    rows = details.select(
        "team_id", "player_id", F.coalesce("pts", F.lit(0)).alias("points")
    )
    if not single_game:
        rows = rows.groupBy("team_id", "player_id").agg(F.sum("points").alias("points"))
    order = [F.col("points").desc_nulls_last(), F.col("player_id").asc_nulls_last()]
    return top_k_per_group(rows, ["team_id"], order)


def best_season(details: DataFrame, games: DataFrame) -> DataFrame:
    """The player and season with the most points."""
    rows = results(details, games)
    return top_n(rows, ["season", "player_id"], {"points": F.sum("points")}, "points")


def most_wins(games: DataFrame) -> DataFrame:
    """The team with the most wins."""
    sides = unpivot_sides(games, "home_team_id", "visitor_team_id", "home_team_wins", ["game_id"])
    return top_n(sides, ["team_id"], {"total_wins": F.sum(F.col("win").cast("int"))}, "total_wins")


def wins_in_a_stretch(details: DataFrame, games: DataFrame, n: int = 90) -> DataFrame:
    """Per team the most wins within ``n`` games in a row."""
    name = f"most_wins_in_{n}_games"
    rows = results(details, games)
    best = rolling_max_count(rows, "team_id", "game_date_est", "win", n, name)
    return best.orderBy(F.col(name).desc_nulls_first(), "team_id")


def scoring_streaks(
    details: DataFrame, games: DataFrame, points: int = 10, count_break: bool = False
) -> DataFrame:
    """Per player the most games in a row with more than ``points``.

    With ``count_break`` a streak also counts the game that ended the one before it.
    """
    rows = details.select("game_id", "player_id", "player_name", "pts").join(
        games.select("game_id", "game_date_est"), "game_id"
    )
    return longest_streak(
        rows,
        ["player_id", "player_name"],
        ["game_date_est", "game_id"],
        F.coalesce("pts", F.lit(0)) > points,
        segment=F.trunc("game_date_est", "month"),
        count_break=count_break,
    )


def longest_scoring_streak(
    details: DataFrame, games: DataFrame, player_name: str, points: int = 10,
    count_break: bool = False,
) -> DataFrame:
    """The longest streak of one player, as a single row."""
    own = details.where(F.col("player_name") == player_name)
    return scoring_streaks(own, games, points, count_break).agg(F.max("streak").alias("streak"))
