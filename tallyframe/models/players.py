"""Players and their seasons.

``seasons``: player_name, height, college, country, draft_year, draft_round, draft_number, gp,
pts, reb, ast, season. ``players``: the cumulative table, one row per player and season.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import class_by_thresholds
from ..operators import cumulate_history, growth_states, history_ratio, unnest_history

KEY = ["player_name"]
ATTRS = ["height", "college", "country", "draft_year", "draft_round", "draft_number"]
STATS = ["season", "gp", "pts", "reb", "ast"]

# Points a season has to exceed for each class.
SCORING_STEPS = [(20, "star"), (15, "good"), (10, "average")]
LOWEST_CLASS = "bad"

PLAYERS_SCHEMA = (
    "player_name string, height string, college string, country string, draft_year string, "
    "draft_round string, draft_number string, "
    "season_stats array<struct<season:int,gp:float,pts:float,reb:float,ast:float>>, "
    "scoring_class string, years_since_last_season int, current_season int"
)


def players_step(players: DataFrame, seasons: DataFrame, season: int) -> DataFrame:
    """The players of ``season`` from those of the season before."""
    return cumulate_history(
        players.where(F.col("current_season") == season - 1),
        seasons.where(F.col("season") == season),
        KEY,
        ATTRS,
        F.struct(*STATS),
        period_prev="current_season",
        period_today="season",
        history="season_stats",
        classify=("scoring_class", class_by_thresholds("pts", SCORING_STEPS, LOWEST_CLASS)),
        recency="years_since_last_season",
    )


def player_points_step(players: DataFrame, seasons: DataFrame, season: int) -> DataFrame:
    """The same with points as the only statistic, which may arrive as text."""
    return cumulate_history(
        players.where(F.col("current_season") == season - 1),
        seasons.where(F.col("season") == season),
        KEY,
        ATTRS,
        F.col("pts").try_cast("double"),
        period_prev="current_season",
        period_today="season",
        history="season_stats",
    ).orderBy("player_name")


def player_improvement(players: DataFrame, season: int) -> DataFrame:
    """Points of the latest season over those of the first, best first."""
    now = players.where(F.col("current_season") == season)
    return history_ratio(now, "season_stats", "pts", KEY, "improvement")


def player_seasons(players: DataFrame, season: int) -> DataFrame:
    """The histories as one row per player and season again."""
    now = players.where(F.col("current_season") == season)
    return unnest_history(now, KEY, "season_stats")


def player_states(seasons: DataFrame, horizon: int | None = None) -> DataFrame:
    """New, continued, retired or returned, per player and season."""
    return (
        growth_states(seasons, "player_name", "season", horizon)
        .withColumnsRenamed(
            {
                "state": "player_state",
                "first_active": "first_active_season",
                "last_active": "last_active_season",
                "period": "season",
            }
        )
        .orderBy("player_name", "season")
    )
