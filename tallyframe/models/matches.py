"""Matches, players in them and the medals they won, from CSV files to answers.

``matches``: match_id, mapid, is_team_game, playlist_id, completion_date. ``match_details``:
match_id, player_gamertag, player_total_kills, player_total_deaths.
``medals_matches_players``: match_id, player_gamertag, medal_id, count. ``medals`` and ``maps``:
dimensions by medal_id and mapid.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    bucket_join,
    clean_typed,
    compare_layouts,
    enrich_broadcast,
    top_n,
    unpaired_weights,
)
from ..sources import read_csv, write_bucketed

# Bucket count, time pattern, columns and types of the cleansed tables.
N_BUCKETS = 16
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MATCH_TYPES = {
    "match_id": "string",
    "is_team_game": "boolean",
    "playlist_id": "string",
    "mapid": "string",
    "completion_date": f"timestamp:{TIME_PATTERN}",
}
DETAIL_TYPES = {
    "match_id": "string",
    "player_gamertag": "string",
    "player_total_kills": "int",
    "player_total_deaths": "int",
}
MEDAL_TYPES = {
    "match_id": "string",
    "player_gamertag": "string",
    "medal_id": "int",
    "name": "string",
    "count": "int",
}
SPREE = "Killing Spree"


def typed_matches(matches: DataFrame, maps: DataFrame) -> DataFrame:
    return clean_typed(enrich_broadcast(matches, maps, "mapid"), MATCH_TYPES)


def typed_details(details: DataFrame) -> DataFrame:
    return clean_typed(details, DETAIL_TYPES)


def typed_medals(medals_of_players: DataFrame, medals: DataFrame) -> DataFrame:
    return clean_typed(enrich_broadcast(medals_of_players, medals, "medal_id"), MEDAL_TYPES)


def read_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed details, matches and medals from the CSV files of a folder."""

    def csv(name: str) -> DataFrame:
        return read_csv(spark, os.path.join(folder, f"{name}.csv"))

    return (
        typed_details(csv("match_details")),
        typed_matches(csv("matches"), csv("maps")),
        typed_medals(csv("medals_matches_players"), csv("medals")),
    )


def bucket_tables(
    details: DataFrame,
    matches: DataFrame,
    medals: DataFrame,
    path: str,
    prefix: str = "",
    n_buckets: int = N_BUCKETS,
) -> list[DataFrame]:
    """The tables in buckets: details and medals of match and player, matches of match."""
    return [
        write_bucketed(df, prefix + name, n_buckets, keys, os.path.join(path, name))
        for name, df, keys in (
            ("match_details_bucketed", details, ["match_id", "player_gamertag"]),
            ("matches_bucketed", matches, ["match_id"]),
            ("medal_matches_players_bucketed", medals, ["match_id", "player_gamertag"]),
        )
    ]


def joined(details: DataFrame, matches: DataFrame, medals: DataFrame) -> DataFrame:
    """Details with their match and the medals of the same player."""
    named = medals.withColumnRenamed("name", "medal_name")
    return bucket_join(details, matches, named, "match_id", "player_gamertag")


def most_kills(details: DataFrame) -> DataFrame:
    """The player with the most kills per game."""
    average = {"avg_kills": F.avg("player_total_kills")}
    return top_n(details, ["player_gamertag"], average, "avg_kills")


def most_kills_per_medal_row(details: DataFrame, medals: DataFrame) -> DataFrame:
    """The same, where a game counts once per medal won by anyone in it."""
    kills = F.col("player_total_kills")
    rows = unpaired_weights(details, medals, "match_id").where(kills.isNotNull())
    average = {"avg_kills": F.sum(kills * F.col("weight")) / F.sum("weight")}
    return top_n(rows, ["player_gamertag"], average, "avg_kills")


def most_played(matches: DataFrame, details: DataFrame, column: str) -> DataFrame:
    """The playlist_id or mapid with the most matches that anyone played."""
    with_players = details.select("match_id").distinct()
    rows = matches.join(with_players, "match_id", "left_semi")
    return top_n(rows, [column], {"playing_count": F.count(column)}, "playing_count")


def map_with_most_medals(
    matches: DataFrame, medals: DataFrame, medal_name: str = SPREE
) -> DataFrame:
    """The map on which players won the most medals of a name."""
    per_match = (
        medals.where(F.col("name") == medal_name)
        .groupBy("match_id")
        .agg(F.sum("count").alias("medals"))
    )
    rows = matches.join(per_match, "match_id")
    return top_n(rows, ["mapid"], {"medals": F.sum("medals")}, "medals")


def layouts(rows: DataFrame, path: str) -> DataFrame:
    """Bytes of the joined rows, sorted by playlist or by map first."""
    orders = {
        "playlist_sorted_first": ["playlist_id", "mapid"],
        "mapid_sorted_first": ["mapid", "playlist_id"],
    }
    return compare_layouts(rows, orders, path)
