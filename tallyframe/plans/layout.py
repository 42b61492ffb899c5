"""Cleansing, broadcast and bucketed joins, layouts. Tables: orders, lineitem and dimensions.

Orders are matches, their customer's nation is the map and their priority the playlist. A
supplier in an order is a player; its lines are the medals, named by region.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    bucket_join,
    check_layouts,
    clean_counted,
    clean_typed,
    compare_layouts,
    enrich_broadcast,
    top_n,
    unpaired_weights,
)
from ..session import new_path
from ..sources import materialise, read_csv, text_schema, write_bucketed
from .registry import instant, query, table

N_BUCKETS = 16
#: Tasks over which the details of one match are spread when they meet its weight.
N_SALTS = 4
MEDAL = "ASIA"


@query(
    "broadcast_enrich",
    """SELECT c_custkey, n_name, r_name FROM customer
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def broadcast_enrich(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = enrich_broadcast(customers, nations, "c_nationkey")
    return enrich_broadcast(placed, regions, "n_regionkey").select("c_custkey", "n_name", "r_name")


@query(
    "csv_clean",
    """SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_team_game,
       o_orderpriority AS playlist_id, o_custkey AS player,
       CASE WHEN o_orderstatus <> 'P'
            THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000000' END AS completion_date
       FROM orders""",
)
def csv_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as text, read back and typed; some of the text fits no type."""
    return clean_typed(csv_games(spark, folder), GAME_TYPES).withColumn("completion_date", instant("completion_date"))


@query(
    "csv_rejects",
    """SELECT 'completion_date' AS name, count(*) FILTER (o_orderstatus = 'P') AS n_bad, count(*) AS n_rows FROM orders
UNION ALL SELECT 'is_team_game', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), count(*) FROM orders
UNION ALL SELECT 'player', 0, count(*) FROM orders""",
)
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """How many of these texts fit no type, counted while the typed rows are written."""
    typed, counts = clean_counted(csv_games(spark, folder), GAME_TYPES)
    typed.write.parquet(new_path(spark, "matches-typed"))
    found = counts.get
    rows = [(name, found[f"bad_{name}"], found["rows"]) for name in ("completion_date", "is_team_game", "player")]
    return spark.createDataFrame(rows, "name string, n_bad long, n_rows long")


GAME_TYPES = {
    "match_id": "string",
    "is_team_game": "boolean",
    "playlist_id": "string",
    "player": "long",
    "completion_date": "timestamp:yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def csv_games(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a text file of games, read back."""
    path = new_path(spark, "matches-csv")
    status = F.col("o_orderstatus")
    when = F.when(status == "P", "never").otherwise(instant("o_orderdate"))
    table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        F.when(status == "F", "TRUE").when(status == "O", "0").otherwise("?").alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        F.col("o_custkey").alias("player"),
        when.alias("completion_date"),
    ).write.option("header", True).csv(path)
    return read_csv(spark, path, text_schema(*GAME_TYPES))


def matches(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("mapid")
    )
    maps = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("map_name")
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("match_id"), "o_custkey",
        F.col("o_orderpriority").alias("playlist_id"), "o_orderdate",
    )
    return enrich_broadcast(orders.join(customers, "o_custkey"), maps, "mapid").select(
        "match_id", "mapid", "map_name", "playlist_id", "o_orderdate"
    )


def match_details(spark: SparkSession, folder: str) -> DataFrame:
    """One row per match and player."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player"))
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("kills"))
    )


def match_medals(spark: SparkSession, folder: str) -> DataFrame:
    """One row per match, player and medal, with its name and count."""
    names = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("medal_id"), F.col("r_name").alias("medal_name")
    )
    rows = (
        table(spark, folder, "lineitem")
        .groupBy(
            F.col("l_orderkey").alias("match_id"),
            F.col("l_suppkey").alias("player"),
            F.pmod(F.col("l_linenumber") - 1, F.lit(5)).alias("medal_id"),
        )
        .agg(F.count(F.lit(1)).alias("n_medals"))
    )
    return enrich_broadcast(rows, names, "medal_id")


_GAME_SQL = """
WITH matches AS (SELECT o_orderkey AS match_id, c_nationkey AS mapid, o_orderpriority AS playlist_id
                 FROM orders JOIN customer ON o_custkey = c_custkey
                 JOIN nation ON c_nationkey = n_nationkey),
details AS (SELECT l_orderkey AS match_id, l_suppkey AS player,
                   CAST(sum(l_quantity) AS BIGINT) AS kills FROM lineitem GROUP BY 1, 2),
medals AS (SELECT l_orderkey AS match_id, l_suppkey AS player, r_name AS medal_name,
                  count(*) AS n_medals
           FROM lineitem JOIN region ON (l_linenumber - 1) % 5 = r_regionkey GROUP BY 1, 2, 3),
paired AS (SELECT d.match_id, d.player, kills, mapid, playlist_id, medal_name
           FROM details d JOIN matches USING (match_id)
           JOIN medals m ON m.match_id = d.match_id)
"""


@query(
    "bucket_join",
    _GAME_SQL
    + """SELECT d.match_id, d.player, kills, CAST(mapid AS BIGINT) AS mapid, playlist_id,
       medal_name, n_medals
FROM details d JOIN matches t ON t.match_id = d.match_id
JOIN medals m ON m.match_id = d.match_id AND m.player = d.player""",
)
def bucketed_games(spark: SparkSession, folder: str) -> DataFrame:
    """Details and medals bucketed by match and player, matches by match; joined, then dropped."""
    run = uuid.uuid4().hex[:12]
    path = new_path(spark, "games")
    tables = []
    for name, build, keys in (
        ("match_details", match_details, ["match_id", "player"]),
        ("matches", matches, ["match_id"]),
        ("match_medals", match_medals, ["match_id", "player"]),
    ):
        stored = f"{name}_{run}"
        tables.append(write_bucketed(build(spark, folder), stored, N_BUCKETS, keys, os.path.join(path, name)))
    result = materialise(bucket_join(*tables, "match_id", "player"), "bucket-join")
    for name in ("match_details", "matches", "match_medals"):
        spark.sql(f"DROP TABLE {name}_{run}")
    return result.select(
        "match_id", "player", "kills", F.col("mapid").cast("long").alias("mapid"),
        "playlist_id", "medal_name", "n_medals",
    )


@query(
    "most_kills",
    _GAME_SQL
    + """SELECT player, CAST(sum(kills) AS BIGINT) / count(*) AS avg_kills FROM details
GROUP BY 1 ORDER BY avg_kills DESC, player LIMIT 1""",
)
def most_kills(spark: SparkSession, folder: str) -> DataFrame:
    details = match_details(spark, folder)
    return top_n(
        details, ["player"], {"avg_kills": F.sum("kills") / F.count(F.lit(1))}, "avg_kills"
    )


@query(
    "most_kills_as_written",
    _GAME_SQL
    + """SELECT player, CAST(sum(kills) AS BIGINT) / count(*) AS avg_kills FROM paired
GROUP BY 1 ORDER BY avg_kills DESC, player LIMIT 1""",
)
def most_kills_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Every detail repeats per medal row of its match: weights instead of the pairs."""
    rows = unpaired_weights(
        match_details(spark, folder), match_medals(spark, folder), "match_id", F.col("player"), N_SALTS
    ).withColumn("weighted", F.col("kills") * F.col("weight"))
    return top_n(
        rows, ["player"], {"avg_kills": F.sum("weighted") / F.sum("weight")}, "avg_kills"
    )


def played(spark: SparkSession, folder: str) -> DataFrame:
    """Matches in which anyone played."""
    with_players = (
        table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("match_id")).distinct()
    )
    return matches(spark, folder).join(with_players, "match_id", "left_semi")


_PLAYED_SQL = """SELECT {shown}, count(DISTINCT match_id) AS playing_count
FROM matches JOIN details USING (match_id)
GROUP BY {key} ORDER BY playing_count DESC, {key} LIMIT 1"""


@query(
    "most_played_playlist",
    _GAME_SQL + _PLAYED_SQL.format(shown="playlist_id", key="playlist_id"),
)
def most_played_playlist(spark: SparkSession, folder: str) -> DataFrame:
    rows = played(spark, folder)
    return top_n(rows, ["playlist_id"], {"playing_count": F.count("playlist_id")}, "playing_count")


@query(
    "most_played_map",
    _GAME_SQL + _PLAYED_SQL.format(shown="CAST(mapid AS BIGINT) AS mapid", key="matches.mapid"),
)
def most_played_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = played(spark, folder)
    best = top_n(rows, ["mapid"], {"playing_count": F.count("mapid")}, "playing_count")
    return best.withColumn("mapid", F.col("mapid").cast("long"))


def pairs_per_match(spark: SparkSession, folder: str, medal: str | None = None) -> DataFrame:
    """Matches with ``pairs``, the rows that pairing all details and medals would give."""
    details = (
        match_details(spark, folder).groupBy("match_id").agg(F.count(F.lit(1)).alias("n_details"))
    )
    medals = match_medals(spark, folder)
    if medal:
        medals = medals.where(F.col("medal_name") == medal)
    counted = medals.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        matches(spark, folder)
        .join(details, "match_id")
        .join(counted, "match_id")
        .withColumn("pairs", F.col("n_details") * F.col("n_rows"))
    )


_PAIRED_SQL = """SELECT {shown}, count(*) AS playing_count FROM paired {where}
GROUP BY {key} ORDER BY playing_count DESC, {key} LIMIT 1"""


@query(
    "most_played_playlist_as_written",
    _GAME_SQL + _PAIRED_SQL.format(shown="playlist_id", key="playlist_id", where=""),
)
def most_played_playlist_as_written(spark: SparkSession, folder: str) -> DataFrame:
    rows = pairs_per_match(spark, folder)
    return top_n(rows, ["playlist_id"], {"playing_count": F.sum("pairs")}, "playing_count")


@query(
    "most_played_map_as_written",
    _GAME_SQL
    + _PAIRED_SQL.format(shown="CAST(mapid AS BIGINT) AS mapid", key="paired.mapid", where=""),
)
def most_played_map_as_written(spark: SparkSession, folder: str) -> DataFrame:
    rows = pairs_per_match(spark, folder)
    best = top_n(rows, ["mapid"], {"playing_count": F.sum("pairs")}, "playing_count")
    return best.withColumn("mapid", F.col("mapid").cast("long"))


@query(
    "map_with_most_medals",
    _GAME_SQL
    + f"""SELECT CAST(mapid AS BIGINT) AS mapid, CAST(sum(n_medals) AS BIGINT) AS medals
FROM medals JOIN matches t USING (match_id) WHERE medal_name = '{MEDAL}'
GROUP BY t.mapid ORDER BY medals DESC, t.mapid LIMIT 1""",
)
def map_with_most_medals(spark: SparkSession, folder: str) -> DataFrame:
    """Medals are summed per match before they meet the maps."""
    medals = (
        match_medals(spark, folder)
        .where(F.col("medal_name") == MEDAL)
        .groupBy("match_id")
        .agg(F.sum("n_medals").alias("n_medals"))
    )
    rows = matches(spark, folder).join(medals, "match_id")
    best = top_n(rows, ["mapid"], {"medals": F.sum("n_medals")}, "medals")
    return best.withColumn("mapid", F.col("mapid").cast("long"))


@query(
    "map_with_most_medals_as_written",
    _GAME_SQL
    + _PAIRED_SQL.format(
        shown="CAST(mapid AS BIGINT) AS mapid", key="paired.mapid",
        where=f"WHERE medal_name = '{MEDAL}'",
    ),
)
def map_with_most_medals_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the pairing, whatever the number of medals in each."""
    rows = pairs_per_match(spark, folder, MEDAL)
    best = top_n(rows, ["mapid"], {"playing_count": F.sum("pairs")}, "playing_count")
    return best.withColumn("mapid", F.col("mapid").cast("long"))


LAYOUTS = {
    "playlist_sorted_first": ["playlist_id", "mapid"],
    "mapid_sorted_first": ["mapid", "playlist_id"],
}


def games(spark: SparkSession, folder: str) -> DataFrame:
    return matches(spark, folder).join(match_details(spark, folder), "match_id")


@query(
    "layout_compare",
    _GAME_SQL
    + """SELECT layout, count(*) AS n_rows, CAST(sum(match_id) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS n_unsorted
FROM details JOIN matches USING (match_id), (VALUES ('playlist_sorted_first'), ('mapid_sorted_first')) t(layout)
GROUP BY layout""",
)
def layout_compare(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows sorted by playlist or by map first, as they are read back."""
    return check_layouts(games(spark, folder), LAYOUTS, new_path(spark, "layouts"), "match_id")


@query("layout_bytes")
def layout_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of these layouts."""
    return compare_layouts(games(spark, folder), LAYOUTS, new_path(spark, "layouts"))
