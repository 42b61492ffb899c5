"""Actors and their films.

``films``: actorid, actor, year, film, votes, rating, filmid. ``actors``: the cumulative table,
one head row (part 0) per actor and year. ``history``: validity intervals by snapshot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import class_by_thresholds
from ..operators import cumulate_grouped, scd2_build, scd2_merge

KEY, ATTRS, TRACKED = ["actorid"], ["actor"], ["quality_class", "is_active"]

# Average ratings a year has to exceed for each class.
QUALITY_STEPS = [(8, "star"), (7, "good"), (6, "average")]
LOWEST_CLASS = "bad"

ACTORS_SCHEMA = (
    "actorid string, part int, actor string, "
    "films array<struct<film:string,votes:int,rating:float,filmid:string,copies:long>>, "
    "quality_class string, is_active boolean, current_year int"
)


def quality(average: Column) -> Column:
    return class_by_thresholds(average, QUALITY_STEPS, LOWEST_CLASS)


def actors_step(
    actors: DataFrame, films: DataFrame, year: int, n_parts: int = 1
) -> DataFrame:
    """The actors of ``year`` from those of the year before.

    An actor has ``n_parts`` rows, over which the films are spread.
    """
    return cumulate_grouped(
        actors.where(F.col("current_year") == year - 1),
        films.where(F.col("year") == year),
        KEY,
        ATTRS,
        F.struct("film", "votes", "rating", "filmid"),
        metric="rating",
        period=year,
        period_name="current_year",
        history="films",
        classify=("quality_class", quality),
        active="is_active",
        n_parts=n_parts,
    )


def actors_history(actors: DataFrame, year: int, as_written: bool = False) -> DataFrame:
    """All intervals of quality and activity up to ``year``."""
    heads = actors.where("part = 0")
    return scd2_build(heads, KEY, ATTRS, TRACKED, "current_year", year, as_written=as_written)


def actors_history_step(
    history: DataFrame, actors: DataFrame, year: int, as_written: bool = False
) -> DataFrame:
    """The intervals of ``year`` from those of the year before and the actors of ``year``."""
    current = actors.where((F.col("part") == 0) & (F.col("current_year") == year))
    before, now = dt.date(year - 1, 1, 1), dt.date(year, 1, 1)
    return scd2_merge(history, current, KEY, ATTRS, TRACKED, before, now, as_written)
