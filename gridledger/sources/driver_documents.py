"""The driver's tables as JSON documents of three pulls, to be landed and read as a raw zone.

All documents here belong to a week or a season and hold a row per team at most, whatever the size of the tables.

* Pulls 1 and 2 are equal.
* In pull 3 the teams of every fourth week have ten points more, every fifth season has lost its seventh week, the roster of
  team 3 has another owner from 1997 on, and the dictionary counts customers twice. One document a season is no JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.parsing import week_from_path
from gridledger.sources.driver_tables import LeagueTables

PULLS = (1, 2, 3)
CHANGED = 3


def _document(rows: DataFrame, keys: list[str], path: Column, *fields: str | Column) -> DataFrame:
    """One JSON array per group, in an order of its own rows so that equal rows make equal documents."""
    text = F.to_json(F.sort_array(F.collect_list(F.struct(*fields))))
    return rows.groupBy(*keys).agg(text.alias("text")).select(path.alias("path"), "text")


def matchup_documents(t: LeagueTables, pull: int) -> DataFrame:
    teams = t.matchups().withColumn("week", week_from_path(F.col("_source_file")))
    if pull == CHANGED:
        teams = teams.withColumn("points", F.col("points") + F.when(F.col("week") % 4 == 0, 10.0).otherwise(0.0))
        teams = teams.filter(~((F.col("season").cast("int") % 5 == 0) & (F.col("week") == 7)))
    path = F.format_string("season=%s/matchups/week=%d.json", "season", "week")
    return _document(teams, ["season", "week"], path, "roster_id", "matchup_id", "points")


def broken_documents(t: LeagueTables, pull: int) -> DataFrame:
    """A document a season that ends too early."""
    return t.league().select(
        F.format_string("season=%s/matchups/week=99.json", "season").alias("path"),
        F.concat(F.lit('[{"roster_id": 1, "league": "'), "league_id").alias("text"),
    )


def roster_documents(t: LeagueTables, pull: int) -> DataFrame:
    teams = t.rosters()
    if pull == CHANGED:
        sold = (F.col("roster_id") == 3) & (F.col("season") >= "1997")
        teams = teams.withColumn("owner_id", F.when(sold, "u99").otherwise(F.col("owner_id")))
    path = F.format_string("season=%s/rosters/rosters.json", "season")
    return _document(teams, ["season"], path, "roster_id", "owner_id")


def player_documents(t: LeagueTables, pull: int) -> DataFrame:
    """The dictionary: a nation is a player, its number of customers the position."""
    times = 2 if pull == CHANGED else 1
    entry = F.struct(
        F.col("n_nationkey").cast("string").alias("key"),
        F.struct(F.col("n_name").alias("full_name"), (F.col("customers") * times).cast("string").alias("position")).alias("value"),
    )
    counted = t.table("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    known = t.table("nation").join(counted, F.col("n_nationkey") == F.col("c_nationkey"))
    return known.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("text")).select(
        F.lit("players_nfl/players_nfl.json").alias("path"), "text"
    )


def damaged(documents: DataFrame) -> DataFrame:
    """Documents of seasons and weeks as a faulty transfer lands them, by arithmetic on (year + week)."""
    year = F.regexp_extract("path", r"season=(\d+)/", 1).cast("int")
    week = F.regexp_extract("path", r"week=(\d+)", 1).cast("int")
    kind = (year + week) % 11
    folder, name = F.regexp_extract("path", r"^(.*)/", 1), F.regexp_extract("path", r"([^/]+)$", 1)
    file = lambda path, text: F.struct(path.alias("path"), text.alias("text"))
    path, text = F.col("path"), F.col("text")
    as_landed = (
        F.when(kind == 1, F.array(file(path, F.lit(""))))
        .when(kind == 2, F.array(file(path, F.expr("substr(text, 1, length(text) - 5)"))))
        .when(kind == 3, F.array(file(path, F.concat("text", F.lit(" ")))))
        .when(kind == 4, F.array(file(F.concat(folder, F.lit("/moved-"), name), text)))
        .when(kind == 5, F.array(file(path, text), file(F.concat(F.lit("stray-"), year.cast("string"), F.lit("-"), name), text)))
        .when(kind == 6, F.array().cast("array<struct<path: string, text: string>>"))
        .when(kind == 7, F.array(file(path, text), file(F.concat(folder, F.lit("/new-"), name), F.concat("text", F.lit("new")))))
        .otherwise(F.array(file(path, text)))
    )
    return documents.select(F.inline(as_landed))
