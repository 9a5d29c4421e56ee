"""The published payload, as small JSON documents.

A payload of all seasons in one document would pass through one task. It is published as one
document per season header, team-week, unit and manager instead, keyed and written by season;
joined in key order they carry what the single document would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.operators.cdc import current
from gridledger.plans.scenario import unit_weights
from gridledger.schemas import STAT_KEYS


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _by_key(entries: Column | str) -> Column:
    """The map with its keys in order, so that equal maps give equal documents."""
    return F.map_from_entries(F.array_sort(F.map_entries(entries)))


def season_headers(
    inputs: DataFrame, settings: DataFrame, champions: DataFrame, managers: DataFrame
) -> DataFrame:
    """Per season with team-weeks: playoff start, current unit weights, champion's name or id."""
    names = current(managers).select(F.col("user_id").alias("owner_id"), "display_name")
    return (
        inputs.select("season").distinct()
        .join(settings, "season", "left")
        .join(champions, "season", "left")
        .join(names, "owner_id", "left")
        .select(
            "season",
            "playoff_week_start",
            F.coalesce("display_name", "owner_id").alias("actual_champion"),
            _by_key(unit_weights(F.col("scoring"))).alias("def_settings_current"),
        )
    )


def publish_payload(
    inputs: DataFrame,
    settings: DataFrame,
    unit_totals: DataFrame,
    champions: DataFrame,
    managers: DataFrame,
    proposed_season: str,
) -> DataFrame:
    """(season, section, week, item, doc) rows; season is NULL for league-wide sections."""
    none = F.lit(None)
    headers = season_headers(inputs, settings, champions, managers)

    def rows(df: DataFrame, section: str, season: Column, week: Column, item: Column, doc: Column):
        return df.select(
            season.cast("string").alias("season"), F.lit(section).alias("section"),
            week.cast("int").alias("week"), item.cast("string").alias("item"), doc.alias("doc"),
        )

    shown = F.map_filter("def_stats", lambda k, v: k.isin(STAT_KEYS))
    team_week = _json(
        F.col("week"), F.col("user_id"), F.col("matchup_id"),
        F.col("actual_points").alias("actual"), F.col("non_def_points").alias("non_def"),
        F.col("def_id"),
        F.coalesce(_by_key(shown), F.create_map().cast("map<string,double>")).alias("def_stats"),
        F.coalesce("is_regular", F.lit(False)).alias("reg"),
    )
    header = _json(*[F.col(c) for c in headers.columns if c != "season"])
    scope = inputs.select("season").distinct()
    units = unit_totals.join(scope, "season", "left_semi")
    proposed = settings.filter(F.col("season") == proposed_season)

    parts = [
        rows(headers, "season", F.col("season"), none, none, header),
        rows(inputs, "team_week", F.col("season"), F.col("week"), F.col("roster_id"), team_week),
        rows(units, "defense", F.col("season"), none, F.col("def_id"), F.to_json(_by_key("stats"))),
        rows(current(managers), "manager", none, none, F.col("user_id"), _json(F.col("display_name"))),
        rows(proposed, "def_settings_proposed", none, none, F.col("season"),
             F.to_json(_by_key(unit_weights(F.col("scoring"))))),
    ]
    payload = parts[0]
    for part in parts[1:]:
        payload = payload.unionByName(part)
    return payload


def write_payload(payload: DataFrame, path: str) -> None:
    """Write the documents as JSON lines, one folder per section and season, in key order.

    Rows are spread by range of the whole key, so a large season becomes many files.
    """
    key = ["section", "season", "week", "item"]
    (
        payload.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .write.mode("overwrite").partitionBy("section", "season").json(path)
    )
