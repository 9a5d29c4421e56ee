"""Follow links from season to season, for one league or for all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.operators.session import durable


def season_chains(leagues: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """The chain of every start over `previous_league_id`, newest first: `start`, `depth`, `league_id`,
    `previous_league_id`, `season`. Starts are the given ids (`league_id`), or else the leagues that no league links to.

    A chain stops at an empty or "0" link, at a link to a league that is not there, and before a league it has visited.
    Chains of any length are followed by pointer doubling: round k knows the successor 2^k links away and doubles the length
    of every chain found so far, so a chain of n leagues takes log2(n) rounds of two joins. On a cycle a league keeps the
    least depth it was met at, and the rounds end when nothing new is met.
    """
    ids = leagues.select("league_id").distinct()
    links = leagues.select("league_id", F.col("previous_league_id").alias("next")).filter("next NOT IN ('', '0')").distinct()
    jump = durable(links.join(ids.select(F.col("league_id").alias("next")), "next", "left_semi").select("league_id", "next"))
    if starts is None:
        starts = ids.join(jump.select(F.col("next").alias("league_id")), "league_id", "left_anti")
    else:
        starts = starts.select("league_id").distinct().join(ids, "league_id", "left_semi")
    met = durable(starts.select(F.col("league_id").alias("start"), "league_id", F.lit(0).cast("bigint").alias("depth")))
    length, known, before = 1, met.count(), -1
    while known > before:
        further = met.join(jump, "league_id").select(
            "start", F.col("next").alias("league_id"), (F.col("depth") + length).alias("depth")
        )
        met = durable(met.unionByName(further).groupBy("start", "league_id").agg(F.min("depth").alias("depth")))
        onward = jump.select(F.col("league_id").alias("next"), F.col("next").alias("beyond"))
        jump = durable(jump.join(onward, "next").select("league_id", F.col("beyond").alias("next")))
        length, before, known = 2 * length, known, met.count()
    about = leagues.select("league_id", F.nullif("previous_league_id", F.lit("")).alias("previous_league_id"), "season")
    return met.join(about, "league_id").select("start", "depth", "league_id", "previous_league_id", "season")


def season_chain(leagues: DataFrame, start_id: str) -> DataFrame:
    """The chain of one league: `depth`, `league_id`, `previous_league_id`, `season`."""
    start = leagues.sparkSession.createDataFrame([(start_id,)], "league_id string")
    return season_chains(leagues, start).select(F.col("depth").cast("int").alias("depth"), "league_id", "previous_league_id", "season")
