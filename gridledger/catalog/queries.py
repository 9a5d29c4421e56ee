"""Every registered query: (spark, folder of the driver's tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridledger.functions import parsing, rules
from gridledger.operators import cdc, chain, quality
from gridledger.operators.ranking import medians, with_positions
from gridledger.operators.session import durable, tune, workspace
from gridledger.plans import checks, gold, publish, refresh, scenario, silver
from gridledger.sources import driver_documents
from gridledger.sources.driver_tables import LeagueTables
from gridledger.sources.landing import (
    build_manifest, content_of_documents, content_of_files, digest_check, landing_differences, write_documents,
)
from gridledger.sources.raw import unreadable_documents as unreadable
from gridledger.streaming import cdc as stream_cdc
from gridledger.streaming.pulls import ingest_pulls
from gridledger.streaming.runs import append_checked, append_stream, rule_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCENARIOS = {
    "as_is": {"sack": 1.0, "int": 2.0, "ff": 1.0, "pts_allow": -0.25},
    "bold": {"sack": 2.5, "int": 4.0, "fum_rec": 3.0, "pts_allow": -0.5},
    "none": {},
}


#: Parts that the events arrive in.
WAVES = 4


class League(LeagueTables):
    """The bronze inputs plus the shared datasets over them.

    The small tables every plan reads several times (the range of seasons, the bronze team-weeks, the
    matchup fact) are materialized once per query, as a pipeline run would write them.
    """

    @cached_property
    def _range(self) -> DataFrame:
        return durable(super()._season_range())

    def _season_range(self) -> DataFrame:
        return self._range

    @cached_property
    def _matchups(self) -> DataFrame:
        return durable(super().matchups())

    def matchups(self) -> DataFrame:
        return self._matchups

    def seasons(self) -> DataFrame:
        return silver.dim_season(self.league())

    def weeks(self) -> DataFrame:
        return silver.dim_week(self.matchups(), self.league())

    def managers(self) -> DataFrame:
        return silver.dim_manager(self.users())

    @cached_property
    def _fact(self) -> DataFrame:
        return durable(silver.fact_matchup(self.matchups(), self.rosters(), self.league()))

    def fact(self) -> DataFrame:
        return self._fact

    def players(self) -> DataFrame:
        return silver.dim_player(self.players_raw())

    def picks(self) -> DataFrame:
        return silver.fact_draft_pick(self.draft_picks())

    def stats(self) -> DataFrame:
        return scenario.player_stats(self.player_stats())

    def units(self) -> DataFrame:
        return scenario.unit_stats(self.stats(), self.roster_slots())

    def scenario_rows(self) -> DataFrame:
        return scenario.scenario_input(self.fact(), self.units())

    def standings(self) -> DataFrame:
        return gold.luck_standings(self.fact(), self.managers())

    def events(self) -> DataFrame:
        return self.table("events")

    def gold_settings(self) -> DataFrame:
        """Published settings with one season missing and one empty, so that the fallback is used."""
        published = scenario.scoring_settings(self.league()).filter("season <> '1997'")
        return published.withColumn(
            "scoring_json", F.when(F.col("season") == "1998", "{}").otherwise(F.col("scoring_json"))
        )


def query(build: Callable[[League], DataFrame]) -> Callable[[League], DataFrame]:
    """Register a function over a league under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(League(tune(spark), folder))

    QUERIES[build.__name__] = run
    return build


# -- paths, projections, filters, functions -----------------------------------------------------


@query
def path_extract(t: League) -> DataFrame:
    season, week = F.year("o_orderdate"), F.month("o_orderdate")
    key = F.col("o_orderkey")
    path = (
        F.when(key % 10 == 0, F.format_string("raw/season=%d/league/league.json", season))
        .when(key % 10 == 1, F.format_string("raw/players/week=%d.json", week))
        .otherwise(F.format_string("raw/season=%d/matchups/week=%d.json", season, week))
    )
    return t.table("orders").select(
        "o_orderkey",
        parsing.season_from_path(path).alias("season"),
        parsing.week_from_path(path).alias("week"),
    )


@query
def dim_season(t: League) -> DataFrame:
    return t.seasons()


@query
def nested_projection(t: League) -> DataFrame:
    return t.draft_picks().select("season", "pick_no", "metadata.amount")


@query
def dim_week(t: League) -> DataFrame:
    return t.weeks()


@query
def regular_season_filter(t: League) -> DataFrame:
    return gold.regular(t.fact()).select("season", "week", "roster_id", "points")


@query
def unit_filter(t: League) -> DataFrame:
    return t.roster_slots().filter(rules.is_unit(F.col("player_id"))).select(
        "season", "week", "roster_id", "player_id", "points", "is_starter"
    )


@query
def stat_key_filter(t: League) -> DataFrame:
    listed = scenario.STAT_KEYS
    return t.stats().select("season", "week", "player_id", F.explode("stats").alias("k", "v")).filter(
        F.col("k").isin(listed)
    )


@query
def player_name(t: League) -> DataFrame:
    words = F.split("p_name", " ")
    part = F.col("p_partkey")
    return t.table("part").select(
        "p_partkey",
        parsing.full_name(
            F.when(part % 7 != 0, F.col("p_name")),
            F.when(part % 35 != 0, F.get(words, F.lit(0))),
            F.when(part % 5 != 0, F.get(words, F.lit(1))),
        ).alias("full_name"),
    )


@query
def empty_slot(t: League) -> DataFrame:
    part = F.col("p_partkey")
    player = F.when(part % 10 == 0, "0").when(part % 10 != 1, part.cast("string"))
    return t.table("part").select("p_partkey", rules.is_empty_slot(player).alias("is_empty"))


@query
def map_explode(t: League) -> DataFrame:
    return t.transactions().select("transaction_id", F.explode("adds").alias("player_id", "roster_id"))


@query
def map_lookup(t: League) -> DataFrame:
    return t.stats().select(
        "season", "week", "player_id",
        F.element_at("stats", F.lit("sack")).alias("sack"),
        F.element_at("stats", F.lit("int")).alias("interceptions"),
        F.element_at("stats", F.lit("safe")).alias("safe"),
    )


# -- change data capture ------------------------------------------------------------------------


@query
def scd1_latest(t: League) -> DataFrame:
    changes = t.events().select("user_id", "ts", "event_type", "value")
    return cdc.scd1(changes, ["user_id"], ["ts"])


@query
def scd1_latest_composite(t: League) -> DataFrame:
    changes = t.events().select("user_id", "event_type", "ts", "value")
    return cdc.scd1(changes, ["user_id", "event_type"], ["ts"])


@query
def scd2_history(t: League) -> DataFrame:
    return cdc.scd2(t.events(), ["user_id"], "ts", ["event_type"])


@query
def scd2_current(t: League) -> DataFrame:
    return cdc.current(cdc.scd2(t.events(), ["user_id"], "ts", ["event_type"])).drop(cdc.END)


@query
def dim_manager(t: League) -> DataFrame:
    return t.managers()


# -- star schema --------------------------------------------------------------------------------


@query
def owner_resolution(t: League) -> DataFrame:
    return (
        silver.team_weeks(t.matchups())
        .join(silver.owners(t.rosters()), ["season", "roster_id"], "left")
        .select("season", "week", "roster_id", "user_id")
    )


@query
def fact_matchup(t: League) -> DataFrame:
    return t.fact()


@query
def game_result(t: League) -> DataFrame:
    return t.fact().select("season", "week", "roster_id", "points", "opponent_points", "h2h_result")


@query
def weekly_median(t: League) -> DataFrame:
    return medians(silver.team_weeks(t.matchups()), ["season", "week"], "points", "median_points")


@query
def median_result(t: League) -> DataFrame:
    return t.fact().select("season", "week", "roster_id", "median_points", "median_result")


@query
def json_dict_explode(t: League) -> DataFrame:
    return t.players()


@query
def fact_roster_slot(t: League) -> DataFrame:
    return silver.fact_roster_slot(t.matchup_documents(), t.rosters())


@query
def fact_transaction(t: League) -> DataFrame:
    return silver.fact_transaction(t.transactions(), t.rosters())


@query
def fact_draft_pick(t: League) -> DataFrame:
    return t.picks()


# -- ranks and medians of groups of any size -----------------------------------------------------


def _priced_orders(t: League) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("price"),
    )


@query
def order_price_ranks(t: League) -> DataFrame:
    """Rank, peers and number of rows of every order among those of its month and of its status, dearest last."""
    orders, price = _priced_orders(t), F.col("price")
    for group, name in (("month", "month"), ("o_orderstatus", "status")):
        orders = with_positions(orders, [group], price).select(
            *[c for c in orders.columns], (F.col("_before") + 1).alias(f"{name}_rank"),
            (F.col("_ties") - 1).alias(f"{name}_peers"), F.col("_total").alias(f"{name}_orders"),
        )
    return orders.drop("month", "o_orderstatus", "price")


@query
def order_price_medians(t: League) -> DataFrame:
    """Median price per month, and of all orders of a status."""
    orders = _priced_orders(t)
    monthly = medians(orders, ["month"], "price", "median_price").withColumnRenamed("month", "of")
    return monthly.unionByName(medians(orders, ["o_orderstatus"], "price", "median_price").withColumnRenamed("o_orderstatus", "of"))


# -- metrics ------------------------------------------------------------------------------------


@query
def all_play(t: League) -> DataFrame:
    return gold.all_play(t.fact()).select("season", "week", "roster_id", "ap_wins", "ap_games")


@query
def luck_standings(t: League) -> DataFrame:
    return t.standings()


@query
def manager_consistency(t: League) -> DataFrame:
    return gold.manager_consistency(t.fact(), t.managers())


@query
def bench_points(t: League) -> DataFrame:
    return gold.bench_points(t.roster_slots(), t.weeks(), t.managers())


@query
def points_per_dollar(t: League) -> DataFrame:
    part = F.col("p_partkey")
    amount = F.when(part % 9 != 0, part % 40)
    points = F.when(part % 8 != 0, F.col("p_size") * 0.25)
    return t.table("part").select("p_partkey", rules.points_per_dollar(points, amount).alias("ppd"))


@query
def auction_roi(t: League) -> DataFrame:
    return gold.auction_roi(t.picks(), t.roster_slots(), t.players(), t.managers())


@query
def h2h_matrix(t: League) -> DataFrame:
    return gold.h2h_matrix(t.fact(), t.managers())


@query
def season_finish(t: League) -> DataFrame:
    return gold.season_finish(t.fact(), t.seasons())


@query
def championships(t: League) -> DataFrame:
    return gold.championships(t.winners_bracket(), t.seasons(), t.rosters())


@query
def season_champion(t: League) -> DataFrame:
    return gold.season_champions(t.winners_bracket(), t.rosters())


@query
def dynasty(t: League) -> DataFrame:
    return gold.dynasty(t.fact(), t.seasons(), t.rosters(), t.winners_bracket(), t.managers())


# -- what-if scoring ----------------------------------------------------------------------------


@query
def unit_stats(t: League) -> DataFrame:
    units = t.units()
    return units.select(
        *[c for c in units.columns if c != "def_stats"],
        F.size("def_stats").alias("n_stats"),
        F.element_at("def_stats", F.lit("sack")).alias("sack"),
        F.element_at("def_stats", F.lit("int")).alias("interceptions"),
    )


@query
def scenario_input(t: League) -> DataFrame:
    rows = t.scenario_rows()
    return rows.select(
        *[c for c in rows.columns if c != "def_stats"],
        F.element_at("def_stats", F.lit("pts_allow")).alias("pts_allow"),
    )


@query
def unit_season_totals(t: League) -> DataFrame:
    return scenario.unit_season_totals(t.stats())


@query
def unit_season_stats(t: League) -> DataFrame:
    return scenario.unit_season_stats(t.stats())


@query
def scoring_settings(t: League) -> DataFrame:
    return scenario.scoring_settings(t.league())


@query
def settings_fallback(t: League) -> DataFrame:
    settings = scenario.settings_or_raw(t.gold_settings(), t.league())
    return settings.select("season", "playoff_week_start", F.explode("scoring").alias("stat", "weight"))


@query
def scenario_settings(t: League) -> DataFrame:
    return scenario.scenario_settings(t.league())


@query
def scenario_rescore(t: League) -> DataFrame:
    return scenario.rescore(t.scenario_rows(), SCENARIOS)


@query
def scenario_rescore_many(t: League) -> DataFrame:
    """A scenario per size of part, its weights summed up over the parts of the size."""
    part = F.col("p_partkey")
    names = F.array(*[F.lit(k) for k in ("sack", "int", "ff", "fum_rec", "pts_allow", "off_snp")])
    weights = t.table("part").groupBy(
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("scenario_id"), F.get(names, (part % 6).cast("int")).alias("stat")
    ).agg(F.sum((part % 9 - 4) * 0.25).alias("weight"))
    return scenario.rescore(t.scenario_rows(), weights)


@query
def scenario_standings(t: League) -> DataFrame:
    return scenario.scenario_standings(durable(t.scenario_rows()), SCENARIOS, t.managers())


@query
def unit_value_board(t: League) -> DataFrame:
    return scenario.unit_value_board(durable(scenario.unit_season_stats(t.stats())), SCENARIOS)


# -- quality ------------------------------------------------------------------------------------


@query
def expect_warn(t: League) -> DataFrame:
    matchups = quality.violations(t.fact(), silver.MATCHUP_RULES)
    picks = quality.violations(silver.draft_picks(t.draft_picks()), silver.PICK_WARN_RULES)
    return matchups.unionByName(picks)


@query
def expect_drop(t: League) -> DataFrame:
    kept = quality.keep_valid(silver.draft_picks(t.draft_picks()), silver.PICK_DROP_RULES)
    return kept.select("season", "pick_no", "player_id")


@query
def quarantine(t: League) -> DataFrame:
    return silver.roster_slot_quarantine(t.roster_slots())


@query
def group_size(t: League) -> DataFrame:
    return quality.group_counts(
        t.fact(), ["season", "week", "matchup_id"], "is_regular AND matchup_id IS NOT NULL"
    )


@query
def unique_key(t: League) -> DataFrame:
    return quality.group_counts(t.players(), ["player_id"])


@query
def unique_current(t: League) -> DataFrame:
    return quality.group_counts(cdc.current(t.managers()), ["user_id"])


@query
def one_unit_per_team_week(t: League) -> DataFrame:
    return quality.group_counts(t.units(), ["season", "week", "roster_id"])


@query
def check_team_weeks_have_starters(t: League) -> DataFrame:
    return checks.check_team_weeks_have_starters(t.fact(), t.roster_slots())


@query
def check_group_size(t: League) -> DataFrame:
    return checks.check_group_size(t.fact())


@query
def check_one_unit(t: League) -> DataFrame:
    return checks.check_one_unit(t.units())


@query
def check_luck_zero_sum(t: League) -> DataFrame:
    return checks.check_luck_zero_sum(t.standings())


@query
def check_unique_current(t: League) -> DataFrame:
    return checks.check_unique_current(t.managers())


@query
def check_unique_player(t: League) -> DataFrame:
    return checks.check_unique_player(t.players())


@query
def reconcile_report(t: League) -> DataFrame:
    """All verdicts, and the count of regular team-weeks without any unit."""
    fact, slots = t.fact(), durable(t.roster_slots())
    units = scenario.unit_stats(t.stats(), slots)
    tables = {
        "fact_matchup": fact,
        "fact_roster_slot": slots,
        "silver_def_stats": units,
        "gold_luck_adjusted_standings": gold.luck_standings(fact, t.managers()),
        "dim_manager": t.managers(),
        "dim_player": t.players(),
    }
    verdicts = [check() for check in checks.all_checks(tables).values()]
    return checks.report([*verdicts, checks.check_team_weeks_have_unit(fact, units)])


GATED = ["dim_season", "fact_matchup", "dim_player", "dim_manager", "fact_draft_pick", "dq_matchup_group_size",
         "dq_unique_player", "dq_unique_current_manager", "dq_one_def_per_team_week"]


@query
def publication_gates(t: League) -> DataFrame:
    """The audit of a run that writes these datasets: every rule with its counts, and whether the run was published."""
    out = workspace(t.spark)
    inputs = {
        "bronze_league": t.league(), "bronze_matchups": t.matchups(), "bronze_rosters": t.rosters(),
        "bronze_users": t.users(), "bronze_players_raw": t.players_raw(), "bronze_draft_picks": t.draft_picks(),
        "silver_def_stats": t.units(),
    }
    with suppress(quality.ExpectationError):  # the driver's months have teams without a partner
        refresh.refresh(t.spark, inputs, out, GATED)
    return refresh.audits(t.spark, out).drop("run")


# -- landing, chain, publishing -----------------------------------------------------------------


@query
def season_chain(t: League) -> DataFrame:
    leagues = durable(t.league())
    return chain.season_chain(leagues, leagues.agg(F.max_by("league_id", "season")).first()[0])


@query
def season_chains(t: League) -> DataFrame:
    """A league per nation: every seventh has lost its links between even and odd seasons, one nation's seasons form a ring
    with a younger season before it."""
    teams = t._teams().select("n_nationkey", "season", F.max("season").over(W.partitionBy("n_nationkey")).alias("last"))
    nation, season = F.col("n_nationkey"), F.col("season")
    named = lambda year: F.concat(nation.cast("string"), F.lit("-"), year.cast("string"))
    first = season == F.min("season").over(W.partitionBy("n_nationkey"))
    back = F.when(nation % 7 == 3, season - 2).otherwise(season - 1)
    leagues = teams.select(
        named(season).alias("league_id"), season.cast("string").alias("season"),
        F.when(first & (nation == 11), named(F.col("last") - 1)).when(first, "0").otherwise(named(back)).alias("previous_league_id"),
    )
    return chain.season_chains(durable(leagues))


@query
def landing_digests(t: League) -> DataFrame:
    """Damaged documents against what was to be landed, season by season."""
    return digest_check(*_landed(t))


@query
def landing_files(t: League) -> DataFrame:
    """What is wrong with which file."""
    return landing_differences(*_landed(t))


def _landed(t: League) -> tuple[DataFrame, DataFrame]:
    root = f"{workspace(t.spark)}/raw"
    documents = driver_documents.matchup_documents(t, 1)
    write_documents(driver_documents.damaged(documents), root)
    return content_of_files(t.spark, root), content_of_documents(documents)


@query
def manifest(t: League) -> DataFrame:
    matchups = t.matchups().select("season", "_source_file")
    endpoints = {
        "matchups": matchups,
        "transactions": t.transactions(),
        "draft_picks": t.draft_picks(),
        "player_stats": t.player_stats(),
    }
    return build_manifest(endpoints)


@query
def publish_season_payload(t: League) -> DataFrame:
    return publish.publish_payload(
        durable(t.scenario_rows()),
        scenario.settings_or_raw(t.gold_settings(), t.league()),
        scenario.unit_season_stats(t.stats()),
        gold.season_champions(t.winners_bracket(), t.rosters()),
        t.managers(),
        t.league().agg(F.max("season")).first()[0],
    )


# -- the raw zone: documents landed in three pulls, streamed after each, read as of the last -------


def _pulled(t: League, name: str, *documents: Callable[[League, int], DataFrame]) -> tuple[str, DataFrame]:
    """Land the documents of an endpoint pull by pull and ingest it after each. Returns the root and the bronze table."""
    out = workspace(t.spark)
    root = f"{out}/raw"
    for pull in driver_documents.PULLS:
        for make in documents:
            write_documents(make(t, pull), f"{root}/pull={pull}")
        tables = ingest_pulls(t.spark, root, out, [name])
    return root, tables[f"bronze_{name}"]


@query
def pulled_matchups(t: League) -> DataFrame:
    """Team-weeks of JSON documents: unchanged ones count once, changed ones as they are now, vanished ones not at all."""
    _, rows = _pulled(t, "matchups", driver_documents.matchup_documents, driver_documents.broken_documents)
    return silver.team_weeks(rows)


@query
def pulled_rosters(t: League) -> DataFrame:
    _, rows = _pulled(t, "rosters", driver_documents.roster_documents)
    return rows.select("season", "roster_id", "owner_id")


@query
def pulled_players(t: League) -> DataFrame:
    """The dictionary: a whole file under a constant key."""
    _, rows = _pulled(t, "players_raw", driver_documents.player_documents)
    return silver.dim_player(rows)


@query
def unreadable_documents(t: League) -> DataFrame:
    """Documents that are no JSON, pull by pull, as they are."""
    out = workspace(t.spark)
    for pull in driver_documents.PULLS:
        for make in (driver_documents.matchup_documents, driver_documents.broken_documents):
            write_documents(make(t, pull), f"{out}/pull={pull}")
    lost = unreadable(t.spark, out, "matchups", pulls=True)
    return lost.select(
        "season", parsing.week_from_path(F.col("_source_file")).alias("week"),
        parsing.pull_from_path(F.col("_source_file")).alias("pull"), F.col("_corrupt_record").alias("text"),
    )


# -- streams: run again and again as waves of events arrive out of order, then read back ----------


def _streamed(t: League, run: Callable[[DataFrame, str], object]) -> str:
    """Land the events in waves, each with events older than those before, and run a stream after each. Returns the
    folder it worked in."""
    out = workspace(t.spark)
    for wave in range(WAVES):
        part = t.events().filter(F.pmod("event_id", F.lit(WAVES)) == wave)
        part.write.parquet(f"{out}/landed/wave={wave}")
        arrived = t.spark.readStream.schema(t.events().schema).parquet(f"{out}/landed/wave=*")
        run(arrived, out)
    return out


@query
def stream_append(t: League) -> DataFrame:
    out = _streamed(t, lambda stream, out: append_stream(stream, f"{out}/rows", f"{out}/stream"))
    return t.spark.read.schema(t.events().schema).parquet(f"{out}/rows")


EVENT_RULES = {
    "known_user": "user_id % 50 <> 7", "plausible_value": "value BETWEEN 1 AND 90", "has_key": "get_json_object(props, '$.k') <> '3'",
}


@query
def stream_rules(t: League) -> DataFrame:
    """Rule violations of a stream, added up over its micro-batches."""
    out = _streamed(t, lambda stream, out: append_checked(stream, f"{out}/events", f"{out}/stream", EVENT_RULES))
    seen = rule_counts(t.spark, f"{out}/events").groupBy("rule")
    return seen.agg(F.count_distinct("batch").alias("batches"), F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))


@query
def stream_scd1(t: League) -> DataFrame:
    columns = ["user_id", "ts", "event_type", "value"]
    out = _streamed(
        t, lambda stream, out: stream_cdc.latest_stream(stream.select(*columns), f"{out}/stream", ["user_id"], ["ts"])
    )
    return stream_cdc.read_latest(t.spark, f"{out}/stream", t.events().select(*columns).schema)


@query
def stream_scd2(t: League) -> DataFrame:
    how = (["user_id"], "ts", ["event_type"])
    out = _streamed(t, lambda stream, out: stream_cdc.change_stream(stream, f"{out}/stream", *how))
    return stream_cdc.history(t.spark, f"{out}/stream", t.events().schema, *how)
