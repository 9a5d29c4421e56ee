"""Every dataset by name: layer, comment, key columns, and the function that builds it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from gridledger.operators.cdc import current
from gridledger.operators.quality import group_counts, keep_valid
from gridledger.plans import gold, scenario, silver
from gridledger.schemas import ENDPOINTS

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    comment: str
    keys: tuple[str, ...]
    build: Callable[[Tables], DataFrame] | None = None  # None: filled by ingestion
    rules: dict[str, dict[str, str]] = field(default_factory=dict)  # mode -> rules
    partition_by: tuple[str, ...] = ()


def _bronze() -> list[Dataset]:
    made = []
    for name, endpoint in ENDPOINTS.items():
        how = "latest state per key" if endpoint.mode == "scd1" else "landed as it is"
        made.append(Dataset(f"bronze_{name}", "bronze", f"Raw {name}, {how}", endpoint.keys))
    return made


# In order: inputs come before the datasets built from them, and a gate before what relies on it.
DATASETS: list[Dataset] = [
    *_bronze(),
    Dataset("dim_season", "silver", "One season: settings and playoff structure", ("season",),
            lambda t: silver.dim_season(t["bronze_league"]), {"fail": silver.SEASON_RULES}),
    Dataset("dim_week", "silver", "One week of a season, regular or playoff", ("season", "week"),
            lambda t: silver.dim_week(t["bronze_matchups"], t["bronze_league"])),
    Dataset("dim_manager", "silver", "One display-name period of a manager", ("user_id", "__START_AT"),
            lambda t: silver.dim_manager(t["bronze_users"])),
    Dataset("fact_matchup", "silver", "One team-week with both results",
            ("season", "week", "roster_id"),
            lambda t: silver.fact_matchup(t["bronze_matchups"], t["bronze_rosters"], t["bronze_league"]),
            {"warn": silver.MATCHUP_RULES}, ("season",)),
    Dataset("dim_player", "silver", "One player", ("player_id",),
            lambda t: silver.dim_player(t["bronze_players_raw"])),
    Dataset("fact_roster_slot", "silver", "One rostered player of a team-week",
            ("season", "week", "roster_id", "player_id"),
            lambda t: silver.fact_roster_slot(t["bronze_matchups"], t["bronze_rosters"]),
            {"warn": silver.SLOT_RULES}, ("season",)),
    Dataset("fact_transaction", "silver", "One added or dropped player",
            ("transaction_id", "player_id", "action"),
            lambda t: silver.fact_transaction(t["bronze_transactions"], t["bronze_rosters"]),
            {}, ("season",)),
    Dataset("fact_draft_pick", "silver", "One draft pick with its auction amount",
            ("season", "draft_id", "pick_no"),
            lambda t: silver.draft_picks(t["bronze_draft_picks"]),
            {"warn": silver.PICK_WARN_RULES, "drop": silver.PICK_DROP_RULES}),
    Dataset("fact_roster_slot_quarantine", "silver", "Started players without points",
            ("season", "week", "roster_id", "player_id"),
            lambda t: silver.roster_slot_quarantine(t["fact_roster_slot"])),
    Dataset("dq_matchup_group_size", "silver", "Gate: regular matchups have two teams",
            ("season", "week", "matchup_id"),
            lambda t: group_counts(t["fact_matchup"], ["season", "week", "matchup_id"],
                                   "is_regular AND matchup_id IS NOT NULL"),
            {"fail": {"group_is_2": "cnt = 2"}}),
    Dataset("dq_unique_player", "silver", "Gate: one row per player", ("player_id",),
            lambda t: group_counts(t["dim_player"], ["player_id"]),
            {"fail": {"player_unique": "cnt = 1"}}),
    Dataset("dq_unique_current_manager", "silver", "Gate: one current name per manager", ("user_id",),
            lambda t: group_counts(current(t["dim_manager"]), ["user_id"]),
            {"fail": {"manager_unique": "cnt = 1"}}),
    Dataset("silver_def_stats", "silver", "Started unit of a team-week with raw statistics",
            ("season", "week", "roster_id"),
            lambda t: scenario.unit_stats(
                scenario.player_stats(t["bronze_player_stats"]), t["fact_roster_slot"])),
    Dataset("dq_one_def_per_team_week", "gold", "Gate: one started unit per team-week",
            ("season", "week", "roster_id"),
            lambda t: group_counts(t["silver_def_stats"], ["season", "week", "roster_id"]),
            {"fail": scenario.ONE_UNIT_RULES}),
    Dataset("gold_luck_adjusted_standings", "gold", "Actual against expected wins",
            ("season", "display_name"),
            lambda t: gold.luck_standings(t["fact_matchup"], t["dim_manager"])),
    Dataset("gold_manager_consistency", "gold", "Weekly scoring average and spread",
            ("season", "display_name"),
            lambda t: gold.manager_consistency(t["fact_matchup"], t["dim_manager"])),
    Dataset("gold_bench_points", "gold", "Points left on the bench", ("season", "display_name"),
            lambda t: gold.bench_points(t["fact_roster_slot"], t["dim_week"], t["dim_manager"])),
    Dataset("gold_auction_roi", "gold", "Season points per auction dollar",
            ("season", "display_name", "full_name"),
            lambda t: gold.auction_roi(t["fact_draft_pick"], t["fact_roster_slot"],
                                       t["dim_player"], t["dim_manager"]),
            {"warn": gold.ROI_RULES}),
    Dataset("gold_h2h_matrix", "gold", "Record between managers", ("manager", "opponent"),
            lambda t: gold.h2h_matrix(t["fact_matchup"], t["dim_manager"])),
    Dataset("gold_dynasty", "gold", "All-time leaderboard", ("display_name",),
            lambda t: gold.dynasty(t["fact_matchup"], t["dim_season"], t["bronze_rosters"],
                                   t["bronze_winners_bracket"], t["dim_manager"])),
    Dataset("gold_scenario_input", "gold", "Fixed points and statistics to score again",
            ("season", "week", "roster_id"),
            lambda t: scenario.scenario_input(t["fact_matchup"], t["silver_def_stats"])),
    Dataset("gold_nfl_defense_stats", "gold", "Season statistics of every unit", ("season", "def_id"),
            lambda t: scenario.unit_season_stats(scenario.player_stats(t["bronze_player_stats"]))),
    Dataset("gold_scoring_settings", "gold", "Scoring settings of a season", ("season",),
            lambda t: scenario.scoring_settings(t["bronze_league"])),
]

BY_NAME: dict[str, Dataset] = {d.name: d for d in DATASETS}


def compose(bronze: Tables) -> dict[str, DataFrame]:
    """All datasets as lazy DataFrames over bronze rows. Nothing runs; gates are not enforced.
    Rules of mode `drop` are applied without counting."""
    tables = dict(bronze)
    for dataset in DATASETS:
        if dataset.build is not None:
            df = dataset.build(tables)
            if "drop" in dataset.rules:
                df = keep_valid(df, dataset.rules["drop"])
            tables[dataset.name] = df
    return tables
