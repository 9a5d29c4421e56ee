"""From raw files to published tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import raw_tree
from gridledger.operators.quality import ExpectationError
from gridledger.plans import checks, gold, publish, scenario
from gridledger.plans.refresh import audits, newest_run, published, refresh
from gridledger.plans.registry import BY_NAME, DATASETS, compose
from gridledger.sources import raw
from gridledger.streaming.ingest import ingest


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    raw_tree.full_tree(folder / "raw")
    bronze = ingest(spark, str(folder / "raw"), str(folder / "out"))
    return refresh(spark, bronze, str(folder / "out"))


def by(rows, *keys):
    return {tuple(r[k] for k in keys): r for r in rows.collect()}


def test_registry_is_complete_and_in_order():
    layers = [d.layer for d in DATASETS]
    assert (len(DATASETS), layers.count("bronze"), layers.count("silver"), layers.count("gold")) == (34, 11, 13, 10)
    assert len(BY_NAME) == 34 and all(d.comment for d in DATASETS)
    names = [d.name for d in DATASETS]
    assert names.index("dq_one_def_per_team_week") < names.index("gold_scenario_input")


def test_all_tables_are_published(lake):
    assert set(lake.tables) == set(BY_NAME)
    assert all(lake.tables[n].columns for n in BY_NAME)


def test_facts(lake):
    fact = by(lake.tables["fact_matchup"], "season", "week", "roster_id")
    assert len(fact) == 24
    one = fact["2022", 1, 1]
    assert (one.user_id, one.opponent_points, one.median_points, one.h2h_result, one.median_result) == (
        "u1", 90.0, 90.0, "W", "W")
    assert fact["2022", 2, 1].h2h_result == "T" and fact["2022", 3, 3].opponent_points is None
    assert fact["2022", 1, 4].user_id is None
    slots = lake.tables["fact_roster_slot"]
    assert slots.count() == 2 * (3 * 4 * 3 + 1)
    assert [(r.week, r.player_id) for r in lake.tables["fact_roster_slot_quarantine"].collect()] == [(1, "99")] * 2
    moves = by(lake.tables["fact_transaction"].filter("season = '2022'"), "transaction_id", "action", "player_id")
    assert set(moves) == {("t1", "add", "10"), ("t1", "drop", "11"), ("t1", "drop", "12"), ("t2", "add", "20")}
    assert moves["t1", "add", "10"].faab_bid == 7 and moves["t2", "add", "20"].user_id is None
    assert lake.tables["fact_draft_pick"].count() == 6
    assert lake.metrics["fact_draft_pick"] == {"rows": 8, "valid_auction_amount": 4, "has_player": 2}
    assert lake.metrics["fact_matchup"]["regular_has_opponent"] == 0


def test_dimensions(lake):
    names = by(lake.tables["dim_manager"], "user_id", "display_name")
    assert names["u2", "Bo"]["__END_AT"] == "2023" and names["u2", "Bobby"]["__END_AT"] is None
    assert len(names) == 4
    people = {r.player_id: r.full_name for r in lake.tables["dim_player"].collect()}
    assert (people["10"], people["99"], people["98"], people["SF"]) == ("Player 10", "No Full", None, "San")
    weeks = by(lake.tables["dim_week"], "season", "week")
    assert weeks["2022", 2].is_regular and weeks["2022", 3].is_playoff


def test_metrics(lake):
    roi = by(lake.tables["gold_auction_roi"], "season", "full_name")
    assert set(roi) == {("2022", "Player 10"), ("2023", "Player 10")}
    assert roi["2022", "Player 10"].season_points == 63.0 and roi["2022", "Player 10"].points_per_dollar == 1.91
    dynasty = by(lake.tables["gold_dynasty"], "display_name")
    assert dynasty["Bobby",].championships == 2 and dynasty["Bobby",].seasons == 2
    bench = by(lake.tables["gold_bench_points"], "season", "display_name")
    assert bench["2022", "Ann"].points_left_on_bench == 21.0 + 22.0
    units = by(lake.tables["gold_nfl_defense_stats"], "season", "def_id")
    assert units["2022", "SF"].stats == {"sack": 6.0, "int": 3.0}
    settings = by(lake.tables["gold_scoring_settings"], "season")
    assert json.loads(settings["2022",].scoring_json)["int"] == 2.0
    inputs = by(lake.tables["gold_scenario_input"], "season", "week", "roster_id")
    assert inputs["2022", 1, 4].non_def_points == 75.5 and inputs["2022", 1, 4].def_id == "BUF"


def test_checks_pass(spark, lake):
    report = checks.reconcile(spark, checks.all_checks(lake.tables))
    assert report.count() == 6 and not checks.failed(report), report.collect()


def test_lazy_composition_gives_the_same(lake):
    lazy = compose({n: t for n, t in lake.tables.items() if n.startswith("bronze_")})
    for name in ("fact_draft_pick", "gold_luck_adjusted_standings"):
        assert sorted(map(str, lazy[name].collect())) == sorted(map(str, lake.tables[name].collect()))


def bronze_of(spark, root):
    return {f"bronze_{n}": raw.read_endpoint(spark, str(root), n, streaming=False) for n in raw.ENDPOINTS}


def content(tables):
    return {name: sorted(map(repr, df.collect())) for name, df in tables.items()}


def test_a_broken_gate_and_a_crash_leave_the_version_before(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "raw", str(tmp_path / "out")
    raw_tree.full_tree(root)
    assert published(spark, out) == {}
    first = refresh(spark, bronze_of(spark, root), out)
    before = content(published(spark, out))
    assert set(before) == {d.name for d in DATASETS if d.build}

    week = [raw_tree.team(r, 1, 5.0, {"10": 1.0, "SF": 2.0}, ["10", "SF"]) for r in (1, 2, 3)]
    raw_tree.put(root, "season=2022/matchups/week=1.json", week)
    with pytest.raises(ExpectationError, match="group_is_2"):
        refresh(spark, bronze_of(spark, root), out)
    assert newest_run(spark, out) == first.run and content(published(spark, out)) == before

    raw_tree.season_tree(root, 2022)
    raw_tree.put(root, "season=2023/league/league.json", raw_tree.league(2023, status="changed"))
    with monkeypatch.context() as patch:
        def crash(*_):
            raise RuntimeError("lost")
        patch.setattr("gridledger.plans.gold.h2h_matrix", crash)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, bronze_of(spark, root), out)
    assert newest_run(spark, out) == first.run and content(published(spark, out)) == before

    last = refresh(spark, bronze_of(spark, root), out)
    assert newest_run(spark, out) == last.run
    assert {r.status for r in published(spark, out)["dim_season"].collect()} == {"complete", "changed"}

    gates = audits(spark, out).filter("mode = 'fail'").groupBy("run", "published").agg(
        F.count("*").alias("rules"), F.sum("violations").alias("violations")).orderBy("run").collect()
    assert [tuple(r)[1:] for r in gates] == [(True, 5, 0), (False, 5, 1), (True, 5, 0)]


def test_every_dataset_is_computed_once(spark, lake_inputs, tmp_path):
    """Counting the rules takes no job beside the one that writes."""
    from gridledger.plans.refresh import write

    dataset = BY_NAME["dq_unique_player"]
    built = dataset.build(lake_inputs)
    name = "write-once"
    spark.sparkContext.setJobGroup(name, name)
    try:
        built.write.parquet(str(tmp_path / "plain"))
        plain = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        _, seen = write(spark, dataset, built, str(tmp_path / "audited"))
        both = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert both == 2 * plain and seen["player_unique"] == 0


def test_rules_of_no_rows(spark, tmp_path):
    from gridledger.plans.refresh import write

    dataset = BY_NAME["dq_unique_player"]
    none = spark.createDataFrame([], "player_id string, cnt bigint")
    rows, seen = write(spark, dataset, none, str(tmp_path / "none"))
    assert rows.isEmpty() and seen == {"rows": 0, "player_unique": 0}


@pytest.fixture(scope="module")
def lake_inputs(lake):
    return lake.tables


def test_published_payload(lake, tmp_path):
    t = lake.tables
    settings = scenario.settings_or_raw(t["gold_scoring_settings"], t["bronze_league"])
    champions = gold.season_champions(t["bronze_winners_bracket"], t["bronze_rosters"])
    payload = publish.publish_payload(
        t["gold_scenario_input"], settings, t["gold_nfl_defense_stats"], champions, t["dim_manager"], "2023")
    docs = {(r.section, r.season, r.week, r.item): json.loads(r.doc) for r in payload.collect()}
    header = docs["season", "2022", None, None]
    assert header == {"playoff_week_start": 3, "actual_champion": "Bobby",
                      "def_settings_current": {"sack": 1.0, "int": 2.0}}
    assert docs["team_week", "2022", 3, "4"] == {
        "week": 3, "user_id": None, "matchup_id": None, "actual": 10.0, "non_def": 5.0, "def_id": "BUF",
        "def_stats": {"sack": 3.0, "int": 1.0}, "reg": False}
    assert docs["defense", "2023", None, "SF"] == {"sack": 6.0, "int": 3.0}
    assert docs["manager", None, None, "u2"] == {"display_name": "Bobby"}
    assert docs["def_settings_proposed", None, None, "2023"] == {"sack": 1.0, "int": 2.0}
    assert len(docs) == 2 + 24 + 8 + 3 + 1

    publish.write_payload(payload, str(tmp_path / "payload"))
    written = lake.tables["dim_week"].sparkSession.read.json(str(tmp_path / "payload"))
    assert written.filter(F.col("section") == "team_week").count() == 24


def test_champion_without_name_is_shown_by_id(spark, lake):
    t = lake.tables
    champions = spark.createDataFrame([("2022", "u77")], "season string, owner_id string")
    settings = scenario.settings_or_raw(t["gold_scoring_settings"], t["bronze_league"])
    got = by(publish.season_headers(t["gold_scenario_input"], settings, champions, t["dim_manager"]), "season")
    assert got["2022",].actual_champion == "u77" and got["2023",].actual_champion is None
