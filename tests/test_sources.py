"""Reading the raw zone: streams, snapshots, blobs, landing."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

import raw_tree
from gridledger.plans import silver
from gridledger.schemas import ENDPOINTS
from gridledger.sources import landing, raw
from gridledger.streaming import ingest


@pytest.fixture
def tree(tmp_path):
    raw_tree.full_tree(tmp_path / "raw")
    return tmp_path


def paths(tree):
    return str(tree / "raw"), str(tree / "out")


def test_stream_append_reads_each_file_once(spark, tree):
    root, out = paths(tree)
    ingest.run_endpoint(spark, root, out, "matchups")
    assert ingest.read_bronze(spark, root, out, "matchups").count() == 2 * 3 * 4
    ingest.run_endpoint(spark, root, out, "matchups")  # idle
    assert ingest.read_bronze(spark, root, out, "matchups").count() == 24
    raw_tree.put(root, "season=2023/matchups/week=4.json", [raw_tree.team(1, 1, 5.0, {"10": 1.0}, ["10"])])
    ingest.run_endpoint(spark, root, out, "matchups")
    rows = ingest.read_bronze(spark, root, out, "matchups")
    assert rows.count() == 25
    assert rows.groupBy("season").count().orderBy("season").collect() == [("2022", 12), ("2023", 13)]
    new = rows.filter(F.col("_source_file").endswith("week=4.json")).first()
    assert (new.players_points, new.starters) == ({"10": 1.0}, ["10"])


def test_audit_columns(spark, tree):
    root, _ = paths(tree)
    row = raw.read_endpoint(spark, root, "users", streaming=False).first()
    assert row.season in ("2022", "2023") and f"season={row.season}/users/" in row._source_file
    assert row._ingest_ts is not None and row._file_ts is not None
    assert raw.read_endpoint(spark, root, "players_raw", streaming=False).first().season is None


def test_types_are_kept_and_can_be_inferred(spark, tree):
    root, _ = paths(tree)
    declared = raw.read_endpoint(spark, root, "matchups", streaming=False)
    inferred = raw.read_endpoint(spark, root, "matchups", streaming=False, infer=True)
    assert dict(declared.dtypes)["players_points"] == "map<string,double>"
    assert dict(inferred.dtypes)["players_points"].startswith("struct<")
    assert dict(inferred.dtypes)["points"] == "double" and dict(inferred.dtypes)["roster_id"] == "bigint"
    assert dict(inferred.dtypes)["season"] == "string"
    with pytest.raises(ValueError):
        raw.read_endpoint(spark, root, "matchups", infer=True)


def test_blob_source(spark, tree):
    root, out = paths(tree)
    ingest.run_endpoint(spark, root, out, "player_stats")
    rows = ingest.read_bronze(spark, root, out, "player_stats")
    assert {(r.season, r.week) for r in rows.collect()} == {(s, w) for s in ("2022", "2023") for w in (1, 2, 3)}
    assert rows.filter(F.col("stats_json").contains('"sack"')).count() == 6


def test_constant_key_keeps_one_dictionary(spark, tree):
    root, out = paths(tree)
    raw_tree.put(root, "players_nfl/older.json", {"1": {"full_name": "Old"}})
    os.utime(f"{root}/players_nfl/older.json", (time.time() - 600, time.time() - 600))
    ingest.run_endpoint(spark, root, out, "players_raw")
    for rows in (ingest.read_bronze(spark, root, out, "players_raw"), ingest.read_in_place(spark, root, "players_raw")):
        assert [r._source_file.rpartition("/")[2] for r in rows.collect()] == ["players_nfl.json"]


def test_overwritten_document_is_taken_again(spark, tree):
    root, _ = paths(tree)
    assert {r.status for r in ingest.read_in_place(spark, root, "league").collect()} == {"complete"}
    raw_tree.put(root, "season=2023/league/league.json", raw_tree.league(2023, status="post_season"))
    raw_tree.put(root, "season=2023/users/users.json", [{"user_id": "u9", "display_name": "Zed"}])
    for _ in range(2):
        got = {r.season: r.status for r in ingest.read_in_place(spark, root, "league").collect()}
        assert got == {"2022": "complete", "2023": "post_season"}
        names = {(r.season, r.user_id) for r in ingest.read_in_place(spark, root, "users").collect()}
        assert names == {("2022", "u1"), ("2022", "u2"), ("2022", "u3"), ("2023", "u9")}


def test_manager_history_is_streamed_from_the_bronze_table(spark, tree):
    root, out = paths(tree)

    def run():
        ingest.run_endpoint(spark, root, out, "users")
        rows = ingest.run_dim_manager(spark, root, out).filter("user_id = 'u2'").collect()
        return sorted(map(tuple, rows), key=repr)

    assert run() == [("u2", "Bo", "2022", "2023"), ("u2", "Bobby", "2023", None)]
    raw_tree.put(root, "season=2021/users/users.json", [{"user_id": "u2", "display_name": "Bobby"}])
    late = [("u2", "Bo", "2022", "2023"), ("u2", "Bobby", "2021", "2022"), ("u2", "Bobby", "2023", None)]
    assert run() == late and run() == late


def test_malformed_document_keeps_its_path(spark, tree):
    root, _ = paths(tree)
    raw_tree.put(root, "season=2022/users/broken.json", '[{"user_id": "u1", ')
    rows = raw.read_endpoint(spark, root, "users", streaming=False)
    bad = rows.filter(F.col("_source_file").endswith("broken.json")).collect()
    assert all(r.display_name is None for r in bad)
    assert rows.filter("display_name IS NOT NULL").count() == 6


def test_odd_values_leave_the_rest_of_their_map(spark, tmp_path):
    root = str(tmp_path / "raw")
    odd = raw_tree.team(1, 1, 5.0, {"20": 1.0}, ["20"])
    odd["players_points"], odd["players"] = {"20": 1.0, "21": "x", "22": 2}, ["20", "21", "22"]
    raw_tree.put(root, "season=2023/matchups/week=1.json", [odd])
    raw_tree.put(root, "season=2023/matchups/week=2.json", [raw_tree.team(1, 1, 5.0, {"20": 1.0}, ["20"])])
    (tmp_path / "raw/season=2023/matchups/week=3.json").write_text('[{"roster_id": 1, ')
    teams = raw.read_endpoint(spark, root, "matchups", streaming=False)
    rosters = spark.createDataFrame([("2023", 1, "u1")], "season string, roster_id bigint, owner_id string")
    slots = {(r.week, r.player_id): (r.points, r.is_starter) for r in silver.fact_roster_slot(teams, rosters).collect()}
    assert slots == {(1, "20"): (1.0, True), (1, "21"): (None, False), (1, "22"): (2.0, False), (2, "20"): (1.0, True)}
    assert teams.count() == 2  # no team from the broken file
    broken = raw.unreadable_documents(spark, root, "matchups").collect()
    assert [(r.season, r._source_file.endswith("week=3.json")) for r in broken] == [("2023", True)]


def test_inferred_types_feed_the_slots(spark, tree):
    root, _ = paths(tree)
    rosters = raw.read_endpoint(spark, root, "rosters", streaming=False)
    given, inferred = (silver.fact_roster_slot(raw.read_endpoint(spark, root, "matchups", streaming=False, infer=i), rosters)
                       for i in (False, True))
    assert sorted(given.collect(), key=repr) == sorted(inferred.collect(), key=repr)


def test_endpoint_table():
    assert len(ENDPOINTS) == 11
    assert {n for n, e in ENDPOINTS.items() if e.mode == "scd1"} == {"league", "rosters", "players_raw"}
    assert ENDPOINTS["matchups"].glob() == "season=*/matchups"
    assert ENDPOINTS["matchups"].glob(pulls=True) == "pull=*/season=*/matchups"
    assert ENDPOINTS["players_raw"].glob() == "players_nfl"
    assert all((e.schema is None) == (e.text_column is not None) for e in ENDPOINTS.values())


def test_raw_root_setting(spark):
    assert raw.raw_root(spark, "/given") == "/given"
    with pytest.raises(ValueError):
        raw.raw_root(spark)
    spark.conf.set(raw.ROOT_SETTING, "/set")
    try:
        assert raw.raw_root(spark) == "/set"
    finally:
        spark.conf.unset(raw.ROOT_SETTING)


def test_manifest_and_landing_check(spark, tree):
    root, _ = paths(tree)
    names = [n for n in ENDPOINTS if n != "players_raw"]
    bronze = {n: raw.read_endpoint(spark, root, n, streaming=False) for n in names}
    built = landing.build_manifest(bronze)
    per_season = {r.season: tuple(r)[1:] for r in built.collect()}
    # league, users, rosters, 3 matchups, 3 stats, transactions, drafts, picks, 2 brackets
    assert per_season == {s: (14, 3, 1, 3, 4, 3) for s in ("2022", "2023")}

    raw_tree.put(root, "_manifest.json", {"seasons": [
        {"season": "2022", "files": 14}, {"season": "2023", "files": 15}, {"season": "2021", "files": 1}]})
    manifest = landing.read_manifest(spark, f"{root}/_manifest.json")
    got = {r.season: (r.expected, r.landed, r.ok) for r in landing.landing_check(spark, root, manifest).collect()}
    assert got == {"2022": (14, 14, True), "2023": (15, 14, False), "2021": (1, None, False),
                   None: (30, 28, False)}
    assert landing.landing_check(spark, root, built).filter("NOT ok").isEmpty()


def test_files_are_checked_by_content(spark, tmp_path):
    text = {f"season=2022/matchups/week={w}.json": f"[{w}]" for w in range(1, 9)} | {"players_nfl/players_nfl.json": "{}"}
    expected = landing.content_of_documents(spark.createDataFrame(list(text.items()), "path string, text string"))
    for path, content in text.items():
        raw_tree.put(tmp_path / "raw", path, content)
    root = str(tmp_path / "raw")
    assert landing.landing_differences(landing.content_of_files(spark, root), expected).isEmpty()
    good = {r.season: (r.files, r.ok) for r in landing.digest_check(landing.content_of_files(spark, root), expected).collect()}
    assert good == {"2022": (8, True), None: (1, True)}

    week = lambda n: tmp_path / f"raw/season=2022/matchups/week={n}.json"
    week(1).write_text("")
    week(2).write_text("[")
    week(3).write_text("[9]")
    week(4).rename(week("4b"))
    raw_tree.put(root, "season=2023/matchups/week=5.json", "[5]")
    week(6).unlink()
    raw_tree.put(root, "odd.json", "[77]")
    found = {r.path.rpartition("/")[2]: r.difference for r in
             landing.landing_differences(landing.content_of_files(spark, root), expected).collect()}
    assert found == {"week=1.json": "missing", "week=2.json": "truncated", "week=3.json": "changed", "week=4b.json": "renamed",
                     "week=5.json": "doubled", "week=6.json": "missing", "odd.json": "unexpected"}
    bad = {r.season: r.ok for r in landing.digest_check(landing.content_of_files(spark, root), expected).collect()}
    assert bad == {"2022": False, "2023": False, None: False}
