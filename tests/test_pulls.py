"""Repeated pulls: the tables are what the newest pull alone would leave."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

import raw_tree
from gridledger.plans.refresh import refresh
from gridledger.schemas import ENDPOINTS
from gridledger.sources.landing import write_documents
from gridledger.streaming.ingest import ingest
from gridledger.streaming.pulls import index_path, present, read_pulled, table_path

AUDIT = {"_source_file", "_ingest_ts", "_file_ts"}


def changed_tree(root) -> None:
    """A pull with a changed, a vanished and a new document of append tables, and changes in every keyed one."""
    raw_tree.full_tree(root)
    raw_tree.put(root, "season=2023/matchups/week=1.json", [
        raw_tree.team(r, (r + 1) // 2, 80.0 + r, {f"{r}0": 3.0}, [f"{r}0"]) for r in (1, 2, 3, 4)])
    (root / "season=2022/transactions/week=1.json").unlink()
    raw_tree.put(root, "season=2023/transactions/week=2.json", [
        {"transaction_id": "t9", "type": "trade", "status": "complete", "leg": 2, "settings": None, "adds": {"10": 2}, "drops": None}])
    raw_tree.put(root, "season=2023/league/league.json", raw_tree.league(2023, status="post_season"))
    raw_tree.put(root, "season=2023/rosters/rosters.json", [{"roster_id": i, "owner_id": f"u{i}"} for i in (1, 2, 3, 4)])
    raw_tree.players(root, **{"10": {"full_name": "New Name", "position": "QB", "team": "SF"}})
    raw_tree.put(root, "season=2022/player_stats/week=3.json", {"SF": {"sack": 9.0}})


def content(df):
    """The rows without times, each with its document's name below the pull."""
    named = df.withColumn("_at", F.regexp_extract("_source_file", r"pull=\d+/(.*)$", 1))
    return sorted((repr(r) for r in named.drop(*AUDIT).collect()))


@pytest.fixture(scope="module")
def three(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pulls")
    root, out = folder / "raw", str(folder / "out")
    steps = []
    for pull, make in enumerate((raw_tree.full_tree, raw_tree.full_tree, changed_tree), 1):
        make(root / f"pull={pull}")
        tables = ingest(spark, str(root), out, pulls=True)
        steps.append({name: content(df) for name, df in tables.items()})
    alone = folder / "alone"
    shutil.copytree(root / "pull=3", alone / "pull=3")
    once = {name: content(df) for name, df in ingest(spark, str(alone), f"{out}/alone", pulls=True).items()}
    return root, out, steps, once, tables


def test_an_equal_pull_changes_no_table(three):
    _, _, steps, _, _ = three
    assert len(steps[0]) == 11 and all(steps[0].values())
    assert steps[0] == steps[1]


@pytest.mark.parametrize("name", sorted(ENDPOINTS))
def test_a_changed_pull_leaves_what_it_alone_would(three, name):
    _, _, steps, once, _ = three
    assert steps[2][f"bronze_{name}"] == once[f"bronze_{name}"]


def test_what_did_change(three):
    _, _, steps, _, _ = three
    same = {n for n in steps[0] if steps[0][n] == steps[2][n]}
    assert same == {f"bronze_{n}" for n in ("users", "drafts", "draft_picks", "winners_bracket", "losers_bracket")}


def test_known_content_is_not_written_again(spark, three):
    _, out, _, _, _ = three
    pulls = spark.read.parquet(table_path(out, "matchups")).groupBy("_pull").count().collect()
    assert {r._pull: r["count"] for r in pulls} == {1: 24, 3: 4}
    index = spark.read.parquet(index_path(out, "matchups"))
    assert index.count() == 18
    at = {r.document: r.pull for r in present(spark, out, "matchups").collect()}
    assert at.pop("season=2023/matchups/week=1.json") == 3 and set(at.values()) == {1}


def test_idle_runs_and_a_repeated_batch_change_nothing(spark, three):
    root, out, steps, _, _ = three
    again = ingest(spark, str(root), out, ["matchups", "league"], pulls=True)
    assert content(again["bronze_matchups"]) == steps[2]["bronze_matchups"]
    # A batch that had written its rows when it died writes them again.
    last = spark.read.parquet(f"{table_path(out, 'matchups')}/batch=2")
    again = spark.createDataFrame(last.collect(), last.schema)
    again.write.mode("overwrite").parquet(f"{table_path(out, 'matchups')}/batch=2")
    assert content(read_pulled(spark, str(root), out, "matchups")) == steps[2]["bronze_matchups"]


def test_gates_pass_on_pulled_tables(spark, three, tmp_path):
    root, out, _, _, _ = three
    lake = refresh(spark, {f"bronze_{n}": read_pulled(spark, str(root), out, n) for n in ENDPOINTS}, str(tmp_path))
    assert lake.tables["fact_matchup"].count() == 24
    assert lake.tables["fact_transaction"].filter("season = '2022'").isEmpty()


def test_documents_are_landed_whole(spark, tmp_path):
    rows = [("a/b/week=1.json", '[{"x": "é"}]'), ("c.json", "")]
    documents = spark.createDataFrame(rows, "path string, text string")
    for _ in range(2):
        write_documents(documents, str(tmp_path / "raw"))
    found = {str(p.relative_to(tmp_path / "raw")): p.read_text() for p in (tmp_path / "raw").rglob("*") if p.is_file()}
    assert found == dict(rows)
