"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gridledger.catalog.oracles import ORACLES
from gridledger.catalog.queries import QUERIES
from verify_oracles import TABLES, compare, connect

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = {"unit_season_stats"}  # map-valued; its scalar form has SQL


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_contract():
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert set(QUERIES) - set(ORACLES) <= WITHOUT_SQL
    assert len(TABLES) == 14


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["season", "display_name", "points_for", "actual_wins", "expected_wins", "luck", "all_play_pct"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, capsys, name):
    df = QUERIES[name](spark, FOLDER)
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan
    statement = ORACLES.get(name)
    if statement is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, statement) is None


def test_map_form_equals_scalar_form(spark):
    totals = {(r.season, r.def_id, r.k): r.total for r in queries()["unit_season_totals"](spark, FOLDER).collect()}
    maps = queries()["unit_season_stats"](spark, FOLDER).collect()
    assert {(r.season, r.def_id, k): v for r in maps for k, v in r.stats.items()} == totals
