from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridledger.functions import parsing, rules
from gridledger.operators.ranking import medians, with_positions
from gridledger.schemas import STAT_KEYS


def evaluate(spark, rule, rows, schema):
    """Value of a rule for each row; columns are passed in order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    inputs = [F.col(c) for c in df.columns[1:]]
    return [r.out for r in df.select("i", rule(*inputs).alias("out")).orderBy("i").collect()]


def test_empty_slot(spark):
    got = evaluate(spark, rules.is_empty_slot, [("0",), (None,), ("1234",), ("SF",)], "p string")
    assert got == [True, True, False, False]
    assert evaluate(spark, rules.is_empty_slot, [(0,), (7,)], "p int") == [True, False]


def test_unit_ids(spark):
    got = evaluate(spark, rules.is_unit, [("SF",), ("1234",), ("Sf",), ("Brand#1",), (None,)], "p string")
    assert got == [True, False, False, False, None]


def test_week_from_path(spark):
    paths = ["/raw/season=2025/matchups/week=8.json", "season=2023/transactions/week=14.json",
             "season=2026/league/league.json", "", None]
    got = evaluate(spark, rules.week_from_path, [(p,) for p in paths], "p string")
    assert got == [8, 14, None, None, None]


def test_season_without_match_is_null(spark):
    got = evaluate(spark, parsing.season_from_path, [("a/season=2024/x",), ("a/season=24/x",), ("",)], "p string")
    assert got == ["2024", None, None]


@pytest.mark.parametrize("rule", [rules.game_result, rules.median_result])
def test_results(spark, rule):
    rows = [(110.0, 90.0), (90.0, 110.0), (100.0, 100.0), (100.0, None)]
    assert evaluate(spark, rule, rows, "a double, b double") == ["W", "L", "T", None]


def test_median_even_odd_one_none(spark):
    groups = {"even": [100.0 + 10 * i for i in range(12)], "odd": [100.0, 200.0, 300.0], "one": [120.5],
              "none": [None]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: r.m for r in medians(df, ["g"], "v", "m").collect()}
    assert got == {"even": 155.0, "odd": 200.0, "one": 120.5}


def test_all_play(spark):
    df = spark.createDataFrame(
        [("a", x) for x in (90.0, 100.0, 110.0, 200.0)] + [("b", x) for x in (100.0, 100.0, 120.0, 80.0)],
        "g string, v double",
    )
    placed = with_positions(df, ["g"], F.col("v")).select(
        "g", "v",
        rules.all_play_wins(F.col("_before"), F.col("_ties")).alias("wins"),
        rules.all_play_games(F.col("_total")).alias("games"),
    )
    got = {(r.g, r.v): (r.wins, r.games) for r in placed.collect()}
    assert got[("a", 200.0)] == (3.0, 3)
    assert got[("a", 90.0)] == (0.0, 3)
    assert got[("b", 100.0)] == (1.5, 3)


def test_expected_wins_and_luck(spark):
    rows = [(92.4, 154, 28), (84.0, 154, 28), (0.0, 0, 28)]
    assert evaluate(spark, rules.expected_wins, rows, "w double, g int, n int") == [16.8, 15.3, 0.0]
    assert evaluate(spark, rules.luck, [(16.0, 14.4), (15.0, 17.8)], "a double, e double") == [1.6, -2.8]


def test_rounding_is_half_up(spark):
    # Binary halves go up here; round-half-even would give 0.2.
    assert evaluate(spark, rules.luck, [(0.25, 0.0), (-0.25, 0.0)], "a double, e double") == [0.3, -0.3]
    assert evaluate(spark, rules.expected_wins, [(1.0, 4, 1)], "w double, g int, n int") == [0.3]


def test_points_per_dollar(spark):
    rows = [(401.3, 33), (0.0, 5), (100.0, 0), (100.0, None), (None, 5), (100.0, -3)]
    got = evaluate(spark, rules.points_per_dollar, rows, "p double, a int")
    assert got == [12.16, 0.0, None, None, 0.0, None]


def test_full_name(spark):
    rows = [("A B", "x", "y"), (None, "A", "B"), (None, "A", None), (None, None, None)]
    got = evaluate(spark, parsing.full_name, rows, "f string, a string, b string")
    assert got == ["A B", "A B", "A", None]


def test_one_bad_value_does_not_void_the_file(spark):
    text = '{"SF": {"sack": 3, "int": "n/a"}, "DAL": {"sack": 1.5}}'
    df = spark.createDataFrame([(text,)], "t string")
    rows = df.select(F.explode(parsing.stats_map(F.col("t"))).alias("p", "s")).select(
        "p", parsing.numbers(F.col("s")).alias("s"))
    assert {r.p: r.s for r in rows.collect()} == {
        "SF": {"sack": 3.0, "int": None}, "DAL": {"sack": 1.5}}


def test_struct_to_map(spark):
    df = spark.sql("SELECT named_struct('10', 1.5D, '11', CAST(NULL AS DOUBLE)) AS s")
    assert df.select(parsing.struct_to_map(F.col("s"), "double").alias("m")).first().m == {"10": 1.5}


def test_stat_keys_are_distinct():
    assert len(STAT_KEYS) == len(set(STAT_KEYS)) == 25
