"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["scd1_latest", "scd1_latest_composite"])
def test_latest_state_limits_groups_before_the_shuffle(spark, capsys, name):
    text = plan(queries()[name](spark, FOLDER), capsys)
    tree = text[: text.index("\n\n\n")]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def final_plan(df, capsys) -> str:
    df.collect()
    text = plan(df, capsys)
    return text[text.index("Final Plan") : text.index("Initial Plan")]


def test_history_without_cut_keys_ends_without_joins(spark, capsys):
    """The joins that carry values across cuts are planned, and dropped when no key has a cut."""
    assert "Join" not in final_plan(queries()["scd2_history"](spark, FOLDER), capsys)


def test_ranks_without_cut_groups_keep_the_join_with_the_rows_only(spark, capsys):
    from gridledger.operators.ranking import with_positions

    df = spark.range(1000).selectExpr("id % 7 AS g", "id AS v")
    assert final_plan(with_positions(df, ["g"], df.v), capsys).count("Join") == 1


def test_opponents_take_one_shuffle_and_one_scan(spark, capsys):
    from gridledger.operators.session import durable
    from gridledger.plans.silver import opponents

    teams = durable(spark.createDataFrame(
        [("s", 1, 1, 1, 2.0)], "season string, week int, roster_id bigint, matchup_id bigint, points double"))
    tree = plan(opponents(teams), capsys)
    tree = tree[: tree.index("\n\n\n")]
    assert tree.count("Exchange") == 1 and tree.count("Scan") == 1 and "Join" not in tree


def test_scans_read_needed_columns_only(spark, capsys):
    text = plan(queries()["bench_points"](spark, FOLDER), capsys)
    scanned = re.findall(r"Location: \S+ \[file:\S+/(\w+)\.parquet\](?:.|\n)*?ReadSchema: struct<(.*)>", text)
    columns = {table: {c.split(":")[0] for c in schema.split(",")} for table, schema in scanned}
    assert columns["lineitem"] == {"l_orderkey", "l_partkey", "l_quantity"}
    assert columns["orders"] == {"o_orderkey", "o_custkey", "o_orderdate"}
    assert columns["customer"] == {"c_custkey", "c_nationkey"}


def test_both_slot_grains_share_one_scan_of_the_lines(spark, capsys):
    df = queries()["bench_points"](spark, FOLDER)
    df.collect()
    final = plan(df, capsys)
    final = final[final.index("Final Plan"):final.index("Initial Plan")]
    assert "ReusedExchange" in final


def test_filters_reach_the_scan(spark, capsys):
    text = plan(queries()["fact_transaction"](spark, FOLDER), capsys)
    assert "PushedFilters: [In(l_returnflag, [A,R])" in text or "In(l_returnflag, [A,R])" in text


def test_rescoring_shuffles_nothing(spark, capsys):
    from gridledger.operators.session import durable
    from gridledger.plans.scenario import rescore

    inputs = durable(spark.createDataFrame(
        [("s", 1, 1, "u", 1, 1.0, 1.0, "SF", {"sack": 1.0}, True)],
        """season string, week int, roster_id bigint, user_id string, matchup_id bigint, actual_points double,
           non_def_points double, def_id string, def_stats map<string, double>, is_regular boolean"""))
    text = plan(rescore(inputs, {"a": {"sack": 1.0}, "b": {}}), capsys)
    assert "Exchange" not in text and "Join" not in text
