"""State kept by streams: replay, late data, batches that die, and what a small batch costs."""

from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql.types import StructType

from gridledger.operators import cdc as batch
from gridledger.streaming import cdc

SCHEMA = StructType().add("k", "string").add("s", "integer").add("v", "string")
HOW = (["k"], "s", ["v"])


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(str(folder))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_latest_over_several_runs(spark, tmp_path):
    src, cp = tmp_path / "src", str(tmp_path / "cp")

    def run():
        cdc.latest_stream(stream(spark, src), cp, ["k"], ["s"])
        return {r.k: r.v for r in cdc.read_latest(spark, cp, SCHEMA).collect()}

    assert cdc.read_latest(spark, cp, SCHEMA).isEmpty()
    land(spark, src, [("a", 1, "x"), ("b", 1, "x"), ("a", 3, "z"), (None, 1, "n"), ("d", None, "first")])
    first = {"a": "z", "b": "x", None: "n", "d": "first"}
    assert run() == first
    assert run() == first
    land(spark, src, [("a", 2, "late"), ("c", 1, "new"), ("b", 2, "y"), ("d", 0, "known")])
    assert run() == {"a": "z", "b": "y", "c": "new", None: "n", "d": "known"}


def test_session_settings_are_left_as_they_were(spark, tmp_path):
    before = {name: spark.conf.get(name, None) for name in cdc.STATE}
    land(spark, tmp_path / "src", [("a", 1, "x")])
    cdc.latest_stream(stream(spark, tmp_path / "src"), str(tmp_path / "cp"), ["k"], ["s"])
    assert {name: spark.conf.get(name, None) for name in cdc.STATE} == before


def test_a_small_batch_touches_its_own_keys_only(spark, tmp_path):
    """The tenth batch reads and writes no more of the state than the second, though the state has grown."""
    src, cp = tmp_path / "src", str(tmp_path / "cp")
    land(spark, src, [(f"k{i}", 1, "x") for i in range(2000)])
    cdc.change_stream(stream(spark, src), cp, *HOW)
    cost = []
    for n in range(2, 11):
        land(spark, src, [(f"k{i}", n if n % 2 else -n, "y") for i in range(5)])
        done = cdc.change_stream(stream(spark, src), cp, *HOW)
        state = next(p for p in done.recentProgress if p["numInputRows"])["stateOperators"][0]
        cost.append((state["numRowsUpdated"], state["customMetrics"]["rocksdbGetCount"], state["customMetrics"]["rocksdbPutCount"]))
    assert state["numRowsTotal"] == 2000 + 9 * 5
    assert cost[0][0] == 5 and cost[-1] <= cost[0], cost


def test_history_places_late_rows_by_sequence(spark, tmp_path):
    src, cp = tmp_path / "src", str(tmp_path / "cp")

    def run():
        cdc.change_stream(stream(spark, src), cp, *HOW)
        return rows_of(cdc.history(spark, cp, SCHEMA, *HOW))

    land(spark, src, [("a", 1, "x"), ("a", 5, "z"), ("b", 1, "x")])
    assert run() == [("a", "x", 1, 5), ("a", "z", 5, None), ("b", "x", 1, None)]
    land(spark, src, [("a", 3, "y"), ("a", 7, "z")])
    assert run() == [("a", "x", 1, 3), ("a", "y", 3, 5), ("a", "z", 5, None), ("b", "x", 1, None)]
    land(spark, src, [("a", 0, "x"), ("a", 4, "y")])
    assert run() == [("a", "x", 0, 3), ("a", "y", 3, 5), ("a", "z", 5, None), ("b", "x", 1, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_and_reorder_leave_the_same_state(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abcd"), s, rng.choice("xyz")) for s in range(30)]
    whole = spark.createDataFrame(rows, SCHEMA)
    src = tmp_path / "src"
    arriving = rows + rows[:15]
    rng.shuffle(arriving)
    for part in (arriving[:15], arriving[15:30], arriving[30:]):
        land(spark, src, part)
        cdc.latest_stream(stream(spark, src), str(tmp_path / "c1"), ["k"], ["s"])
        cdc.change_stream(stream(spark, src), str(tmp_path / "c2"), *HOW)
    assert rows_of(cdc.read_latest(spark, str(tmp_path / "c1"), SCHEMA)) == rows_of(batch.scd1(whole, ["k"], ["s"]))
    assert rows_of(cdc.history(spark, str(tmp_path / "c2"), SCHEMA, *HOW)) == rows_of(batch.scd2(whole, *HOW))


def test_a_batch_that_died_before_its_commit_is_run_again(spark, tmp_path):
    src, cp = tmp_path / "src", str(tmp_path / "cp")
    land(spark, src, [("a", 1, "x")])
    cdc.latest_stream(stream(spark, src), cp, ["k"], ["s"])
    land(spark, src, [("a", 2, "y"), ("b", 1, "x")])
    cdc.latest_stream(stream(spark, src), cp, ["k"], ["s"])
    want = [("a", 2, "y"), ("b", 1, "x")]
    assert rows_of(cdc.read_latest(spark, cp, SCHEMA)) == want
    newest = max((p for p in (tmp_path / "cp/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for path in (newest, newest.with_name(f".{newest.name}.crc")):
        path.unlink(missing_ok=True)
    shutil.copytree(tmp_path / "cp", tmp_path / "again")
    assert rows_of(cdc.read_latest(spark, str(tmp_path / "again"), SCHEMA)) == [("a", 1, "x")]
    cdc.latest_stream(stream(spark, src), str(tmp_path / "again"), ["k"], ["s"])
    assert rows_of(cdc.read_latest(spark, str(tmp_path / "again"), SCHEMA)) == want


def test_rules_are_counted_per_micro_batch(spark, tmp_path):
    from gridledger.operators.quality import violations
    from gridledger.streaming.runs import append_checked, rule_counts

    rules = {"known": "v <> 'x'", "early": "s < 3"}
    src, out, cp = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "cp")
    parts = [[("a", 1, "x"), ("b", 5, "y")], [("c", None, None)], [("d", 2, "y"), ("e", 9, "x"), ("f", 1, "x")]]
    for part in parts:
        land(spark, src, part)
        append_checked(stream(spark, src), out, cp, rules)
    append_checked(stream(spark, src), out, cp, rules)  # nothing new
    got = {(r.batch, r.rule): (r.rows, r.violations) for r in rule_counts(spark, out).collect()}
    assert got == {(0, "known"): (2, 1), (0, "early"): (2, 1), (1, "known"): (1, 1), (1, "early"): (1, 1),
                   (2, "known"): (3, 2), (2, "early"): (3, 1)}
    rows = spark.read.schema(SCHEMA).parquet(f"{out}/rows").select(*SCHEMA.names)
    assert rows_of(rows) == sorted(((k, s, v) for part in parts for k, s, v in part), key=repr)
    whole = {r.rule: (r.rows, r.violations) for r in violations(rows, rules).collect()}
    assert whole == {rule: tuple(sum(got[b, rule][i] for b in range(3)) for i in (0, 1)) for rule in rules}
