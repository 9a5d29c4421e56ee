from __future__ import annotations

import math
import statistics
import struct
import uuid
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridledger.functions.bits import with_ordered_bits
from gridledger.operators import cdc, quality
from gridledger.operators.chain import season_chain, season_chains
from gridledger.operators.joins import join_same
from gridledger.operators.ranking import medians, with_positions
from gridledger.operators.slices import cuts_of, with_slices

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
scores = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-3, 12).map(float))),
    min_size=1, max_size=60,
)


def group(rows):
    found = defaultdict(list)
    for key, value in rows:
        found[key].append(value)
    return found


@few
@given(rows=scores, rate=st.sampled_from([1, 7, 10**6]))
def test_positions_equal_brute_force(spark, rows, rate):
    """Whatever share of the values cuts its group, positions are what counting every pair gives."""
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted(map(repr, ((r.g, r.v, r._before, r._ties, r._total)
                            for r in with_positions(df, ["g"], F.col("v"), rate).collect())))

    def low(value):
        return float("-inf") if value is None else value

    want = []
    for key, values in group(rows).items():
        for v in values:
            want.append((key, v, sum(low(x) < low(v) for x in values), values.count(v), len(values)))
    assert got == sorted(map(repr, want))


@few
@given(rows=st.one_of(scores, st.lists(
    st.tuples(st.sampled_from(["a", None]), st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300)),
    min_size=1, max_size=40,
)))
def test_medians_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in medians(df, ["g"], "v", "m").collect()}
    known = {k: [v for v in vs if v is not None] for k, vs in group(rows).items()}
    assert got == {k: statistics.median(vs) for k, vs in known.items() if vs}


def test_median_of_one_large_group(spark):
    """Values that differ in their last bits only, a third of the rows alike, and numbers of all sizes."""
    rows = spark.range(30_001).select(
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 3 == 1, 5.0 + (F.col("id") * 7919 % 1000) * 2.0**-50)
        .otherwise((F.col("id") * 104729 % 30011 - 15000) * 1e-3).alias("v"))
    want = statistics.median(r.v for r in rows.collect())
    assert medians(rows, [], "v", "m").first().m == want
    odd = spark.createDataFrame([(v,) for v in (math.nan, math.inf, -math.inf, 1.0, 2.0)], "v double")
    assert medians(odd, [], "v", "m").first().m == 2.0


@few
@given(values=st.lists(st.floats(allow_nan=False), min_size=1, max_size=60))
def test_ordered_bits_are_those_of_the_double(spark, values):
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.2250738585072009e-308, 1.7976931348623157e308, math.inf, -math.inf]
    values += [1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 2.0**52, 2.0**53 + 2, 0.1, 1e300, 8.0, math.nextafter(8.0, 0)]
    df = with_ordered_bits(spark.createDataFrame([(v,) for v in values], "v double"), "v", "b")
    for v, b in df.collect():
        size = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert b == (size if v >= 0 else -size), v
    beyond = with_ordered_bits(spark.createDataFrame([(math.nan,), (None,)], "v double"), "v", "b").collect()
    assert beyond[0].b > 2047 << 52 and beyond[1].b is None


def test_slices_keep_order_and_grow_with_the_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") * 7919 % 3000).alias("v"),
    )
    sliced = with_slices(df, ["g"], "v", cuts_of(df, ["g"], "v", 40))
    bounds = sliced.filter("g = 'hot'").groupBy("_slice").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).orderBy("_slice").collect()
    assert 35 < len(bounds) < 95 and max(b.n for b in bounds) < 40 * 12
    assert all(a.hi < b.lo for a, b in zip(bounds, bounds[1:]))
    assert sliced.filter("g <> 'hot' AND _slice NOT IN (-1, 1)").isEmpty()  # a group of one value is cut below it or not at all


def jobs_of(spark, build):
    """How many jobs run while `build` makes its DataFrame."""
    name = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plans_are_lazy(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    assert jobs_of(spark, lambda: df.count()) > 0
    assert jobs_of(spark, lambda: with_positions(df, ["g"], F.col("v"))) == 0
    assert jobs_of(spark, lambda: medians(df, ["g"], "v", "m")) == 0
    assert jobs_of(spark, lambda: cdc.scd2(df, ["g"], "v", ["v"])) == 0


def test_join_same_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    right = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    got = {(r.k, r.a, r.b) for r in join_same(left, right, ["k"]).collect()}
    assert got == {(None, 1, 10), ("x", 2, 20), ("y", 3, None)}


# -- change data capture ------------------------------------------------------------------------

changes = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(1, 9), st.sampled_from(["x", "y", None])),
    min_size=1, max_size=40, unique_by=lambda c: (c[0], c[1]),
)


@few
@given(rows=changes, rate=st.sampled_from([1, 3, 10**6]), seed=st.randoms(use_true_random=False))
def test_scd2_equals_brute_force_in_any_order(spark, rows, rate, seed):
    shuffled = rows + rows[: len(rows) // 2]  # a part of the pull arrives twice
    seed.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k string, s int, v string")
    got = cdc.scd2(df, ["k"], "s", ["v"], rate=rate).collect()
    assert sorted(map(tuple, got), key=repr) == periods(rows)


def periods(rows):
    want = []
    for key in {r[0] for r in rows}:
        steps = sorted(((s, v) for k, s, v in rows if k == key), key=lambda x: x[0])
        kept = [step for i, step in enumerate(steps) if i == 0 or steps[i - 1][1] != step[1]]
        for i, (start, value) in enumerate(kept):
            want.append((key, value, start, kept[i + 1][0] if i + 1 < len(kept) else None))
    return sorted(want, key=repr)


def test_scd2_hot_key_in_many_slices(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("s"),
        (F.floor(F.col("id") / 13) % 3).alias("v"),
    )
    sliced = cdc.scd2(rows, ["k"], "s", ["v"], rate=50)
    plain = cdc.scd2(rows, ["k"], "s", ["v"])
    assert sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()
    assert cdc.current(sliced).filter("k = 0").count() == 1


def test_scd2_tie_breaks(spark):
    df = spark.createDataFrame([("a", 1, "old", 1), ("a", 1, "new", 2)], "k string, s int, v string, t int")
    assert [tuple(r) for r in cdc.scd2(df, ["k"], "s", ["v"], ["t"]).collect()] == [("a", "new", 1, None)]


def test_scd1_latest_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 5, 0, "w")], "k string, s int, t int, v string")
    got = {r.k: r.v for r in cdc.scd1(df, ["k"], ["s", "t"]).collect()}
    assert got == {"a": "z", "b": "w"}


# -- quality ------------------------------------------------------------------------------------


@pytest.fixture
def numbered(spark):
    return spark.createDataFrame([(1,), (5,), (None,), (-2,)], "x int")


def test_warn_keeps_rows_and_counts_null_as_violation(numbered):
    kept, seen = quality.expect(numbered, {"positive": "x > 0", "small": "x < 3"})
    assert kept.count() == 4
    assert seen.get == {"rows": 4, "positive": 2, "small": 2}


def test_drop_removes_rows_and_counts(numbered):
    kept, seen = quality.expect(numbered, {"positive": "x > 0"}, "drop")
    assert sorted(r.x for r in kept.collect()) == [1, 5]
    assert seen.get == {"rows": 4, "positive": 2}


def test_fail_raises_before_anything_is_returned(numbered):
    with pytest.raises(quality.ExpectationError, match="positive"):
        quality.expect(numbered, {"positive": "x > 0"}, "fail")
    same, seen = quality.expect(numbered, {"any": "true"}, "fail")
    assert same is numbered and seen is None


def test_violations(numbered):
    got = {r.rule: (r.rows, r.violations) for r in
           quality.violations(numbered, {"positive": "x > 0", "known": "x IS NOT NULL"}).collect()}
    assert got == {"positive": (4, 2), "known": (4, 1)}


@few
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=20))
def test_quarantine_is_disjoint_and_complete(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    good, bad = quality.quarantine(df, "v > 0")
    a, b = {r.i for r in good.collect()}, {r.i for r in bad.collect()}
    assert not a & b and a | b == set(range(len(values)))
    assert b == {i for i, v in enumerate(values) if v is not None and v > 0}


# -- season chain -------------------------------------------------------------------------------


def chain_ids(spark, links, start):
    df = spark.createDataFrame([(a, b, "s") for a, b in links], "league_id string, previous_league_id string, season string")
    return [r.league_id for r in season_chain(df, start).orderBy("depth").collect()]


def test_season_chain_guards(spark):
    assert chain_ids(spark, [("c", "b"), ("b", "a"), ("a", "0"), ("0", None)], "c") == ["c", "b", "a"]
    assert chain_ids(spark, [("c", "b"), ("b", "c")], "c") == ["c", "b"]  # cycle
    assert chain_ids(spark, [("c", "b"), ("b", "gone")], "c") == ["c", "b"]  # missing link
    assert chain_ids(spark, [("c", ""), ("b", None)], "c") == ["c"]
    assert chain_ids(spark, [("c", "")], "nobody") == []


def test_season_chains_of_any_length_and_rings(spark):
    """A chain of 5,000, a ring with a tail that leads into it, and two leagues that share their past."""
    long = [(f"c{i}", f"c{i - 1}") for i in range(1, 5000)] + [("c0", "0")]
    ring = [("r0", "r2"), ("r1", "r0"), ("r2", "r1"), ("tail", "r1")]
    shared = [("x", "old"), ("y", "old"), ("old", "")]
    df = spark.createDataFrame([(a, b, "s") for a, b in long + ring + shared], "league_id string, previous_league_id string, season string")
    found = defaultdict(dict)
    for r in season_chains(df).collect():
        found[r.start][r.depth] = r.league_id
    assert set(found) == {"c4999", "tail", "x", "y"}
    assert found["c4999"] == {i: f"c{4999 - i}" for i in range(5000)}
    assert found["tail"] == {0: "tail", 1: "r1", 2: "r0", 3: "r2"}
    assert found["x"] == {0: "x", 1: "old"} and found["y"] == {0: "y", 1: "old"}


def test_positions_by_several_columns_in_slices(spark):
    """The order of a season's finish, with missing values, on both paths."""
    rows = spark.range(400).select(
        F.when(F.col("id") % 7 < 5, "hot").otherwise("cold").alias("g"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 4).alias("wins"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 37 % 50).cast("double")).alias("points"),
        F.when(F.col("id") != 77, F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user_id"),
    )
    order = F.struct(F.col("wins").isNull().alias("w"), (-F.col("wins")).alias("mw"), (-F.col("points")).alias("mp"), "user_id")
    plain = with_positions(rows, ["g"], order)
    sliced = with_positions(rows, ["g"], order, rate=10)
    assert sliced.count() == 400
    assert sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()
    assert plain.filter("_ties <> 1").isEmpty()
