"""Ranks, tie counts and exact medians inside groups of any size. Plans are lazy: nothing runs while they are built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.bits import with_ordered_bits
from gridledger.operators.joins import join_same
from gridledger.operators.slices import RATE, cuts_of, in_cut_groups, with_slices

#: Bits that a round of the selection of a median looks at.
DIGIT_BITS = 22


def value_positions(df: DataFrame, group: Sequence[str], order: Column, rate: int = RATE) -> DataFrame:
    """One row per distinct value of a group: `_value`, `_ties`, `_before`, `_total`.

    Equal values are counted before the first shuffle, so heavy ties cost one row. Sums run in two levels: over the values
    of a slice, and over the slices of a group.
    """
    values = df.groupBy(*group, order.alias("_value")).agg(F.expr("count(1) AS _ties"))
    sliced = with_slices(values, group, "_value", cuts_of(values, group, "_value", rate, among="_ties"))
    names = [f"`{c}`" for c in group]
    of_group = f"PARTITION BY {', '.join(names)}"
    of_slice, earlier = f"{of_group}, _slice", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    local = sliced.selectExpr(
        "*", f"coalesce(sum(_ties) OVER ({of_slice} ORDER BY _value {earlier}), 0) AS _local",
        f"sum(_ties) OVER ({of_slice}) AS _slice_total",
    )
    per_slice = in_cut_groups(sliced).groupBy(*group, "_slice").agg(F.expr("sum(_ties) AS _rows"))
    offsets = per_slice.selectExpr(
        *names, "_slice", f"sum(_rows) OVER ({of_group} ORDER BY _slice {earlier}) AS _offset",
        f"sum(_rows) OVER ({of_group}) AS _group_total",
    )
    return join_same(local, offsets, [*group, "_slice"]).selectExpr(
        *names, "_value", "_ties", "_local + coalesce(_offset, 0) AS _before",
        "coalesce(_group_total, _slice_total) AS _total",
    )


def with_positions(df: DataFrame, group: Sequence[str], order: Column, rate: int = RATE) -> DataFrame:
    """Add to every row how many rows of its group sort before it (`_before`), share its place
    (`_ties`, itself included), and there are (`_total`). NULL sorts first."""
    found = value_positions(df, group, order, rate)
    keyed = df.select("*", order.alias("_value"))
    return join_same(keyed, found, [*group, "_value"], "inner").select(*df.columns, "_before", "_ties", "_total")


def medians(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median per group: the mean of the two middle values for an even count. NULLs are left out, NaN is the largest.

    Selection by radix. Values are counted by ever fewer leading bits of a number in the same order; then, from the top, a
    round keeps the one or two prefixes that hold the middle and goes on inside them. No group is sorted, a round's window
    sees at most 2^22 counts, and equal values are one count from the first shuffle on.
    """
    known = df.select(*group, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    counts = with_ordered_bits(known, "_v", "_p0").groupBy(*group, "_v", "_p0").agg(F.expr("count(1) AS _n"))
    levels = [counts]  # the last level has the fewest bits
    for level in range(1, -(-64 // DIGIT_BITS)):
        prefix = F.expr(f"shiftright(_p{level - 1}, {DIGIT_BITS}) AS _p{level}")
        levels.append(levels[-1].groupBy(*group, prefix).agg(F.expr("sum(_n) AS _n")))

    names = [f"`{c}`" for c in group]
    top = len(levels) - 1
    whole = f"sum(_n) OVER ({'PARTITION BY ' + ', '.join(names) if names else ''})"
    # Places counted from 0 of the two middle values; inside a prefix they are counted from its first value.
    rows = levels[top].selectExpr("*", f"floor(({whole} - 1) / 2) AS _low", f"floor({whole} / 2) AS _high")
    holds = "({place} BETWEEN 0 AND _n - 1)"
    low, high = (holds.format(place=place) for place in ("_low", "_high"))
    for level in range(top, -1, -1):
        outer, digit = [*group], f"_p{level}"
        if level < top:
            outer.append(f"_p{level + 1}")
            inner = levels[level].selectExpr("*", f"shiftright({digit}, {DIGIT_BITS}) AS {outer[-1]}")
            rows = join_same(inner, rows, outer, "inner")
        parts = "PARTITION BY " + ", ".join(f"`{c}`" for c in outer) if outer else ""
        before = f"coalesce(sum(_n) OVER ({parts} ORDER BY {digit} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        kept = [*names, digit, *([] if level else ["_v"]), "_n"]
        rows = rows.selectExpr(*kept, f"_low - {before} AS _low", f"_high - {before} AS _high").filter(f"{low} OR {high}")
        if level:
            rows = rows.drop("_n")
    middle = f"(max(if({low}, _v, NULL)) + max(if({high}, _v, NULL))) / 2"
    return rows.groupBy(*group).agg(F.expr(middle).alias(name))
