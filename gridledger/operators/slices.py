"""Order-preserving slices of groups of any size, in one lazy plan.

A window over a group puts the whole group into one task. Here a group is cut at some of its own values, and the window runs
inside a slice. Values become cuts by their hash, one of `rate` on average, so

* nothing is counted and no job runs while a query is defined: the rule is the same for every group,
* a group has as many slices as its size asks for, and a slice has about `rate` different values,
* a task that is run again cuts at the same places.

Groups of fewer than `rate` values mostly have no cut at all and stay whole. The cuts of a group are one sorted array, found
by its rows through a join on the group; where no group has a cut, adaptive execution drops that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.operators.joins import join_same

#: One of so many different values of a group becomes a cut.
RATE = 65_536


def with_slices(df: DataFrame, group: Sequence[str], order: str, cuts: DataFrame) -> DataFrame:
    """Add `_slice`: how many cuts of the row's group lie at or below its value of `order`; -1 in a group without cuts."""
    columns = [f"`{c}`" for c in df.columns]
    return join_same(df, cuts, group).selectExpr(*columns, f"coalesce({cuts_upto('_cuts', order)}, -1) AS _slice")


def in_cut_groups(sliced: DataFrame) -> DataFrame:
    return sliced.filter("_slice >= 0")


def cuts_of(df: DataFrame, group: Sequence[str], order: str, rate: int = RATE, among: str = "1") -> DataFrame:
    """One row per group that is cut: `_cuts`, sorted. `among` may be a count of at least 1 that a preceding aggregate has
    made: it keeps the choice above that aggregate, so that its shuffled rows are read again instead of computed again."""
    values = ", ".join(f"`{c}`" for c in [*group, order])
    picked = df.filter(f"pmod(xxhash64({values}), {rate}) * {among} = 0")
    return picked.groupBy(*group).agg(F.expr(f"sort_array(collect_set(`{order}`)) AS _cuts"))


def cuts_upto(cuts: str, value: str) -> str:
    """SQL for how many of the sorted cuts are at most the value, by halving; NULL without cuts. A NULL value lies before all."""
    steps = "transform(sequence(30, 0, -1), i -> shiftleft(1, i))"
    advance = f"(found, step) -> if(get({cuts}, found + step - 1) <= `{value}`, found + step, found)"
    return f"if({cuts} IS NOT NULL, aggregate({steps}, 0, {advance}), NULL)"
