"""Null-safe equi-joins on shared key columns (a window groups NULL keys, a plain join drops them)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys where NULL equals NULL. Still an equi-join for the planner."""
    named = [F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(right.select(*named), condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])
