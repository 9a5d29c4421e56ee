"""Data-quality rules on DataFrames: warn, drop, fail, quarantine and group gates.

A rule is SQL text. A row whose rule is NULL violates it, in every mode (fail closed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationError(Exception):
    """Raised before publishing when a rule of mode `fail` is violated."""


def holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def _counts(rules: dict[str, str]) -> list[Column]:
    violated = [F.count_if(~holds(rule)).alias(name) for name, rule in rules.items()]
    return [F.count(F.lit(1)).alias("rows"), *violated]


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with the number of rows seen and of rows that violate it."""
    entries = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col("rows"), F.col(name).alias("violations"))
          for name in rules]
    )
    return df.agg(*_counts(rules)).select(F.inline(entries))


def watch(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, Observation]:
    """The same rows; `rows` and the violations of every rule are counted by the job that computes them."""
    observation = Observation()
    return df.observe(observation, *_counts(rules)), observation


def expect(
    df: DataFrame, rules: dict[str, str], mode: str = "warn"
) -> tuple[DataFrame, Observation | None]:
    """Apply rules. `warn` keeps and `drop` removes violating rows; both count them while the
    result is computed. `fail` counts them now and raises."""
    if mode == "fail":
        seen = df.agg(*_counts(rules)).first().asDict()
        broken = {name: seen[name] for name in rules if seen[name]}
        if broken:
            raise ExpectationError(f"{broken} of {seen['rows']} rows violate the rules")
        return df, None
    if mode not in ("warn", "drop"):
        raise ValueError(f"unknown mode: {mode}")
    observed, observation = watch(df, rules)
    return keep_valid(observed, rules) if mode == "drop" else observed, observation


def keep_valid(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The rows that satisfy every rule, without counting."""
    for rule in rules.values():
        df = df.filter(holds(rule))
    return df


def quarantine(df: DataFrame, rule: str) -> tuple[DataFrame, DataFrame]:
    """(rows that do not match, rows that match); disjoint, and together all rows."""
    return df.filter(~holds(rule)), df.filter(holds(rule))


def group_counts(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Rows per group, the input of an aggregate gate."""
    kept = df.filter(where) if where else df
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
