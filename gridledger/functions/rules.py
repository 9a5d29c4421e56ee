"""Business rules as Column builders. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridledger.functions.parsing import week_from_path  # noqa: F401  (a rule by name)
from gridledger.schemas import EMPTY_SLOT, UNIT_PATTERN


def is_empty_slot(player_id: Column) -> Column:
    text = player_id.cast("string")
    return text.isNull() | (text == EMPTY_SLOT)


def is_unit(player_id: Column) -> Column:
    """Team units carry an upper-case code as id; people carry a number."""
    return player_id.rlike(UNIT_PATTERN)


def versus(points: Column, other: Column) -> Column:
    """W, L or T of a score against another score; NULL without another score."""
    return F.when(
        other.isNotNull(),
        F.when(points > other, "W").when(points < other, "L").otherwise("T"),
    )


game_result = versus
median_result = versus


def win_value(result: Column) -> Column:
    """A tie is half a win. A missing result is none."""
    return F.when(result == "W", 1.0).when(result == "T", 0.5).otherwise(0.0)


def is_result(result: Column, letter: str) -> Column:
    """1 or 0 for a known result, NULL for a missing one (ties count neither way)."""
    return (result == letter).cast("int")


def all_play_wins(before: Column, ties: Column) -> Column:
    """Teams outscored plus half a win for each other team on the same score."""
    return before + 0.5 * (ties - 1)


def all_play_games(total: Column) -> Column:
    return total - 1


def expected_wins(wins: Column, games: Column, total_games: Column) -> Column:
    """All-play rate scaled to the games played, rounded once; 0.0 without all-play games."""
    rate = F.try_divide(wins, games)
    return F.coalesce(F.round(rate * total_games, 1), F.lit(0.0))


def luck(actual: Column, expected: Column) -> Column:
    return F.round(actual - expected, 1)


def is_paid(amount: Column) -> Column:
    return amount > 0


def points_per_dollar(points: Column, amount: Column) -> Column:
    """NULL for a missing or non-positive amount; missing points count as 0."""
    return F.when(is_paid(amount), F.round(F.coalesce(points, F.lit(0.0)) / amount, 2))
