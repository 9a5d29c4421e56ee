"""Parsing of paths and JSON text with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridledger.schemas import DOCUMENT_PATTERN, ENTRIES, PLAYER, PULL_PATTERN, SEASON_PATTERN, STATS, WEEK_PATTERN


def from_path(path: Column, pattern: str) -> Column:
    """First group of the pattern; NULL, not '', when the path has no such part."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def season_from_path(path: Column) -> Column:
    return from_path(path, SEASON_PATTERN)


def week_from_path(path: Column) -> Column:
    return from_path(path, WEEK_PATTERN).try_cast("int")


def pull_from_path(path: Column) -> Column:
    """Number of the pull a file came with; NULL outside a pull's folder."""
    return from_path(path, PULL_PATTERN).try_cast("bigint")


def document_from_path(path: Column) -> Column:
    """What names a document in every pull: the path below the pull's folder."""
    return from_path(path, DOCUMENT_PATTERN)


def full_name(full: Column, first: Column, last: Column) -> Column:
    """The full name, else first and last joined; NULL when nothing is known."""
    joined = F.nullif(F.concat_ws(" ", first, last), F.lit(""))
    return F.coalesce(full, joined)


def entries(text: Column) -> Column:
    """id -> JSON text of the entry; NULL when the document is no object. An odd entry does not touch the others."""
    return F.from_json(text, ENTRIES)


def player(entry: Column) -> Column:
    """One entry of the dictionary; NULL when it is no object."""
    return F.when(F.ltrim(entry).startswith("{"), F.from_json(entry, PLAYER))


def stats(entry: Column) -> Column:
    """One player's stat -> value as text (see `numbers`); NULL when the entry is no object."""
    return F.from_json(entry, STATS)


def stats_map(text: Column) -> Column:
    """player id -> stat -> value as text, for a whole file."""
    return F.transform_values(entries(text), lambda _, entry: stats(entry))


def numbers(texts: Column, kind: str = "double") -> Column:
    """Cast the values of one text map; a value that is no number becomes NULL."""
    return F.transform_values(texts, lambda _, v: v.try_cast(kind))


def struct_to_map(value: Column, value_type: str) -> Column:
    """Turn an inferred wide struct back into a map keyed by field name."""
    return F.from_json(F.to_json(value), f"map<string, {value_type}>")
