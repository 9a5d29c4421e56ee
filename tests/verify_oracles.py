"""Compare registered queries with their SQL on the driver's tables: python tests/verify_oracles.py [sf] [names...]"""

from __future__ import annotations

import math
import pathlib
import sys
import time
from collections import Counter

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
            benchmark labels conversations""".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def compare(df, con, statement: str) -> str | None:
    """None when columns and rows are equal, else what differs."""
    columns = sorted(df.columns)
    result = con.execute(statement)
    theirs = sorted(c[0] for c in result.description)
    if columns != theirs:
        return f"columns {columns} vs {theirs}"
    order = [[c[0] for c in result.description].index(c) for c in columns]
    expected = sorted([plain(row[i]) for i in order] for row in result.fetchall())
    actual = sorted([plain(row[c]) for c in columns] for row in df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    if actual == expected:
        return None
    ours, other = Counter(map(tuple, actual)), Counter(map(tuple, expected))
    extra, missing = list(ours - other), list(other - ours)
    return f"{columns}: {len(extra)} rows of ours, e.g. {extra[:2]}; {len(missing)} expected, e.g. {missing[:2]}"


def main() -> int:
    from conftest import make_session

    from __spark_entry__ import oracle_sql, queries

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(queries())
    spark, con, bad = make_session(), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            statement = oracle_sql().get(name)
            verdict = compare(df, con, statement) if statement else f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += bool(verdict) and not verdict.startswith("no SQL")
        print(f"{name:34s} {time.time() - start:6.2f}s  {verdict or 'ok'}", flush=True)
    print(f"{bad} of {len(names)} queries differ")
    return bool(bad)


if __name__ == "__main__":
    sys.path.insert(0, str(pathlib.Path(__file__).parent))
    sys.exit(main())
