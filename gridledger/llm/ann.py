"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; its hash is
the nearest signed axis. Each table has its own rotation. A vector is stored once per table, under its axis; a query
looks under the `probes` axes nearest to it in each table. What it finds there is ranked by the exact
inner product of the original vectors in double precision.

A bucket is dealt into chunks of bounded size, and so are the queries that look into it; a unit of work is
one chunk of each, so equal vectors in any number make more units, not larger ones. A task merges the best of all
its units before it sends them on. No row is dropped from a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridledger.operators.session import durable

TABLES = 4
PROBES = 48
#: More probes than any vector has axes.
ALL_AXES = 1 << 30
BEST = 20
CHUNK = 4096
#: Units are dealt to so many tasks at least, and to one more for each TASK_ROWS looks into a bucket. A query's best
#: are sent on once per task, so more tasks than memory asks for would only send more.
LEAST_TASKS, TASK_ROWS = 48, 200_000
SEED = 7
ROUNDS = 3


@lru_cache(maxsize=256)
def _signs(table: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, size]).choice([-1.0, 1.0], (ROUNDS, size))


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """Pseudo-rotation of the rows, padded with zeros to a power of two (of two axes at least)."""
    size = max(2, 1 << (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), size))
    out[:, : x.shape[1]] = x
    for signs in _signs(table, size):
        out = out * signs
        half = 1
        while half < size:
            pairs = out.reshape(len(x), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
            half *= 2
        out /= math.sqrt(size)
    return out


def axes(x: np.ndarray, table: int, most: int) -> np.ndarray:
    """The `most` signed axes nearest to each row, nearest first: axis i and its opposite i + size."""
    turned = rotate(x / np.abs(x).max(axis=1, keepdims=True), table)
    signed = np.concatenate([turned, -turned], axis=1)
    return np.argsort(-signed, axis=1, kind="stable")[:, : min(most, signed.shape[1])]


def _buckets(tables: int, probes: int):
    """Batches (id, vector) to (table, bucket, id, vector): one row per table, or per table and probe."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, lists = part.column(0), part.column(1)
                flat = lists.flatten()
                start = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())))
                values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float)
                by_size: dict[int, list[int]] = {}
                for row in range(len(ids)):
                    x = values[start[row] : start[row + 1]]
                    if len(x) and np.isfinite(x).all() and x.any():
                        by_size.setdefault(len(x), []).append(row)
                for size, rows in by_size.items():
                    x = np.array([values[start[r] : start[r + 1]] for r in rows])
                    packed = pa.array([v.tobytes() for v in x], pa.binary())
                    mine = ids.take(pa.array(rows))
                    for table in range(tables):
                        near = axes(x, table, probes)
                        take = pa.array(np.repeat(np.arange(len(rows)), near.shape[1]))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(near.size, table, np.int32)), pa.array(np.full(near.size, size, np.int32)),
                            pa.array(near.ravel().astype(np.int32)), mine.take(take), packed.take(take),
                        ], names=["tab", "size", "bucket", "id", "vector"])

    return buckets


def best_of(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Positions of the best, ties to the smaller id, each id and score once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    again = np.zeros(len(order), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (scores[1:] == scores[:-1])
    return order[~again][:most]


def _search(most: int):
    """All units of a task: the best of each query over the units together."""

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        unit, asks = table["unit"].to_numpy(), table["asks"].to_numpy(zero_copy_only=False)
        ids, packed = table["id"].to_numpy(), table["vector"]
        order = np.lexsort((asks, unit))
        cuts = np.flatnonzero(np.append(True, unit[order][1:] != unit[order][:-1]))
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for rows in np.split(order, cuts[1:]):
            mine = asks[rows]
            stored, queries = rows[~mine], rows[mine]
            if not len(stored) or not len(queries):
                continue
            x = np.array([np.frombuffer(packed[int(r)].as_py()) for r in stored])
            for r in queries:
                q = np.frombuffer(packed[int(r)].as_py())
                near = x @ q
                near[ids[stored] == ids[r]] = -np.inf
                pick = np.arange(len(near))
                if len(near) > most:
                    edge = np.partition(near, len(near) - most)[len(near) - most]
                    pick = np.flatnonzero(near >= edge - 1e-9 * (1 + abs(edge)))
                pick = pick[np.isfinite(near[pick])]
                exact = (x[pick] * q).sum(axis=1)  # the same bits for the same vectors, wherever they lie
                best = best_of(ids[stored][pick], exact, most)
                found.setdefault(int(ids[r]), []).append((ids[stored][pick][best], exact[best]))
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for query, parts in found.items():
            near, scores = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
            best = best_of(near, scores, most)
            out.append((query, near[best], scores[best]))
        sizes = [len(a) for _, a, _ in out]
        return pa.table([
            pa.array(np.repeat(np.array([q for q, _, _ in out], np.int64), sizes)),
            pa.array(np.concatenate([a for _, a, _ in out]) if out else np.empty(0, np.int64)),
            pa.array(np.concatenate([b for _, _, b in out]) if out else np.empty(0)),
        ], names=["query_id", "vec_id", "score"])

    return search


def nearest(
    vectors: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding",
    best: int = BEST, tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `best` nearest rows found for each query row, nearest first.

    Nearness is the inner product in double precision; ties go to the smaller id. A row is no candidate for a
    query of its own id. Rows with a NULL id or whose vector is NULL, empty, zero or holds NULL or non-finite
    components take no part; vectors of different lengths never meet. A repeated row is one; different vectors under one
    id are all searched. A query gets `best` rows wherever there are as many candidates, else all of them: those that the
    tables leave short are searched again over all rows. Other columns are not read. Empty tables give no rows.
    """
    read = lambda df: df.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).filter("id is not null and vector is not null").distinct()
    schema = "tab int, size int, bucket int, id long, vector binary"
    stored = durable(read(vectors).mapInArrow(_buckets(tables, 1), schema))
    asked = durable(read(queries).mapInArrow(_buckets(tables, probes), schema))
    found = durable(_found(stored, asked, best).distinct())
    # Queries that found too few look into every bucket of one table, that is at every row.
    served = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= best)
    short = read(queries).join(served, F.col("id") == F.col("query_id"), "left_anti")
    again = durable(short.mapInArrow(_buckets(1, ALL_AXES), schema))
    found = found.union(_found(stored.filter("tab = 0"), again, best)).distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        .select("query_id", "rank", "vec_id", "score")
    )


def _found(stored: DataFrame, asked: DataFrame, best: int) -> DataFrame:
    """The best of each query in the buckets it looks into, a task at a time: `query_id`, `vec_id`, `score`."""
    place = ["tab", "size", "bucket"]
    chunks = lambda df, name: df.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias(name))
    counts = chunks(stored, "stored_chunks").join(chunks(asked, "asked_chunks"), place)
    tasks = max(LEAST_TASKS, math.ceil(asked.count() / TASK_ROWS))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    chunk = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = stored.join(counts, place).withColumn("s", chunk("stored_chunks")).withColumn("a", upto("asked_chunks"))
    right = asked.join(counts, place).withColumn("a", chunk("asked_chunks")).withColumn("s", upto("stored_chunks"))
    unit = F.xxhash64(*place, "s", "a")
    rows = left.select(unit.alias("unit"), F.lit(False).alias("asks"), "id", "vector").union(
        right.select(unit.alias("unit"), F.lit(True).alias("asks"), "id", "vector"))
    return rows.withColumn("task", F.pmod("unit", F.lit(tasks))).groupBy("task").applyInArrow(
        _search(best), "query_id long, vec_id long, score double")
