"""Ranked lexical search over all documents: MaxScore with bounds of term pairs.

* `build` makes the index. Documents are dealt into shards (rows of a table): postings per term, then, once document
  frequencies are known, the impact of every posting, the largest impact of every term, and for pairs of terms that are asked
  for together the list of documents that hold both, with the largest joint impact.
* `search` runs all queries of a block over every shard. The terms of a query fall into units, pairs where an intersection
  list exists and single terms. A document holds one term of a pair or both, so a pair adds at most the larger of its term
  maxima and its joint maximum, which is less than the sum of both maxima. Units whose bounds together stay below the score
  to beat are not opened: only documents of the other units are candidates, and a candidate is dropped as soon as what it
  has and what the rest may add is below that score.

Queries are taken in blocks of bounded text, each block in one pass over the documents; a task keeps the best `k` per query
and the score to beat from shard to shard. Results are exact: nothing is approximated or cut but the `k`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.llm.bytewords import find_words, lanes, same_bytes, xxh64
from gridledger.llm.common import give_back, in_batches
from gridledger.operators.session import durable

TOP = 20
#: Documents and text bytes of a shard, and text bytes of a block of queries. They deal out work and change no result.
SHARD_DOCS, SHARD_BYTES = 8192, 16 << 20
BLOCK_BYTES = 4 << 20


class Vocabulary:
    """The different terms of a block of queries, found again in texts by hash and by bytes."""

    def __init__(self, texts: list[str | None]):
        words = find_words(pa.array(texts, pa.string()))
        terms = [words.folded[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
        self.terms = sorted(set(terms))
        number = {term: i for i, term in enumerate(self.terms)}
        #: Per query: its terms and how often it repeats them.
        self.queries: list[tuple[np.ndarray, np.ndarray]] = []
        found = np.array([number[t] for t in terms], np.int64)
        for i in range(len(texts)):
            self.queries.append(np.unique(found[words.row == i], return_counts=True))
        self.bytes = np.frombuffer(b"".join(self.terms), np.uint8)
        self.size = np.array([len(t) for t in self.terms], np.int64)
        self.at = np.cumsum(self.size) - self.size
        keys = xxh64(self.bytes, lanes(self.bytes), self.at, self.size)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def look_up(self, folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The term of every word, -1 for words no query asks for."""
        if not len(starts) or not self.terms:
            return np.full(len(starts), -1, np.int64)
        data = np.concatenate((folded, self.bytes))
        lane, size = lanes(data), ends - starts
        key = xxh64(data, lane, starts, size)
        term = np.full(len(starts), -1, np.int64)
        left = np.searchsorted(self.keys, key, "left")
        waiting = np.arange(len(starts))
        while len(waiting):  # equal hashes of different terms stand next to each other
            waiting = waiting[left[waiting] < len(self.keys)]
            waiting = waiting[self.keys[left[waiting]] == key[waiting]]
            other = self.order[left[waiting]]
            equal = self.size[other] == size[waiting]
            equal[equal] = same_bytes(
                lane, starts[waiting[equal]], len(folded) + self.at[other[equal]], size[waiting[equal]]
            )
            term[waiting[equal]] = other[equal]
            waiting = waiting[~equal]
            left[waiting] += 1
        return term


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One row that holds the whole array."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


POSTINGS = "n_docs bigint, n_terms bigint, sizes array<bigint>, terms array<int>, dfs array<bigint>, docs array<int>, tfs array<bigint>"


def _post(vocabulary: Vocabulary, key_type: pa.DataType):
    """Over batches (key, text): a row per shard with the postings of the vocabulary's terms."""

    def close(parts) -> pa.RecordBatch:
        keys, sizes, docs, terms, tfs = (list(x) for x in zip(*parts, strict=True))
        bases = np.cumsum([0, *map(len, sizes)])
        doc = np.concatenate([d + b for d, b in zip(docs, bases, strict=False)])
        term, tf, size = np.concatenate(terms), np.concatenate(tfs), np.concatenate(sizes)
        order = np.argsort(term * len(size) + doc, kind="stable")
        found, dfs = np.unique(term, return_counts=True)
        key = pa.concat_arrays(keys)
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key),
             pa.array([int(np.count_nonzero(size))]), pa.array([int(size.sum())]), _lists(size, pa.int64()),
             _lists(found, pa.int32()), _lists(dfs, pa.int64()), _lists(doc[order], pa.int32()), _lists(tf[order], pa.int64())],
            names=["keys", "n_docs", "n_terms", "sizes", "terms", "dfs", "docs", "tfs"],
        )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, size = [], 0, 0
        for batch in batches:
            give_back()
            words = find_words(batch.column(1))
            term = vocabulary.look_up(words.folded, words.starts, words.ends)
            asked = term >= 0
            pair, tf = np.unique(words.row[asked] * len(vocabulary.terms) + term[asked], return_counts=True)
            doc, term = np.divmod(pair, max(1, len(vocabulary.terms)))
            sizes = np.bincount(words.row, minlength=batch.num_rows).astype(np.int64)
            parts.append((batch.column(0).cast(key_type), sizes, doc, term, tf))
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= SHARD_DOCS or size >= SHARD_BYTES:
                yield close(parts)
                parts, rows, size = [], 0, 0
        if parts:
            yield close(parts)

    return post


@dataclass(frozen=True)
class Statistics:
    """Over all documents: those with a term, their terms with repeats, and the weight of every term of the vocabulary."""

    documents: int
    terms: int
    weight: np.ndarray


def _statistics(postings: DataFrame, vocabulary: Vocabulary) -> Statistics:
    """A row per term of the block reaches the driver."""
    df = np.zeros(len(vocabulary.terms), np.int64)
    counts = postings.select(F.inline(F.arrays_zip("terms", "dfs"))).groupBy("terms").agg(F.sum("dfs").alias("df"))
    for row in counts.collect():
        df[row.terms] = row.df
    totals = postings.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n, terms = totals.n or 0, totals.l or 0
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()]
    return Statistics(n, terms, np.array(weight, np.int64))


def pairs_of(vocabulary: Vocabulary, weight: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per query: its terms two by two, rarest first, so that the partners are alike in weight and seldom meet."""
    found = []
    for terms, _ in vocabulary.queries:
        known = [int(t) for t in terms if weight[t]]
        known.sort(key=lambda t: (-weight[t], t))
        found.append([(min(p), max(p)) for p in zip(known[::2], known[1::2], strict=False)])
    return found


INDEX = (
    "terms array<int>, starts array<int>, docs array<int>, impacts array<bigint>, maxima array<bigint>, "
    "pair_a array<int>, pair_b array<int>, pair_starts array<int>, pair_docs array<int>, joint array<bigint>"
)


def impacts(tf: np.ndarray, size: np.ndarray, weight: np.ndarray, total: Statistics) -> np.ndarray:
    """What a term adds to a document's score, in 64-bit integers."""
    length = 75 + (25 * size * total.documents) // max(1, total.terms)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * length))


def _weigh(total: Statistics, pairs: np.ndarray):
    """Over postings: the same shards with impacts, term maxima, and lists and joint maxima of the pairs of terms."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            give_back()
            for i in range(batch.num_rows):
                keys, sizes, terms, dfs, docs, tfs = (batch.column(n)[i].values for n in ("keys", "sizes", "terms", "dfs", "docs", "tfs"))
                size, term, df, doc, tf = (x.to_numpy(zero_copy_only=False) for x in (sizes, terms, dfs, docs, tfs))
                starts = np.concatenate(([0], np.cumsum(df)))
                impact = impacts(tf, size[doc], np.repeat(total.weight[term], df), total)
                top = np.maximum.reduceat(impact, starts[:-1]) if len(term) else impact
                place = np.full(len(total.weight), -1, np.int64)
                place[term] = np.arange(len(term))
                here = pairs[(place[pairs[:, 0]] >= 0) & (place[pairs[:, 1]] >= 0)]
                dense = np.zeros(len(size), np.int64)
                shared, joint = [], []
                for a, b in place[here].tolist():
                    da, db = doc[starts[a] : starts[a + 1]], doc[starts[b] : starts[b + 1]]
                    dense[da] = impact[starts[a] : starts[a + 1]]
                    got = dense[db]
                    both = got > 0
                    shared.append(db[both])
                    joint.append(int((got[both] + impact[starts[b] : starts[b + 1]][both]).max(initial=0)))
                    dense[da] = 0
                ends = np.cumsum([0, *map(len, shared)])
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                     _lists(term, pa.int32()), _lists(starts, pa.int32()), _lists(doc, pa.int32()), _lists(impact, pa.int64()),
                     _lists(top, pa.int64()), _lists(here[:, 0], pa.int32()), _lists(here[:, 1], pa.int32()),
                     _lists(ends, pa.int32()), _lists(np.concatenate([*shared, np.zeros(0, np.int32)]), pa.int32()),
                     _lists(np.array(joint, np.int64), pa.int64())],
                    names=["keys", "terms", "starts", "docs", "impacts", "maxima", "pair_a", "pair_b", "pair_starts", "pair_docs", "joint"],
                )

    return weigh


@dataclass
class Shard:
    """A shard as it is searched: postings and bounds by term, lists and bounds by pair."""

    size: int
    postings: dict[int, tuple[np.ndarray, np.ndarray]]
    top: dict[int, int]
    joint: dict[tuple[int, int], int]

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int) -> "Shard":
        term, starts, docs, impact, top, a, b, joint = (
            batch.column(n)[i].values.to_numpy(zero_copy_only=False)
            for n in ("terms", "starts", "docs", "impacts", "maxima", "pair_a", "pair_b", "joint")
        )
        spans = zip(term.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True)
        return cls(
            len(batch.column("keys")[i].values),
            {t: (docs[x:y], impact[x:y]) for t, x, y in spans},
            dict(zip(term.tolist(), top.tolist(), strict=True)),
            dict(zip(zip(a.tolist(), b.tolist(), strict=True), joint.tolist(), strict=True)),
        )


def units_of(shard: Shard, repeats: dict[int, int], pairs: list[tuple[int, int]]) -> list[tuple[int, tuple[int, ...]]]:
    """(bound, terms) of the query's units that occur in the shard, least bound first."""
    single = {t: n * shard.top[t] for t, n in repeats.items() if shard.top.get(t, 0) > 0}
    units = []
    for a, b in pairs:
        if a in single and b in single:
            bound = max(single[a], single[b])
            if shard.joint.get((a, b), 0):
                more = a if repeats[a] > repeats[b] else b
                both = min(repeats[a], repeats[b]) * shard.joint[a, b]
                bound = max(bound, both + (repeats[more] - min(repeats[a], repeats[b])) * shard.top[more])
            bound = min(bound, single[a] + single[b])
            units.append((bound, (a, b)))
            del single[a], single[b]
    return sorted([*units, *((bound, (t,)) for t, bound in single.items())])


def best(shard: Shard, repeats: dict[int, int], pairs: list[tuple[int, int]], beat: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the shard that reach `beat` (above 0), unordered; their scores are whole."""
    units = units_of(shard, repeats, pairs)
    bounds = np.cumsum([0, *(b for b, _ in units)]).tolist()  # bounds[i]: what the first i units add at most
    first = 0  # units from here on are essential
    while first < len(units) and bounds[first + 1] < beat:
        first += 1
    score = np.zeros(shard.size, np.int64)

    def add(unit: tuple[int, ...]) -> None:
        for t in unit:
            docs, impact = shard.postings[t]
            score[docs] += repeats[t] * impact

    for _, unit in units[first:]:
        add(unit)
    docs = np.flatnonzero(score)
    for i in range(first - 1, -1, -1):
        docs = docs[score[docs] + bounds[i + 1] >= beat]
        if not len(docs):
            break
        add(units[i][1])
    found = score[docs]
    kept = found >= max(beat, 1)
    return docs[kept], found[kept]


def _ask(queries: list[tuple[dict[int, int], list[tuple[int, int]]]], top: int, key_type: pa.DataType):
    """Over shards: a task's best documents of every query."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per query: (minus score, key is NULL, key), best first.
        kept: list[list[tuple]] = [[] for _ in queries]
        for batch in batches:
            give_back()
            for i in range(batch.num_rows):
                shard = Shard.read(batch, i)
                keys = batch.column("keys")[i].values
                place = np.empty(len(keys), np.int64)
                place[pa.compute.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
                for q, (repeats, pairs) in enumerate(queries):
                    beat = -kept[q][-1][0] if len(kept[q]) == top else 0
                    docs, scores = best(shard, repeats, pairs, beat)
                    if not len(docs):
                        continue
                    if len(docs) > top:
                        order = np.lexsort((place[docs], -scores))[:top]
                        docs, scores = docs[order], scores[order]
                    names = keys.take(pa.array(docs)).to_pylist()
                    kept[q] = sorted([*kept[q], *((-s, k is None, k) for s, k in zip(scores.tolist(), names, strict=True))], key=_by_rank)[:top]
        rows = [(q, -s, k) for q, best_of in enumerate(kept) for s, _, k in best_of]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], key_type)],
            names=["query", "score", "key"],
        )

    return ask


def _by_rank(entry: tuple) -> tuple:
    return entry[:2] if entry[1] else entry


def _blocks(queries: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """(item, text) in blocks of bounded text; the driver holds one block at a time."""
    block, size = [], 0
    for item, words in queries.select(item_id, F.col(text).cast("string")).toLocalIterator():
        block.append((item, words))
        size += 64 + len(words or "")
        if size > BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


@dataclass
class Index:
    """The index of all documents for a block of queries."""

    shards: DataFrame
    vocabulary: Vocabulary
    statistics: Statistics
    pairs: list[list[tuple[int, int]]]


def build(documents: DataFrame, texts: list[str | None], *, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Index all documents for the terms of the given query texts, with intersection lists of their pairs of terms."""
    vocabulary = Vocabulary(texts)
    read = documents.select(F.col(doc_id).alias("key"), F.col(text).cast("string").alias("text"))
    kind = read.schema["key"].dataType
    keys = f"keys array<{kind.simpleString()}>, "
    postings = durable(in_batches(read).mapInArrow(_post(vocabulary, _arrow(kind)), keys + POSTINGS))
    total = _statistics(postings, vocabulary)
    pairs = pairs_of(vocabulary, total.weight)
    wanted = np.array(sorted({p for of in pairs for p in of}), np.int64).reshape(-1, 2)
    shards = durable(in_batches(postings).mapInArrow(_weigh(total, wanted), keys + INDEX))
    return Index(shards, vocabulary, total, pairs)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def search_block(index: Index, top: int = TOP) -> DataFrame:
    """`query` (place in the block), `rank`, `key`, `score` of the best documents of every query of the block."""
    asked = [
        (dict(zip(terms.tolist(), counts.tolist(), strict=True)), pairs)
        for (terms, counts), pairs in zip(index.vocabulary.queries, index.pairs, strict=True)
    ]
    kind = index.shards.schema["keys"].dataType.elementType
    schema = f"query int, score bigint, key {kind.simpleString()}"
    found = in_batches(index.shards).mapInArrow(_ask(asked, top, _arrow(kind)), schema)
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(
    documents: DataFrame, queries: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", query: str = "text", top: int = TOP,
) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: the `top` best documents of every query, those with a score above 0 only.

    Equal scores rank by id, NULL last. Every row of a table counts by itself: equal documents and documents without id are
    ranked one after another, equal items are answered each. A NULL or empty text, a query without a known term and an
    empty table give no rows. Other columns, whatever their names, are not read.
    """
    spark = documents.sparkSession
    ids = queries.schema[item_id].dataType
    keys = documents.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField(item_id, ids), T.StructField("rank", T.IntegerType()),
        T.StructField(doc_id, keys), T.StructField("score", T.LongType()),
    ])
    found = spark.createDataFrame([], schema)
    for block in _blocks(queries, item_id, query):
        index = build(documents, [words for _, words in block], doc_id=doc_id, text=text)
        asked = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item", ids)])
        items = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], asked)
        answers = search_block(index, top).join(items, "query")
        found = found.unionByName(
            answers.select(F.col("item").alias(item_id), "rank", F.col("key").alias(doc_id), "score")
        )
    return found
