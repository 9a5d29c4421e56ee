"""Importance resampling towards a target corpus, on hashed n-gram features.

Every run of 1 to 3 words of a text is a feature and falls into a bucket by its CRC-32. Bucket counts of the documents and
of the target give each bucket a gain, a document weighs the sum of the gains of its features, and Gumbel noise drawn from
its id turns weights into a sample without replacement: the highest scores are drawn.

N-grams are interned chunk by chunk in an open-addressed table: keys are xxHash64 values, a hit is verified byte by byte, a
slot stores the bucket and the count, and the slot id of each occurrence gathers its gain. So a CRC is computed once per
different n-gram of a chunk, and memory is bounded by the chunk and the longest text. What leaves a task of the counting
pass is one row per bucket.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridledger.llm.bytewords import Words, find_words, joined, lanes, same_bytes, xxh64
from gridledger.llm.common import give_back, in_batches
from gridledger.operators.session import durable

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
#: Words whose runs are interned together. It deals out work and changes no result.
CHUNK_WORDS = 1 << 14

#: The CRC-32 of every single byte (reflected polynomial EDB88320).
CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_TABLE = np.where(CRC_TABLE & 1, (CRC_TABLE >> 1) ^ np.uint32(0xEDB88320), CRC_TABLE >> 1).astype(np.uint32)


def crc32(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices data[at:at+size], a byte of all slices at a time; very long slices one by one."""
    order = np.argsort(-np.minimum(size, 257).astype(np.int16), kind="stable")
    at, size = at[order], size[order]
    state = np.full(len(at), 0xFFFFFFFF, np.uint32)
    n_huge = int(np.count_nonzero(size > 256))
    for i in range(n_huge):
        state[i] = zlib.crc32(data[at[i] : at[i] + size[i]].tobytes()) ^ 0xFFFFFFFF
    at, below, rest = at[n_huge:], -size[n_huge:], state[n_huge:]
    for k in range(int(-below[0]) if len(below) else 0):
        n = int(np.searchsorted(below, -k, "left"))  # slices with more than k bytes
        rest[:n] = CRC_TABLE[(rest[:n] ^ data[at[:n] + k]) & 0xFF] ^ (rest[:n] >> 8)
    found = np.empty_like(state)
    found[order] = state ^ np.uint32(0xFFFFFFFF)
    return found


class InternTable:
    """Slots for the different byte strings of a chunk: open addressing, linear probing, at most half full."""

    def __init__(self, data: np.ndarray, at: np.ndarray, size: np.ndarray, buckets: int):
        lane = lanes(data)
        key = xxh64(data, lane, at, size)
        mask = (1 << max(4, int(2 * len(at)).bit_length())) - 1
        holder = np.full(mask + 1, -1, np.int32)  # the occurrence whose bytes the slot stands for
        #: Slot of every occurrence.
        self.slot = (key & np.uint64(mask)).astype(np.int64)
        waiting = np.arange(len(at), dtype=np.int32)
        while len(waiting):
            slot = self.slot[waiting]
            free = holder[slot] < 0
            holder[slot[free]] = waiting[free]
            held = holder[slot]
            hit = (key[held] == key[waiting]) & (size[held] == size[waiting])
            rows = np.flatnonzero(hit & (held != waiting))
            hit[rows] = same_bytes(lane, at[held[rows]], at[waiting[rows]], size[waiting[rows]])
            waiting = waiting[~hit]
            self.slot[waiting] = (self.slot[waiting] + 1) & mask
        used = np.flatnonzero(holder >= 0)
        first = holder[used]
        #: Of every slot: its bucket, and how often its string occurs.
        self.bucket = np.zeros(mask + 1, np.int32)
        self.bucket[used] = crc32(data, at[first], size[first]) % np.uint32(buckets)
        self.count = np.bincount(self.slot, minlength=mask + 1)


def _chunks(words: Words, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, InternTable]]:
    """Per chunk of words: the text each of its runs belongs to, and the table that interns them."""
    total = len(words.starts)
    for first in range(0, total, CHUNK_WORDS):
        last = min(total, first + CHUNK_WORDS)
        seen = min(total, last + longest - 1)  # runs that begin here may end in the next chunk
        data, begin, end = joined(words, first, seen)
        row = words.row[first:seen]
        at, size, owner = [], [], []
        for n in range(1, longest + 1):
            i = np.arange(min(last - first, max(0, seen - first - n + 1)))
            i = i[row[i] == row[i + n - 1]]
            at.append(begin[i])
            size.append(end[i + n - 1] - begin[i])
            owner.append(row[i])
        yield np.concatenate(owner), InternTable(data, np.concatenate(at), np.concatenate(size), buckets)


def _counter(longest: int, buckets: int, min_words: int):
    """Over batches of texts: a task's features per bucket, and under bucket -1 its texts with enough words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, enough = np.zeros(buckets, np.int64), 0
        for batch in batches:
            give_back()
            words = find_words(batch.column(0))
            enough += int(np.count_nonzero(np.bincount(words.row, minlength=batch.num_rows) >= min_words))
            for _, table in _chunks(words, longest, buckets):
                used = np.flatnonzero(table.count)
                totals += np.bincount(table.bucket[used], table.count[used], buckets).astype(np.int64)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(totals[some], enough), pa.int64())],
            names=["bucket", "n"],
        )

    return count


def _weigher(gains: np.ndarray, longest: int):
    """Over batches (key, text): words, features and summed gains of every text."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            give_back()
            words = find_words(batch.column(1))
            n_words = np.bincount(words.row, minlength=batch.num_rows).astype(np.int64)
            weight = np.zeros(batch.num_rows, np.int64)
            for owner, table in _chunks(words, longest, len(gains)):
                np.add.at(weight, owner, gains[table.bucket][table.slot])
            n_features = sum(np.maximum(n_words - n, 0) for n in range(longest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features, pa.int64()), pa.array(weight)],
                names=["key", "n_words", "n_features", "weight"],
            )

    return weigh


def bucket_counts(
    texts: DataFrame, text: str = "text", *, longest: int = LONGEST, buckets: int = BUCKETS, min_words: int = MIN_WORDS
) -> tuple[np.ndarray, int]:
    """Features per bucket over all texts, and the number of texts with at least `min_words` words.

    A task sends at most a row per bucket, and as many rows come to the driver: their number is a parameter.
    """
    read = in_batches(texts.select(F.col(text).cast("string").alias("text")))
    found = read.mapInArrow(_counter(longest, buckets, min_words), "bucket int, n bigint")
    totals, enough = np.zeros(buckets, np.int64), 0
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if row.bucket < 0:
            enough = row.n
        else:
            totals[row.bucket] = row.n
    return totals, enough


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of target share to raw share of every bucket, both smoothed by one, rounded down."""
    n, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def gumbel(doc_id: Column, seed: int) -> Column:
    """1000 times a standard Gumbel value drawn from the digest of seed and id, rounded down. A NULL id draws as ''."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(
    documents: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
) -> tuple[DataFrame, int]:
    """(`key`, `n_words`, `n_features`, `weight` per document, number of documents with at least `min_words` words)."""
    sizes = {"longest": longest, "buckets": buckets}
    raw, enough = bucket_counts(documents, text, min_words=min_words, **sizes)
    wanted, _ = bucket_counts(target, target_text, **sizes)
    read = documents.select(F.col(doc_id).alias("key"), F.col(text).cast("string").alias("text"))
    kind = read.schema["key"].dataType.simpleString()
    made = _weigher(bucket_gains(raw, wanted), longest)
    return in_batches(read).mapInArrow(made, f"key {kind}, n_words bigint, n_features bigint, weight bigint"), enough


def resample(
    documents: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = 42,
) -> DataFrame:
    """Every document's id, `n_features`, `weight`, `score` and, where it is drawn, its `rank`.

    Of the documents with at least `min_words` words `percent` of a hundred are drawn, rounded down: those with the
    highest scores, equal scores by id (NULL last). A row counts as often as it stands in the table, so equal rows take ranks
    that follow one another. A NULL or empty text has no features and weighs 0. An empty target has no counts, only the
    smoothing. An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    weighed, enough = weigh(
        documents, target, doc_id=doc_id, text=text, target_text=target_text, longest=longest, buckets=buckets,
        min_words=min_words,
    )
    scored = weighed.select(
        "key", "n_features", "weight", (F.col("n_words") >= min_words).alias("eligible"),
        (F.col("weight") + gumbel(F.col("key"), seed)).alias("score"),
    )
    ranked = _ranks(scored, percent * enough // 100)
    return ranked.select(F.col("key").alias(doc_id), "n_features", "weight", "score", "rank")


def _ranks(scored: DataFrame, drawn: int) -> DataFrame:
    """Ranks by prefix sums over ranges of the order, so that no task sees more than a range.

    Equal rows are counted first, so a row that stands very often in the table is one row here. The ranges are written with
    their number, because a second pass over the range partitioning could cut elsewhere.
    """
    names = ["key", "n_features", "weight", "eligible", "score"]
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("key"), F.asc("n_features")]
    counted = scored.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    dealt = durable(counted.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (  # a row per partition
        dealt.groupBy("part").agg(F.sum("copies").alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = dealt.select("*", F.sum("copies").over(inside).alias("upto")).join(offsets, "part")
    last = F.col("offset") + F.col("upto")
    return placed.select(*names, F.explode(F.sequence(last - F.col("copies") + 1, last)).alias("place")).select(
        *names, F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place")).alias("rank")
    )
