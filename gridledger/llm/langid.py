"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (1 to 3 characters, words bounded by a blank) of a language,
most frequent first. A document's own most frequent n-grams are compared with each profile: every n-gram
adds how far it is out of place, one that the profile lacks adds the most. The least sum wins.

Profiles are counted over all labelled rows: tasks add up their n-grams first, and Spark adds up the
tasks' sums. They are bounded: `profile_size` n-grams for each of at most MAX_LANGUAGES languages; only they reach the
driver and go back to the tasks. A prediction is row-local and reads the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridledger.llm.common import in_batches

PROFILE_SIZE = 400
MAX_LANGUAGES = 1000
UNKNOWN = "und"
#: Distinct n-grams a task holds before it passes them on.
HELD_GRAMS = 1 << 18
_BLANK = 32
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers, most frequent first (ties by number), and their counts.

    Letters are lower-cased; everything else separates words. No letters, no n-grams.
    """
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[points]
    points = np.where(letter, points, _BLANK)
    keep = letter.copy()
    keep[:-1] |= letter[1:]  # one blank before each word
    keep[-1] = True
    points = points[keep].astype(np.uint64)
    if len(points) < 2:
        return none
    two = points[:-1] << np.uint64(21) | points[1:]
    three = two[:-1] << np.uint64(21) | points[2:]
    inner = points[1:-1] == _BLANK  # nothing reaches over the blank between two words
    found = np.sort(np.concatenate([points[points != _BLANK], two, three[~inner]]))
    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    counts = np.diff(np.append(starts, len(found)))
    values = found[starts]
    order = np.lexsort((values, -counts))
    return values[order], counts[order]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (lang, text) to (lang, gram, n), added up as far as memory allows."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        values = np.concatenate([v for v, _ in parts])
        order = np.argsort(values)
        values = values[order]
        counts = np.concatenate([c for _, c in parts])[order]
        starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        return values[starts], np.add.reduceat(counts, starts)

    def flush():
        for lang, parts in held.items():
            values, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts)],
                names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for lang, text in zip(langs, texts, strict=True):
            found = grams(text.as_py())
            if len(found[0]):
                held.setdefault(lang, []).append(found)
                size += len(found[0])
            if size > HELD_GRAMS:
                for key, parts in held.items():
                    held[key] = [merged(parts)]
                size = sum(len(p[0][0]) for p in held.values())
                if size > HELD_GRAMS // 2:
                    yield from flush()
                    size = 0
    if held:
        yield from flush()


Profiles = dict[str, list[int]]


def learn(labelled: DataFrame, *, text: str = "text", lang: str = "lang", profile_size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of all languages of the labelled rows, n-grams by falling frequency (ties by number).

    Rows with a NULL label or without letters teach nothing; repeated rows count each. No rows, no profiles.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counted = in_batches(rows.filter("lang is not null and text is not null")).mapInArrow(_count, "lang string, gram long, n long")
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = (
        counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= profile_size)
    )
    found = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("best"))
    rows = found.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the labels do not look like languages")
    return {r["lang"]: [x["gram"] for x in r["best"]] for r in sorted(rows, key=lambda r: r["lang"])}


def _predictor(profiles: Profiles, size: int):
    names = sorted(profiles)
    values = np.unique(np.array([g for n in names for g in profiles[n]], np.uint64))
    ranks = np.full((len(values) + 1, len(names)), -1, np.int32)
    for column, name in enumerate(names):
        ranks[np.searchsorted(values, np.array(profiles[name], np.uint64)), column] = np.arange(len(profiles[name]))

    def one(text: str | None) -> tuple[str, float]:
        found = grams(text)[0][:size]
        if not len(found):
            return UNKNOWN, 0.0
        if not names:
            return UNKNOWN, 0.0
        at = np.searchsorted(values, found)
        at = np.where((at < len(values)) & (values[np.minimum(at, len(values) - 1)] == found), at, len(values))
        known = ranks[at]
        place = np.arange(len(found), dtype=np.int32)[:, None]
        apart = np.where(known < 0, size, np.abs(known - place)).sum(axis=0)
        best = int(np.argmin(apart))
        return names[best], float(1 - apart[best] / (size * len(found)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return predict


def identify(
    documents: DataFrame, profiles: Profiles, *, text: str = "text", keep: list[str] | None = None,
    profile_size: int = PROFILE_SIZE,
) -> DataFrame:
    """The columns `keep` (default: all) with `lang_pred` and `score` (0 to 1: how well the order fits).

    A NULL text and one without letters are `und` with score 0, and so is every text if there are no profiles.
    Ties go to the name that sorts first. Equal texts are judged alike, whatever their other columns hold; columns named like
    the results are replaced.
    """
    own = {"lang_pred", "score", "_read"}
    names = [c for c in (keep or documents.columns) if c.lower() not in own]
    read = documents.select(*[F.col(f"`{c}`") for c in names], F.col(text).cast("string").alias("_read"))
    from pyspark.sql import types as T

    schema = T.StructType([*read.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return in_batches(read).mapInArrow(_predictor(profiles, profile_size), schema)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: a fifth of the ids, by checksum. A NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
