"""Small helpers of the operators: safe selections, a let-binding for columns, word patterns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters that are none of these.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns whose names the operator uses itself (case does not count)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once per row: inside a lambda a column is computed per element."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of a text are among `chars`."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows and bytes that go to a Python worker at a time, so that its memory does not depend on the length of texts.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def in_batches(df: DataFrame) -> DataFrame:
    """The same rows, for a step in Python: the session's Arrow batches are made small enough for whole texts."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def give_back() -> None:
    """Return memory that is freed already to the system: a Python worker outlives its tasks, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
