"""Placement on shards by a permutation-filled lookup table.

Every shard has its own order of the slots of a table of prime size. Shards take turns and claim their
next free slot, so each owns nearly the same number of slots, and few slots change hands when a shard
comes or goes. A document is placed by one lookup: nothing is shuffled, and a hot key cannot exist.
The table's size is a parameter, which bounds what is sent to the executors, whatever the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import without

TABLE_SIZE = 6553
SHARDS = tuple(f"shard-{i:02d}" for i in range(64))
OUTPUT = ("slot", "shard")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Owner of each slot, as a position in `shards`. Every shard needs a slot, so there are at most `size`."""
    if not is_prime(size):
        raise ValueError("the size of the table must be prime, or a shard's order would miss slots")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    digests = [hashlib.md5(s.encode()).hexdigest() for s in shards]
    offsets = [int(d[:8], 16) % size for d in digests]
    steps = [int(d[8:16], 16) % (size - 1) + 1 for d in digests]
    at, owner, free = [0] * len(shards), [-1] * size, size
    while True:
        for shard, step in enumerate(steps):
            slot = (offsets[shard] + at[shard] * step) % size
            while owner[slot] >= 0:
                at[shard] += 1
                slot = (offsets[shard] + at[shard] * step) % size
            owner[slot] = shard
            at[shard] += 1
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key by its digest; NULL is placed like the text 'null' under a mark of its own."""
    marked = F.coalesce(F.concat(F.lit("k:"), key.cast("string")), F.lit("null"))
    number = F.conv(F.substring(F.md5(marked.cast("binary")), 1, 15), 16, 10).cast("long")
    return F.pmod(number, F.lit(size)).cast("int")


def place(
    rows: DataFrame, key: Column, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE
) -> DataFrame:
    """The rows with `slot` and `shard`; columns of these names are replaced.

    Equal keys, repeated rows among them, go to one shard; NULL keys are one key. No key, text or
    other column needs to be present besides what `key` reads; an empty table stays empty.
    """
    owners = lookup_table(shards, size)
    # Literals both: Spark folds them once and ships them with the task, `size` numbers and the names.
    table = F.split(F.lit(",".join(map(str, owners))), ",").cast("array<int>")
    names = F.array(*[F.lit(s) for s in shards])
    placed = without(rows, OUTPUT).withColumn("slot", slot_of(key, size))
    return placed.withColumn("shard", F.get(names, F.get(table, F.col("slot"))))


def write_shards(placed: DataFrame, path: str, key: Column, pieces: int = 16) -> None:
    """Store the rows by shard. A shard is written by up to `pieces` tasks, so a full one is no bottleneck."""
    salt = F.pmod(F.xxhash64(key), F.lit(pieces))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)
