"""Change data capture over any DataFrame of changes: latest state and version history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridledger.operators.joins import join_same
from gridledger.operators.slices import RATE, cuts_of, in_cut_groups, with_slices

START, END = "__START_AT", "__END_AT"


def scd1(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Latest row per key by `sequence`; later columns of the sequence break ties.

    The rank filter becomes a group limit that runs before the shuffle, so a key with very many
    changes sends one row per task.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in sequence])
    return (
        changes.withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") == 1)
        .drop("_age")
    )


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    tiebreak: Sequence[str] = (),
    rate: int = RATE,
) -> DataFrame:
    """One row per key and period of unchanged `tracked` values: keys, tracked, start, end.

    Changes are placed by `sequence`, not by arrival. Of several changes with one sequence value
    the last by `tiebreak` counts (then by the tracked values). Repeats are collapsed. An open
    period ends with NULL. Changes of a key are cut into slices along the sequence, so a key may
    have any number of them; all windows run inside a slice, on one shuffle, and a table with one
    row per slice carries values across the cuts.
    """
    keys, tracked = list(keys), list(tracked)
    named = dict.fromkeys([*keys, *tracked, *tiebreak])
    steps = changes.select(*named, F.col(sequence).alias("_seq"))
    sliced = with_slices(steps, keys, "_seq", cuts_of(steps, keys, "_seq", rate))
    newest = W.partitionBy(*keys, "_slice", "_seq").orderBy(*[F.desc(c) for c in [*tiebreak, *tracked]])
    one_per_step = sliced.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") == 1)
    rows = one_per_step.select(*keys, "_slice", "_seq", F.struct(*tracked).alias("_now"))
    inside = W.partitionBy(*keys, "_slice").orderBy("_seq")
    slices = W.partitionBy(*keys).orderBy("_slice")
    of_slice = [*keys, "_slice"]

    # The first row of a slice is compared with the state at the end of the slice before.
    ends = in_cut_groups(rows).groupBy(*of_slice).agg(F.max_by("_now", "_seq").alias("_last"))
    carried = ends.select(*of_slice, F.lag("_last").over(slices).alias("_carried"))
    compared = join_same(rows.withColumn("_before", F.lag("_now").over(inside)), carried, of_slice)
    starts = compared.filter(~F.col("_now").eqNullSafe(F.coalesce("_before", "_carried"))).select(*rows.columns)

    # The last start of a slice ends with the first start of the slices after.
    heads = in_cut_groups(starts).groupBy(*of_slice).agg(F.min("_seq").alias("_head"))
    following = heads.select(*of_slice, F.lead("_head").over(slices).alias("_following"))
    ended = join_same(starts.withColumn("_next", F.lead("_seq").over(inside)), following, of_slice)
    return ended.select(
        *keys,
        *[F.col(f"_now.{c}").alias(c) for c in tracked],
        F.col("_seq").alias(START),
        F.coalesce("_next", "_following").alias(END),
    )


def current(history: DataFrame) -> DataFrame:
    """The open periods of a version history."""
    return history.filter(F.col(END).isNull())
