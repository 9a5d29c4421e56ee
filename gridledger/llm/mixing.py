"""Mixing sources to target weights by exponential keys (Efraimidis and Spirakis).

A document's key is -ln(u) / w with u from a hash of its id and w its quality weight; the smallest keys
of a source are a weighted sample without replacement. A source gets a target in words. As many complete
epochs as fit come first; the rest of the target is filled in the order of the keys, up to the cut where
the prefix sum of sizes comes nearest to it.

No source is sorted as a whole: the keys of a source with n documents are dealt into about sqrt(n)
slices along their order. A prefix sum over slice totals finds the slice that holds the cut, and a prefix sum inside
that slice finds the cut, so a window holds about sqrt(n) rows. Equal keys (repeated rows) are added up
first and stand or fall together. Targets come from one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridledger.llm.common import count_chars, n_words, without
from gridledger.operators.session import durable

SEED = "mix"
SOURCE_WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SYMBOLS = "#*$%&|<>"
OWN = ("mix_group", "mix_size", "mix_key")


def quality_weight(text: Column, size: Column) -> Column:
    """Share of the words in words and symbols together: prose weighs 1, symbol junk less; at least 1 word counts."""
    return (size + 1) / (size + 1 + count_chars(F.coalesce(text, F.lit("")), SYMBOLS))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the key: 52 bits of its digest. NULL has one too."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def keyed(
    documents: DataFrame, *, doc_id: str, text: str, source: str, weight: Column | None, seed: str
) -> DataFrame:
    """The documents with their group (source, NULL as a group of its own), size and key."""
    plain = without(documents, OWN)
    group = F.struct(F.col(source).isNull().alias("none"), F.col(source).cast("string").alias("name"))
    sized = plain.withColumn("mix_group", group).withColumn("mix_size", n_words(F.col(text)))
    heavy = quality_weight(F.col(text), F.col("mix_size")) if weight is None else weight
    return sized.withColumn("mix_key", -F.ln(uniform(F.col(doc_id), seed)) / heavy)


def targets(sizes: DataFrame, weights: Sequence[float], most: int, total: Column | None = None) -> DataFrame:
    """Targets of the sources (mix_group, source_size): shares by weight, at most `most` times the size.

    Sources in order of code points, NULL last, weigh `weights` over and over. They share `total`
    (default: all sizes). What a source cannot take is shared again by weight, until none is above
    its limit: the sources with the lowest limit per weight are full first, so one pass in that order
    finds them.
    """
    everything = W.partitionBy()
    ranked = sizes.withColumn("_rank", F.row_number().over(everything.orderBy("mix_group")) - 1)
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    limits = ranked.select(
        "mix_group", "source_size", weigh.alias("_w"), (F.col("source_size") * F.lit(float(most))).alias("_cap"),
        F.coalesce(total or F.sum("source_size").over(everything), F.lit(0)).cast("double").alias("_total"),
    )
    by_level = everything.orderBy(F.col("_cap") / F.col("_w"), "mix_group")
    before = F.coalesce(F.sum("_cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_w").over(by_level.rowsBetween(W.currentRow, W.unboundedFollowing))
    full = limits.withColumn("_full", F.col("_cap") * left <= (F.col("_total") - before) * F.col("_w"))
    taken = F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_w")).otherwise(0.0)).over(everything)
    share = (F.col("_total") - taken) * F.col("_w") / open_weight
    return full.select("mix_group", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(share).alias("target"))


def cuts(rows: DataFrame, weights: Sequence[float], most: int, total: Column | None = None) -> DataFrame:
    """Per source: size, target, complete epochs, and where the order of keys is cut for the rest.

    `rows` has mix_group, mix_size, mix_key and is read more than once.
    """
    sources = durable(rows.groupBy("mix_group").agg(
        F.sum("mix_size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
    ))
    budget = targets(sources.select("mix_group", "source_size"), weights, most, total).select(
        "*", F.coalesce(F.floor(F.col("target") / F.expr("nullif(source_size, 0)")), F.lit(0)).alias("_epochs")
    )
    # Rounding never leaves a sliver of a further epoch to a source that is full.
    budget = durable(budget.select(
        "*", F.when(F.col("_epochs") >= most, 0.0).otherwise(
            F.col("target") - F.col("_epochs") * F.col("source_size")).alias("_rest")
    ))
    slices = sources.select("mix_group", F.ceil(F.sqrt("_rows")).alias("_slices"))
    # 1 - exp(-key) rises with the key and is spread over (0, 1).
    place = F.least(F.floor((1 - F.exp(-F.col("mix_key"))) * F.col("_slices")), F.col("_slices") - 1)
    dealt = rows.join(slices, "mix_group").select("mix_group", "mix_key", "mix_size", place.alias("_slice"))
    upto = W.partitionBy("mix_group").orderBy("_slice")
    found = (
        dealt.groupBy("mix_group", "_slice").agg(F.sum("mix_size").alias("_words"))
        .withColumn("_before", F.sum("_words").over(upto) - F.col("_words"))
        .join(budget.select("mix_group", "_rest"), "mix_group")
        .filter((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_words")))
        .select("mix_group", "_slice", "_before", "_rest")
    )
    inside = W.partitionBy("mix_group").orderBy("mix_key")
    last = (
        dealt.join(found, ["mix_group", "_slice"])
        .groupBy("mix_group", "_slice", "_before", "_rest", "mix_key").agg(F.sum("mix_size").alias("_words"))
        .withColumn("_upto", F.col("_before") + F.sum("_words").over(inside) - F.col("_words"))
        .filter(F.col("_upto") + F.col("_words") / 2 <= F.col("_rest"))
        .groupBy("mix_group").agg(F.max("mix_key").alias("_last"))
    )
    return durable(
        budget.join(slices, "mix_group")
        .join(found.select("mix_group", F.col("_slice").alias("_cut")), "mix_group", "left")
        .join(last, "mix_group", "left")
    )


def copies(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Rows with the source's figures and `copies`, how often the mix takes the document."""
    place = F.least(F.floor((1 - F.exp(-F.col("mix_key"))) * F.col("_slices")), F.col("_slices") - 1)
    more = F.coalesce((place < F.col("_cut")) | (F.col("mix_key") <= F.col("_last")), F.lit(False))
    return rows.join(cut, "mix_group").withColumn("copies", (F.col("_epochs") + more.cast("long")).cast("int"))


def mix_sizes(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weight: Column | None = None, weights: Sequence[float] = SOURCE_WEIGHTS, most: int = MAX_EPOCHS,
    total: Column | None = None, seed: str = SEED,
) -> DataFrame:
    """The plan of a mix without texts: `doc_id`, size, source_size, target, taken (words), copies.

    Texts are read once. NULL texts have size 0 and are taken 0 words; NULL sources are one source, the
    last; NULL ids share one key per source; repeated rows are taken alike; an empty table gives an empty plan.
    """
    rows = durable(
        keyed(documents, doc_id=doc_id, text=text, source=source, weight=weight, seed=seed)
        .select(F.col(doc_id), *OWN)
    )
    planned = copies(rows, cuts(rows, weights, most, total))
    return planned.select(
        F.col(doc_id), F.col("mix_size").alias("size"), "source_size", "target",
        (F.col("mix_size") * F.col("copies")).alias("taken"), "copies",
    )


def mix(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weight: Column | None = None, weights: Sequence[float] = SOURCE_WEIGHTS, most: int = MAX_EPOCHS,
    total: Column | None = None, seed: str = SEED,
) -> DataFrame:
    """The mix itself: the documents' own columns, a row for each time a document is taken.

    Columns named like the operator's own (`OWN`) are left out. A text without words weighs nothing: it
    is repeated with the complete epochs of its source.
    """
    rows = keyed(documents, doc_id=doc_id, text=text, source=source, weight=weight, seed=seed)
    slim = durable(rows.select(*OWN))
    cut = cuts(slim, weights, most, total).select("mix_group", "_epochs", "_slices", "_cut", "_last")
    taken = copies(rows, cut).filter(F.col("copies") > 0)
    columns = [F.col(f"`{c}`") for c in without(documents, OWN).columns]
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
