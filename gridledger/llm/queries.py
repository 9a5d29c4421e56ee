"""The registered queries of the subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm import (
    ann, chat, html, jaccard, langid, lexical, mixing, packing, pii, quality, resampling, sharding, urlfilter,
)
from gridledger.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Stands for the secret that a deployment passes in.
DEMO_KEY = "public demonstration key"


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms for its personal data."""
    return pii.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), DEMO_KEY, count="n_replaced")


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's set of 4-word shingles and the class it is linked into."""
    return jaccard.classes(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, from profiles of the labelled documents that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"))
    profiles = langid.learn(documents.filter(~out))
    found = langid.identify(documents.withColumn("held_out", out), profiles, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, folder, "pages"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut into power-of-two pieces; the ids of a piece as a checksum."""
    pieces = packing.pack(table(spark, folder, "documents"), word_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of all sources takes of each document; sources weigh 1, 2, 3 and so on, at most 3 epochs."""
    return mixing.mix_sizes(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Slot and shard of every document among 64 shards, by its id."""
    return sharding.place(table(spark, folder, "documents").select("doc_id"), F.col("doc_id"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Features, votes and verdict on every document."""
    return quality.judge(table(spark, folder, "documents").select("doc_id", "text"))


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation repaired and rendered, a row per turn."""
    return chat.format_chats(table(spark, folder, "conversations"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item by weighted term frequencies."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    judged = urlfilter.judge(table(spark, folder, "pages"), keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict", "ratio")


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark's texts."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_pii": op2_pii,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_language_id": op4_language_id,
    "op5_html_extraction": op5_html_extraction,
    "op6_packing": op6_packing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_sharding": op8_sharding,
    "op9_quality": op9_quality,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_lexical_search": op11_lexical_search,
    "op12_url_filter": op12_url_filter,
    "op13_importance_resampling": op13_importance_resampling,
}
