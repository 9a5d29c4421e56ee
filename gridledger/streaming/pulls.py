"""Bronze tables of a zone that is pulled again and again.

Every pull lands all documents anew under its own pull=<n>/ folder, changed or not. So the tables are made of two streams per
endpoint, both append-only and both safe to repeat:

* the version index: one row per landed document, with the digest of its content;
* the rows of documents whose content is new: a batch is joined with the index, and what an earlier pull has brought with the
  same content is not written again.

A table is read as of the newest pull: of every document the rows that came when its present content was first seen.
Documents that the newest pull does not have any more are gone, without a deletion. Equal pulls change nothing, and any number
of pulls leaves what a single one, the newest, would leave. Index rows grow with files, not with what is in them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridledger.functions.parsing import document_from_path, pull_from_path
from gridledger.operators.cdc import scd1
from gridledger.schemas import BINARY_FILE, ENDPOINTS, SEQUENCE
from gridledger.sources.raw import read_endpoint
from gridledger.streaming.runs import append_stream, read_if_there, run_available

INDEX = "document string, pull bigint, digest string"


def index_path(out: str, name: str) -> str:
    return f"{out}/_versions/endpoint={name}"


def table_path(out: str, name: str) -> str:
    return f"{out}/bronze_{name}"


def index_documents(spark: SparkSession, root: str, out: str, name: str) -> None:
    """Add the documents landed since the last call to the version index of the endpoint."""
    files = spark.readStream.format("binaryFile").schema(BINARY_FILE).load(f"{root}/{ENDPOINTS[name].glob(pulls=True)}")
    seen = files.select(
        document_from_path(F.col("path")).alias("document"),
        pull_from_path(F.col("path")).alias("pull"),
        F.sha2("content", 256).alias("digest"),
    )
    append_stream(seen, index_path(out, name), f"{out}/_streams/versions_{name}")


def versions(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The index with `is_new`: whether the document's content differs from that of its pull before."""
    found = read_if_there(spark, index_path(out, name), INDEX)
    before = F.lag("digest").over(W.partitionBy("document").orderBy("pull"))
    return found.withColumn("is_new", ~F.col("digest").eqNullSafe(before))


def newest_pull(spark: SparkSession, out: str) -> DataFrame:
    """The number of the newest pull that any endpoint's index knows."""
    parts = [read_if_there(spark, index_path(out, name), INDEX).select("pull") for name in ENDPOINTS]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.agg(F.max("pull"))


def present(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Documents of the newest pull, each with the pull that first brought its present content."""
    return (
        versions(spark, out, name).groupBy("document")
        .agg(F.max("pull").alias("seen"), F.max(F.when(F.col("is_new"), F.col("pull"))).alias("pull"))
        .filter(F.col("seen") == newest_pull(spark, out).scalar())
        .select("document", "pull")
    )


def append_changed(spark: SparkSession, root: str, out: str, name: str) -> None:
    """Write the rows of documents landed since the last call, but for those whose content is known already.

    A batch that is run again overwrites its own folder. A document that the index does not know yet is written.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        known = versions(batch.sparkSession, out, name).filter(~F.col("is_new")).select(
            F.col("document").alias("_document"), F.col("pull").alias("_pull")
        )
        rows = batch.join(known, ["_document", "_pull"], "left_anti").select(*batch.columns)
        rows.write.mode("overwrite").parquet(f"{table_path(out, name)}/batch={batch_id}")

    run_available(read_endpoint(spark, root, name, pulls=True), f"{out}/_streams/{name}", fold)


def read_pulled(spark: SparkSession, root: str, out: str, name: str) -> DataFrame:
    """The rows of an endpoint as of the newest pull; of keyed endpoints the latest row per key."""
    endpoint = ENDPOINTS[name]
    schema = StructType([*read_endpoint(spark, root, name, pulls=True).schema])
    rows = read_if_there(spark, table_path(out, name), schema).select(*schema.names)
    at = present(spark, out, name).select(F.col("document").alias("_document"), F.col("pull").alias("_pull"))
    kept = rows.join(at, ["_document", "_pull"], "left_semi")
    if endpoint.mode == "scd1":
        kept = scd1(kept, endpoint.keys, SEQUENCE)
    return kept.select(*[c for c in schema.names if c not in ("_document", "_pull")])


def ingest_pulls(spark: SparkSession, root: str, out: str, names: Iterable[str] = ENDPOINTS) -> dict[str, DataFrame]:
    """Bring index and tables up to date with the pulls that have landed completely, and return the tables.

    All documents are indexed first: a document counts as gone when the newest pull of any endpoint lacks it.
    """
    names = list(names)
    for name in names:
        index_documents(spark, root, out, name)
    for name in names:
        append_changed(spark, root, out, name)
    return {f"bronze_{name}": read_pulled(spark, root, out, name) for name in names}
