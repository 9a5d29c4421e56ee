"""Landing documents, the manifest of a pull, and the check of what was landed against it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridledger.functions.parsing import season_from_path
from gridledger.schemas import MANIFEST


def _uri(path: str) -> str:
    return path if "://" in path else Path(path).absolute().as_uri()


def write_documents(documents: DataFrame, root: str) -> None:
    """Land every row (`path`, `text`) as a file of its own under the root. The executors write them.

    A file appears whole: it is written under a name that Spark's sources do not see, then moved. A task that is run again
    writes the same files again.
    """
    uri = _uri(root)

    def write(rows: Iterator[Row]) -> None:
        files, base = FileSystem.from_uri(uri)
        for row in rows:
            folder = f"{base}/{row.path}".rpartition("/")[0]
            files.create_dir(folder, recursive=True)
            hidden = f"{folder}/_{uuid.uuid4().hex}"
            with files.open_output_stream(hidden) as out:
                out.write(row.text.encode("utf-8"))
            files.move(hidden, f"{base}/{row.path}")

    documents.select("path", "text").foreachPartition(write)


def build_manifest(bronze: dict[str, DataFrame]) -> DataFrame:
    """Per season: files, weeks with matchups, weeks with transactions, transactions, picks, stat weeks.

    `bronze` maps endpoint names to rows with `season` and `_source_file`. Each endpoint is reduced
    to a row per file before the counts are combined. A transaction that stands in several rows of its
    file is one.
    """
    parts = []
    for name, df in bronze.items():
        rows = F.countDistinct("transaction_id") if "transaction_id" in df.columns else F.count(F.lit(1))
        per_file = df.groupBy("season", "_source_file").agg(rows.alias("n"))
        parts.append(per_file.select("season", F.lit(name).alias("endpoint"), "n"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)

    def of(endpoint: str, counted=None):
        here = F.col("endpoint") == endpoint
        value = F.count_if(here) if counted is None else F.sum(F.when(here, counted).otherwise(0))
        return value.cast("int")

    return union.filter(F.col("season").isNotNull()).groupBy("season").agg(
        F.count(F.lit(1)).cast("int").alias("files"),
        of("matchups").alias("matchup_weeks"),
        of("transactions").alias("transaction_weeks"),
        of("transactions", F.col("n")).alias("transactions"),
        of("draft_picks", F.col("n")).alias("draft_picks"),
        of("player_stats").alias("stat_weeks"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a manifest document, one per season.

    Spark's file sources skip names that begin with an underscore, and the manifest's does. It holds
    one line per season, so it is opened here and handed over as one value.
    """
    filesystem, name = FileSystem.from_uri(_uri(path))
    with filesystem.open_input_stream(name) as stream:
        text = stream.read().decode("utf-8")
    document = spark.createDataFrame([(text,)], "text string")
    return document.select(F.inline(F.from_json("text", MANIFEST)["seasons"]))


def landing_check(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Files found per season against the manifest; one row with season NULL is the total of both.

    Only paths are read, not contents. A season on one side only is a mismatch.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json").load(root).select("path")
    )
    found = (
        files.select(season_from_path(F.col("path")).alias("season"))
        .filter(F.col("season").isNotNull())
        .groupBy("season").agg(F.count(F.lit(1)).cast("int").alias("landed"))
    )
    expected = manifest.select("season", F.col("files").alias("expected"))
    seasons = found.join(expected, "season", "full_outer").select("season", "expected", "landed")
    total = seasons.agg(
        F.lit(None).cast("string").alias("season"),
        F.sum("expected").cast("int").alias("expected"),
        F.sum("landed").cast("int").alias("landed"),
    )
    return seasons.unionByName(total).withColumn("ok", F.col("expected").eqNullSafe(F.col("landed")))


# -- by content ---------------------------------------------------------------------------------

#: path below the root, bytes, SHA-256 of the content
CONTENT = ("path", "bytes", "digest")


def content_of_documents(documents: DataFrame) -> DataFrame:
    """What (`path`, `text`) documents are when they are landed whole: the manifest of their content."""
    content = F.encode("text", "utf-8")
    return documents.select("path", F.octet_length("text").cast("bigint").alias("bytes"), F.sha2(content, 256).alias("digest"))


def content_of_files(spark: SparkSession, root: str) -> DataFrame:
    """The content of every JSON file below the root, files outside of seasons included. Spark's sources pass over files
    without any bytes, so an empty file is one that is missing."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json").load(root)
    )
    below = F.regexp_extract("path", rf"^.*/\Q{root.rstrip('/').rpartition('/')[2]}\E/(.*)$", 1)
    return files.select(below.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("digest"))


def multiset_digests(content: DataFrame) -> DataFrame:
    """Per season, and for files outside of seasons under NULL: files, bytes, and a digest of their contents that depends on
    neither their order nor their names. Equal files count as often as they are there."""
    number = F.conv(F.substring("digest", 1, 15), 16, 10).cast("decimal(38,0)")
    return content.groupBy(season_from_path(F.concat(F.lit("/"), "path")).alias("season")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum(number).alias("digest"),
    )


def digest_check(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Season by season, files outside of seasons too: files, bytes and digest on both sides, and whether all agree."""
    named = [F.col("season").alias("_season"), *[F.col(c).alias(f"expected_{c}") for c in ("files", "bytes", "digest")]]
    there, wanted = multiset_digests(landed), multiset_digests(expected).select(*named)
    both = there.join(wanted, F.col("season").eqNullSafe(F.col("_season")), "full_outer")
    return both.select(
        F.coalesce("season", "_season").alias("season"), "files", "expected_files", "bytes", "expected_bytes",
        (F.col("digest").eqNullSafe(F.col("expected_digest")) & F.col("files").eqNullSafe(F.col("expected_files"))).alias("ok"),
    )


def landing_differences(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """`path` and `difference` of every file that is not as expected.

    * truncated, changed: at its place with fewer bytes, with others;
    * renamed: content expected at a path that has nothing; doubled: content that is at its place, too; unexpected: neither;
    * missing: nothing or an empty file at the path, and its content nowhere else.

    Files are joined by path and by digest; a content that very many files share counts once per side before it is joined.
    """
    wanted = expected.select(*[F.col(c).alias(f"_{c}") for c in CONTENT])
    both = landed.join(wanted, F.col("path") == F.col("_path"), "full_outer")
    here = F.col("path").isNotNull() & F.col("_path").isNotNull()
    changed = both.filter(here & (F.col("digest") != F.col("_digest"))).select(
        "path",
        F.when(F.col("bytes") < F.col("_bytes"), "truncated").otherwise("changed").alias("difference"),
    )
    gone = both.filter(F.col("path").isNull()).select(F.col("_path").alias("path"), F.col("_digest").alias("digest"))
    extra = both.filter(F.col("_path").isNull()).select("path", "digest")
    lost, known, moved = (df.select("digest").distinct() for df in (gone, expected, extra))
    flagged = (
        extra.join(lost.withColumn("lost", F.lit(True)), "digest", "left")
        .join(known.withColumn("known", F.lit(True)), "digest", "left")
    )
    added = flagged.select(
        "path", F.when(F.col("lost"), "renamed").when(F.col("known"), "doubled")
        .otherwise("unexpected").alias("difference"),
    )
    missing = gone.join(moved, "digest", "left_anti").select("path", F.lit("missing").alias("difference"))
    return changed.unionByName(added).unionByName(missing)
