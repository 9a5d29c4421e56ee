"""The raw zone: JSON documents and whole files under season=<Y>/<endpoint>/.

The same readers serve streams and batches. Two forms of the zone are understood:

* in place: a changed document overwrites its file. A file stream never reads a path twice, so
  changed documents are taken by `snapshot`, which uses the file's modification time as sequence.
* pulls: every pull lands under its own pull=<n>/ folder. All files are new, so a stream sees each
  of them once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from gridledger.functions.parsing import (
    document_from_path, numbers, pull_from_path, season_from_path, week_from_path,
)
from gridledger.schemas import BINARY_FILE, ENDPOINTS, Endpoint

ROOT_SETTING = "gridledger.raw_root"
CORRUPT = "_corrupt_record"


def raw_root(spark: SparkSession, root: str | None = None) -> str:
    """The given root, else the session setting."""
    found = root or spark.conf.get(ROOT_SETTING, None)
    if not found:
        raise ValueError(f"give a raw root or set {ROOT_SETTING}")
    return found


def with_audit(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Add `_source_file`, `_ingest_ts`, `_file_ts` and `season` to rows of a file source."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        path.alias("_source_file"),
        (F.current_timestamp() if ingest_ts is None else ingest_ts).alias("_ingest_ts"),
        F.col("_metadata.file_modification_time").alias("_file_ts"),
        season_from_path(path).alias("season"),
    )


def read_blobs(
    spark: SparkSession, glob: str, text: str, streaming: bool = True, snapshot: bool = False
) -> DataFrame:
    """One row per file: its content as text, `season` and `week` from the path, and audit columns."""
    reader = spark.readStream if streaming else spark.read
    files = reader.format("binaryFile").schema(BINARY_FILE).load(glob)
    ingested = F.col("modificationTime") if snapshot else F.current_timestamp()
    return files.select(
        F.decode("content", "utf-8").alias(text),
        season_from_path(F.col("path")).alias("season"),
        week_from_path(F.col("path")).alias("week"),
        F.lit(text.removesuffix("_json")).alias("_key"),
        F.col("path").alias("_source_file"),
        ingested.alias("_ingest_ts"),
        F.col("modificationTime").alias("_file_ts"),
    )


def _documents(spark: SparkSession, root: str, name: str, streaming: bool, pulls: bool) -> tuple[DataFrame, StructType]:
    """Rows of the JSON files of an endpoint, with `_corrupt_record`, and the declared schema. Values of maps are read
    as text and cast one by one, so that a single odd value does not void the map it is in."""
    endpoint = ENDPOINTS[name]
    declared = StructType.fromDDL(endpoint.schema)
    as_text = MapType(StringType(), StringType())
    read = StructType([
        *(StructField(f.name, as_text if isinstance(f.dataType, MapType) else f.dataType) for f in declared),
        StructField(CORRUPT, StringType()),
    ])
    reader = (spark.readStream if streaming else spark.read).option("multiLine", True)
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(read).format("json")
    return rows.load(f"{root}/{endpoint.glob(pulls)}"), declared


def _nothing_read(declared: StructType) -> Column:
    """A document that could not be parsed: its text is kept and no column has a value."""
    lost = F.col(CORRUPT).isNotNull()
    for name in declared.names:
        lost = lost & F.col(name).isNull()
    return lost


def read_endpoint(
    spark: SparkSession,
    root: str,
    name: str,
    streaming: bool = True,
    pulls: bool = False,
    infer: bool = False,
    snapshot: bool = False,
) -> DataFrame:
    """Rows of one endpoint with audit columns. `infer` (batch only) takes types from the files. Of pulls also `_pull` and
    `_document`, the file's path below its pull.

    A document that is no JSON gives no row here; `unreadable_documents` has it.
    """
    rows = _read(spark, root, name, streaming, pulls, infer, snapshot)
    if not pulls:
        return rows
    path = F.col("_source_file")
    return rows.withColumns({"_pull": pull_from_path(path), "_document": document_from_path(path)})


def _read(
    spark: SparkSession, root: str, name: str, streaming: bool, pulls: bool, infer: bool, snapshot: bool
) -> DataFrame:
    endpoint: Endpoint = ENDPOINTS[name]
    if endpoint.schema is None:
        return read_blobs(spark, f"{root}/{endpoint.glob(pulls)}", endpoint.text_column, streaming, snapshot)
    ingested = F.col("_metadata.file_modification_time") if snapshot else None
    if infer:
        if streaming:
            raise ValueError("a stream needs a schema; inference works on batches")
        return with_audit(spark.read.option("multiLine", True).json(f"{root}/{endpoint.glob(pulls)}"), ingested)
    rows, declared = _documents(spark, root, name, streaming, pulls)
    audited = with_audit(rows, ingested).filter(~_nothing_read(declared))
    return audited.select(*[
        numbers(F.col(f.name), f.dataType.valueType.simpleString()).alias(f.name) if isinstance(f.dataType, MapType)
        else F.col(f.name)
        for f in declared
    ], *[c for c in audited.columns if c not in (*declared.names, CORRUPT)])


def unreadable_documents(
    spark: SparkSession, root: str, name: str, streaming: bool = False, pulls: bool = False
) -> DataFrame:
    """Documents of a JSON endpoint that could not be parsed: text, path, times and season."""
    rows, declared = _documents(spark, root, name, streaming, pulls)
    return with_audit(rows).filter(_nothing_read(declared)).drop(*declared.names)


def snapshot(spark: SparkSession, root: str, name: str, **options) -> DataFrame:
    """Every file of an endpoint as it is now, sequenced by modification time."""
    return read_endpoint(spark, root, name, streaming=False, snapshot=True, **options)
