"""Bronze tables filled from the raw zone by streams that drain what is new and stop."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridledger.operators.cdc import scd1
from gridledger.plans import silver
from gridledger.schemas import ENDPOINTS, SEQUENCE
from gridledger.sources.raw import raw_root, read_endpoint, snapshot
from gridledger.streaming.cdc import change_stream, history, latest_stream, read_latest
from gridledger.streaming.pulls import ingest_pulls, table_path
from gridledger.streaming.runs import append_stream, read_if_there


def bronze_schema(spark: SparkSession, root: str, name: str) -> StructType:
    return StructType([*read_endpoint(spark, root, name).schema])


def stream_path(out: str, name: str) -> str:
    return f"{out}/_streams/{name}"


def run_endpoint(spark: SparkSession, root: str, out: str, name: str):
    """Bring the bronze table of one endpoint up to date with new files."""
    endpoint = ENDPOINTS[name]
    stream = read_endpoint(spark, root, name)
    if endpoint.mode == "scd1":
        return latest_stream(stream, stream_path(out, name), endpoint.keys, SEQUENCE)
    return append_stream(stream, table_path(out, name), stream_path(out, name))


def read_bronze(spark: SparkSession, root: str, out: str, name: str) -> DataFrame:
    schema = bronze_schema(spark, root, name)
    if ENDPOINTS[name].mode == "scd1":
        return read_latest(spark, stream_path(out, name), schema)
    return read_if_there(spark, table_path(out, name), schema)


def read_in_place(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The bronze rows of an endpoint whose documents are overwritten in place, which no file stream would see: every document
    as it is now, of keyed endpoints the row of the newest file per key. There is no state, so the read can be repeated."""
    endpoint = ENDPOINTS[name]
    rows = snapshot(spark, root, name)
    return scd1(rows, endpoint.keys, ["_file_ts", "_source_file"]) if endpoint.mode == "scd1" else rows


def ingest(
    spark: SparkSession, root: str | None, out: str, names: Iterable[str] = ENDPOINTS, pulls: bool = False
) -> dict[str, DataFrame]:
    """Bring the bronze tables up to date and return them. `pulls`: the zone holds every pull in a folder of its own."""
    root = raw_root(spark, root)
    if pulls:
        return ingest_pulls(spark, root, out, names)
    tables = {}
    for name in names:
        run_endpoint(spark, root, out, name)
        tables[f"bronze_{name}"] = read_bronze(spark, root, out, name)
    return tables


def run_dim_manager(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Keep the changes of manager names from the stream of the bronze users table, and return the history."""
    users = spark.readStream.schema(bronze_schema(spark, root, "users")).parquet(table_path(out, "users"))
    changes = silver.manager_changes(users)
    how = (silver.MANAGER_KEYS, silver.MANAGER_SEQUENCE, silver.MANAGER_TRACKED, silver.manager_tiebreak(users))
    checkpoint = stream_path(out, "dim_manager")
    change_stream(changes, checkpoint, *how)
    return history(spark, checkpoint, changes.schema, *how)
