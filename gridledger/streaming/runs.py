"""Streams that process what is there and stop."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridledger.operators.quality import watch

RULE_COUNTS = "rule string, rows bigint, violations bigint"


def run_available(stream: DataFrame, checkpoint: str, fold) -> StreamingQuery:
    """Hand what is there to `fold(batch, batch_id)` in micro-batches, then stop."""
    started = (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new rows exactly once, then stop."""
    started = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def append_checked(stream: DataFrame, path: str, checkpoint: str, rules: dict[str, str]) -> StreamingQuery:
    """Append new rows, all of them, and per micro-batch how many violate each rule. Then stop.

    The rows are counted by the job that writes them. Rows and counts of a micro-batch have a folder of its number, so a batch
    that is run again replaces both.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        watched, seen = watch(batch, rules)
        watched.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        counts = [(rule, seen.get["rows"], seen.get[rule]) for rule in rules]
        stored = batch.sparkSession.createDataFrame(counts, RULE_COUNTS).coalesce(1)
        stored.write.mode("overwrite").parquet(f"{path}/rules/batch={batch_id}")

    return run_available(stream, checkpoint, fold)


def rule_counts(spark: SparkSession, path: str) -> DataFrame:
    """`batch`, `rule`, `rows`, `violations` of every micro-batch of `append_checked`."""
    return read_if_there(spark, f"{path}/rules", f"{RULE_COUNTS}, batch bigint")


def read_if_there(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet rows under the path; none when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
