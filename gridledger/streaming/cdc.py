"""Latest state and version history kept up to date by a stream, in Spark's own state store.

A stream is an aggregate: the newest change per key. Spark keeps it on the executors in RocksDB, uploads what a micro-batch has
changed with the checkpoint, and restores a lost executor's part from there. A micro-batch reads and writes its own keys and no
others, a batch that dies is run again, and a change that arrives twice or late changes nothing that is newer. The result is
read from the checkpoint through the `statestore` source.

For a version history the key is (key, sequence), so the state is the set of changes, each in its place however late it came;
the periods are a window over it (`operators.cdc.scd2`), computed when the history is read.

The number of state partitions is `spark.sql.shuffle.partitions` when a stream first runs, and stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridledger.operators.cdc import scd2

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def latest_stream(stream: DataFrame, checkpoint: str, keys: Sequence[str], sequence: Sequence[str]) -> StreamingQuery:
    """Fold what is there into the latest row per key, then stop. Later columns of the sequence break ties; of rows that are
    equal in all of them any one is kept."""
    row = F.struct(*stream.columns)
    latest = stream.groupBy(*keys).agg(F.max_by(row, F.struct(*sequence)).alias("row"))
    spark = stream.sparkSession
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        started = (
            latest.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    started.awaitTermination()
    return started


def read_latest(spark: SparkSession, checkpoint: str, schema: StructType) -> DataFrame:
    """The latest rows as of the last finished micro-batch; none before the first."""
    try:
        state = spark.read.format("statestore").load(checkpoint)
    except PySparkException as error:
        if error.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], schema)
    newest = state.schema["value"].dataType.names[0]  # the row; what it was chosen by comes after it
    return state.select(F.col(f"value.{newest}").alias("row")).select("row.*")


def change_stream(
    stream: DataFrame, checkpoint: str, keys: Sequence[str], sequence: str, tracked: Sequence[str], tiebreak: Sequence[str] = ()
) -> StreamingQuery:
    """Fold what is there into the changes of a version history: of one key and sequence value the last by `tiebreak`,
    then by the tracked values."""
    changes = stream.select(*dict.fromkeys([*keys, sequence, *tracked, *tiebreak]))
    return latest_stream(changes, checkpoint, [*keys, sequence], [*tiebreak, *tracked])


def read_changes(
    spark: SparkSession, checkpoint: str, schema: StructType, keys: Sequence[str], sequence: str, tracked: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    columns = dict.fromkeys([*keys, sequence, *tracked, *tiebreak])
    return read_latest(spark, checkpoint, StructType([schema[c] for c in columns]))


def history(
    spark: SparkSession, checkpoint: str, schema: StructType, keys: Sequence[str], sequence: str, tracked: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The periods per key over all changes folded so far."""
    changes = read_changes(spark, checkpoint, schema, keys, sequence, tracked, tiebreak)
    return scd2(changes, keys, sequence, tracked, tiebreak)
