"""Session settings the plans count on, and reliable materialization."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: they can be applied to a session that already exists.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split the oversized partition of a hot join key, even where the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints. A local master may do without; executors of a cluster would each
    write to a disk of their own, so there its absence is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="gridledger-")


def workspace(spark: SparkSession) -> str:
    """A new folder for one run under the shared folder."""
    return f"{shared_folder(spark)}/gridledger/{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared folder and read them from there.

    They are computed once, are not lost with an executor, and come back with their size known and
    their columns prunable.
    """
    spark = df.sparkSession
    path = workspace(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
