"""Bring silver and gold datasets up to date from bronze tables: write, audit, publish.

A run writes every dataset once, into a folder of its own. While the rows are written their rules are counted, in the same
job. Only when all datasets are written and no `fail` rule is violated does the run's commit appear, and readers go by the
newest commit. A broken gate or a crash therefore leaves the version before as it is, whole and readable. The counts of every
run are kept, those of refused ones too.

    <out>/runs/<run>/<dataset>/   the rows of a run
    <out>/audits/run=<run>/       rule by rule: rows seen and violations
    <out>/commits/run=<run>/      the datasets of a run, written last, by one task and one rename
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.operators.quality import ExpectationError, keep_valid, watch
from gridledger.plans.registry import DATASETS, Dataset, Tables
from gridledger.streaming.runs import read_if_there

AUDIT = "dataset string, mode string, rule string, rows bigint, violations bigint"
COMMIT = "dataset string"


@dataclass
class Refreshed:
    run: str
    tables: dict[str, DataFrame]
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)


def run_id() -> str:
    """Later runs have greater ids."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write(spark: SparkSession, dataset: Dataset, df: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Write one dataset and read it back, with the counts of all its rules. A task that is run again after it was counted
    counts twice: violations may then be reported too high, never as none."""
    rules = {name: rule for of_mode in dataset.rules.values() for name, rule in of_mode.items()}
    watched, seen = watch(df, rules) if rules else (df, None)
    kept = keep_valid(watched, dataset.rules.get("drop", {}))
    writer = kept.write
    if dataset.partition_by:
        writer = writer.partitionBy(*dataset.partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get if seen else {}


def audit_rows(dataset: Dataset, seen: dict[str, int]) -> list[tuple]:
    return [
        (dataset.name, mode, rule, seen["rows"], seen[rule])
        for mode, rules in dataset.rules.items() for rule in rules
    ]


def _store(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def refresh(spark: SparkSession, bronze: Tables, out: str, names: Iterable[str] | None = None) -> Refreshed:
    """Build datasets in registry order (all, or the named ones) and publish them together.

    Later datasets read the written tables of earlier ones. After a broken gate only what other gates may read is still built,
    so that the audit is complete; then the run is refused.
    """
    run, wanted = run_id(), set(names) if names is not None else None
    done, audits, broken = Refreshed(run, dict(bronze)), [], {}
    for dataset in DATASETS:
        if dataset.build is None or (wanted is not None and dataset.name not in wanted):
            continue
        gate = dataset.rules.get("fail", {})
        if broken and dataset.layer == "gold" and not gate:
            continue
        built = dataset.build(done.tables)
        done.tables[dataset.name], seen = write(spark, dataset, built, f"{out}/runs/{run}/{dataset.name}")
        if seen:
            done.metrics[dataset.name] = seen
            audits += audit_rows(dataset, seen)
        broken |= {f"{dataset.name}.{rule}": seen[rule] for rule in gate if seen[rule]}
    _store(spark, audits, AUDIT, f"{out}/audits/run={run}")
    if broken:
        raise ExpectationError(f"run {run} is not published, rows violate {broken}")
    _store(spark, [(name,) for name in done.tables if name not in bronze], COMMIT, f"{out}/commits/run={run}")
    return done


def newest_run(spark: SparkSession, out: str) -> str | None:
    """The newest run that is published."""
    return read_if_there(spark, f"{out}/commits", f"{COMMIT}, run string").agg(F.max("run")).first()[0]


def published(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The datasets of the newest published run; none before the first."""
    run = newest_run(spark, out)
    if run is None:
        return {}
    names = read_if_there(spark, f"{out}/commits/run={run}", COMMIT).collect()
    return {r.dataset: spark.read.parquet(f"{out}/runs/{run}/{r.dataset}") for r in names}


def audits(spark: SparkSession, out: str) -> DataFrame:
    """The rule counts of all runs, and whether the run was published."""
    seen = read_if_there(spark, f"{out}/audits", f"{AUDIT}, run string")
    runs = read_if_there(spark, f"{out}/commits", f"{COMMIT}, run string").select("run").distinct()
    return seen.join(runs.withColumn("published", F.lit(True)), "run", "left").withColumn(
        "published", F.coalesce("published", F.lit(False))
    )
