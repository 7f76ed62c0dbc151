"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import scratch_path

# A key column with at most this many rows is broadcast (8-byte keys: 8 MB); above it the
# same join is shuffled.
BROADCAST_ROWS = 1_000_000

# Rows of an Arrow batch: whole texts pass through it, on both sides of the pipe at once.
BATCH_ROWS, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it. On a cluster
    the package is deployed with the job (--py-files), and this adds nothing."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


def in_arrow(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """`df.mapInArrow`, with this package importable in the task. A batch of texts has
    ARROW_ROWS rows at most, unless the session asks for fewer or more."""
    spark = df.sparkSession
    importable(spark)
    if spark.conf.get(BATCH_ROWS) == "10000":  # Spark's default
        spark.conf.set(BATCH_ROWS, ARROW_ROWS)
    return df.mapInArrow(task, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it back: cuts the lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` (a written table of narrow rows) marked for broadcast when its row count is
    checked to be at most `rows`; otherwise unchanged, so that Spark shuffles the join."""
    return F.broadcast(df) if df.count() <= rows else df
