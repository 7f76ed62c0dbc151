"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Mapping, Optional

from pyspark.sql import DataFrame, SparkSession

# Defaults for the plan; a deployment overrides any of them through `conf`.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions down to this size at least, not the 1 MB default: joins
    # that expand rows (friend candidates) are sized by their small inputs, and merging
    # those into a handful of partitions leaves the expansion to a few tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    # Runtime (exact, post-shuffle) size checks for join strategy: broadcast a join side
    # only when its materialised stage is below this size ...
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # ... and hash-join instead of sort when every partition of the build side is below this.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Calendar features are defined in UTC (day of week of a ...Z start time).
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "affinity",
    master: Optional[str] = None,
    conf: Optional[Mapping[str, str]] = None,
    hive: bool = False,
) -> SparkSession:
    """Create or reuse a session. `master` is left to the deployer unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads `spark.checkpoint.dir` (or the context's checkpoint dir). Only a local-mode
    session (tests, single-node bench) gets a fresh folder of its own when none is set;
    on a cluster an unset value is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="affinity-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediates."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


# Files that a job writes for its own later steps are packed closer than Spark's default.
SCRATCH_CODEC = "zstd"

# Drops a query's shuffle files when it ends, not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside keep no shuffle files; for writes, whose result is in files."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def write_scratch(df: DataFrame, name: str, below: Optional[str] = None) -> DataFrame:
    """`df` written to the shared checkpoint folder (to the folder `below`, if given) and read
    back: what reads it runs without the shuffles that made it, and their files are gone."""
    spark = df.sparkSession
    path = scratch_path(spark, name) if below is None else f"{below}/{name}"
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=SCRATCH_CODEC)
    return spark.read.schema(df.schema).parquet(path)
