"""K1/K2: file and JDBC sinks."""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
    partition_by: Optional[list[str]] = None,
    compression: Optional[str] = None,
) -> None:
    """Write `df` to `path`. CSV gets a header row and, where named, a `compression` that Spark's
    reader takes from the files' names. `single_file` coalesces to one task
    and removes write parallelism; leave it off except for small outputs."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if compression is not None:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def batch_path(base: str, batch_id: int) -> str:
    """Per-batch folder; rewriting the same batch id overwrites only that batch."""
    return f"{base.rstrip('/')}/batch_id={batch_id}"


def write_batch(df: DataFrame, base: str, batch_id: int, fmt: str = "parquet", single_file: bool = False) -> str:
    path = batch_path(base, batch_id)
    write_table(df, path, fmt=fmt, mode="overwrite", single_file=single_file)
    return path


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    num_partitions: Optional[int] = None,
) -> None:
    """JDBC write; URL and credentials come from configuration. `num_partitions` caps the
    number of concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.mode(mode).jdbc(url, table, properties=dict(properties))
