"""Dimension loaders: from the catalog or from a folder of parquet tables."""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import DataFrame, SparkSession

from affinity.schemas import Dims

# The catalog table names of the six dimensions.
DEFAULT_TABLES = {
    "customers": "dwd_customers",
    "event_attendees": "dwd_eventAttendees",
    "event_groups": "dwd_eventGroups",
    "events": "dwd_events",
    "user_friends": "dwd_userFriends",
    "locales": "dwd_locales",
}


def read_dim(spark: SparkSession, table: str) -> DataFrame:
    """One dimension by catalog name. Persisting is the caller's choice, made after the
    plan has pruned the columns it needs."""
    return spark.table(table)


def load_dims(
    spark: SparkSession,
    database: Optional[str] = None,
    tables: Optional[Mapping[str, str]] = None,
) -> Dims:
    names = {**DEFAULT_TABLES, **(tables or {})}
    prefix = f"{database}." if database else ""
    return Dims(**{field: read_dim(spark, prefix + name) for field, name in names.items()})


def load_dims_from_dir(spark: SparkSession, base: str, tables: Optional[Mapping[str, str]] = None, fmt: str = "parquet") -> Dims:
    """Dimensions stored as `<base>/<field>` folders (or the names in `tables`)."""
    names = {k: k for k in DEFAULT_TABLES}
    names.update(tables or {})
    return Dims(
        **{field: spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}") for field, name in names.items()}
    )
