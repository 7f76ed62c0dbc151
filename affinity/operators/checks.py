"""Key checks for dimension tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n) for every key that occurs more than once (NULL keys included)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def check_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Raise if `keys` is not unique in `df`.

    The wide table's grain is one row per fact pair only if the customer, event and event
    group keys are unique; duplicates multiply rows through the joins.
    """
    dups = duplicate_keys(df, keys)
    if not dups.isEmpty():
        sample = [tuple(r) for r in dups.limit(5).collect()]
        raise ValueError(f"{name}: key {list(keys)} is not unique, e.g. {sample}")
