"""Latest row per key."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    ascending: bool = False,
) -> DataFrame:
    """Keep one row per `keys`: the first under `order_by` (descending by default).

    Same rows as `row_number() OVER (PARTITION BY keys ORDER BY order_by DESC) = 1`
    (NULLS LAST for descending, NULLS FIRST for ascending), with the remaining columns as
    the final tie-break so the result is deterministic.

    Written as an aggregate of `max(struct(order..., rest...))` instead of a window (Spark
    runs it sort-based, as the buffer is a struct): the partial aggregate collapses each
    key map-side before the shuffle, so a key that holds a large share of the rows reaches
    its final task as one row per input partition, never as the whole key group.
    """
    keys = list(keys)
    order = list(order_by)
    missing = [c for c in keys + order if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}")
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    pick = F.min(packed) if ascending else F.max(packed)
    top = df.groupBy(*keys).agg(pick.alias("_top"))
    return top.select(
        *[F.col(c) if c in keys else F.col("_top").getField(c).alias(c) for c in df.columns]
    )
