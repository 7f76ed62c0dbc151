"""Status pivot: one count column per status value."""

from __future__ import annotations

from typing import Mapping, Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_pivot(
    df: DataFrame,
    keys: Sequence[str],
    outputs: Mapping[str, str],
    status_col: str = "status",
    counted: Optional[str] = None,
    weight: Optional[str] = None,
) -> DataFrame:
    """Group by `keys`; for each `name -> status` in `outputs`, count rows with that status.

    `counted`: count only rows where this column is non-NULL (SQL `count(col)`).
    `weight`: sum this multiplicity column instead of counting rows.

    One pass with conditional aggregates: the same values and bigint type as grouping by
    (keys, status) first and then taking `max(when(status = x, cnt).otherwise(0))`, but
    with a single shuffle and partial aggregation before it.
    """
    status = F.col(status_col)
    aggs = []
    for name, value in outputs.items():
        if weight is not None:
            agg = F.sum(F.when(status == value, F.col(weight)).otherwise(F.lit(0))).cast("long")
        else:
            target = F.col(counted) if counted is not None else F.lit(1)
            agg = F.count(F.when(status == value, target))
        aggs.append(agg.alias(name))
    return df.groupBy(*keys).agg(*aggs)
