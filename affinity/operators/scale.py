"""Min-max scaling against global bounds."""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.expressions import as_double, min_max


def global_bounds(df: DataFrame, column: str, cast_first: bool = True) -> tuple[Column, Column]:
    """(max, min) of a column over the whole frame, as scalar-subquery columns.

    Uncorrelated scalar subqueries: each runs as one small aggregation job (partial
    aggregates, then a single-row merge) and is inlined as a value, so no join with the
    big side is needed. Catalyst merges the subqueries that read the same frame into one.
    `cast_first=False` takes the bounds on the column's own type (lexicographic for text).
    """
    c = as_double(column) if cast_first else F.col(column)
    return df.agg(F.max(c)).scalar(), df.agg(F.min(c)).scalar()


def min_max_scale(
    df: DataFrame,
    columns: Mapping[str, str],
    bounds_from: Optional[DataFrame] = None,
    cast_first: bool = True,
) -> DataFrame:
    """Add `out = (col - min) / (max - min)` for each `out -> col`.

    Bounds come from `bounds_from` (default: `df` itself). NULL input gives NULL, equal
    bounds give NaN.
    """
    source = df if bounds_from is None else bounds_from
    new_cols = {}
    for out, col in columns.items():
        hi, lo = global_bounds(source, col, cast_first)
        new_cols[out] = min_max(F.col(col), hi, lo)
    return df.withColumns(new_cols)
