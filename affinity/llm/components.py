"""Connected components of an edge table as Spark jobs (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import written


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .where("v <> u")
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Edges (a, b) to labels (id, component): the smallest id reachable, for every id that
    has an edge. Each pass is joins and minimum aggregates over the edge table, written to
    the shared folder; a hot node is pre-aggregated or split, never gathered. The result of
    the last pass is a set of stars, one per component."""
    e = written(_ordered(edges), name)
    state = _state(e)
    while state[0]:
        both = e.select(F.col("v").alias("n"), F.col("u").alias("to")).unionByName(
            e.select(F.col("u").alias("n"), F.col("v").alias("to"))
        )
        least = both.groupBy("n").agg(F.min("to").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = written(
            both.join(least, "n").where("to > n").select(F.col("to").alias("v"), F.col("m").alias("u")).distinct(),
            name,
        )
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        e = written(
            large.join(down, "v")
            .where("u <> m")
            .select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(down.select("v", F.col("m").alias("u")))
            .distinct(),
            name,
        )
        was, state = state, _state(e)
        if state == was:
            break
    return e.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(
        e.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    )
