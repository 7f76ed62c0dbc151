"""Popularity rank and an exact distributed row position."""

from __future__ import annotations

from typing import Mapping, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.schemas import check_mode
from affinity.session import ensure_checkpoint_dir


def order_index(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "position",
    num_partitions: Optional[int] = None,
) -> DataFrame:
    """Add the 1-based position of each row under `order` (must be a total order).

    Equals `row_number() OVER (ORDER BY order)` without moving every row into one
    partition: rows are range-partitioned and sorted per partition, each row takes its
    index inside its partition, and a per-partition offset (the running row count of the
    earlier partitions) is added. The tagged rows are checkpointed to the shared
    checkpoint folder, so the partition ids and in-partition indexes read by both branches
    come from one materialisation even if a task is re-run. The offset table has one row
    per partition, so its window and broadcast are bounded by the partition count.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumns(
        {"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}
    ).checkpoint(eager=True)
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # monotonically_increasing_id = partition id << 33 | index inside the partition
    local = F.col("_seq") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local + F.lit(1))
        .drop("_part", "_seq", "_offset")
    )


def popularity_ranks(
    events: DataFrame,
    levels: Mapping[str, str],
    counted: str = "eventid",
    mode: str = "intended",
) -> dict[str, DataFrame]:
    """Rank places by their number of events, for each `key -> level name` in `levels`.

    Returns {key: (key, event_cnt, level)}. intended: 1 = the place with most events,
    ties broken by place name; NULL places are not ranked. reference: the rank is taken
    inside each place's own partition, which makes it 1 for every place.

    All keys are ranked in one pass: the per-key count tables are stacked with the key
    name, positioned once under (key name, count desc, place), and each key's positions
    are shifted to start at 1 (the shift table has one row per key).
    """
    check_mode(mode)
    counts = {
        key: events.groupBy(key).agg(F.count(counted).alias("event_cnt")) for key in levels
    }
    if mode == "reference":
        return {key: df.withColumn(levels[key], F.lit(1)) for key, df in counts.items()}
    stacked = None
    for key, df in counts.items():
        part = df.filter(F.col(key).isNotNull()).select(
            F.lit(key).alias("_kind"), F.col(key).cast("string").alias("_place"), "event_cnt"
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    ranked = order_index(
        stacked,
        [F.col("_kind").asc(), F.col("event_cnt").desc(), F.col("_place").asc()],
        name="_pos",
    )
    first = ranked.groupBy("_kind").agg(F.min("_pos").alias("_first"))
    ranked = ranked.join(F.broadcast(first), "_kind").withColumn(
        "_level", (F.col("_pos") - F.col("_first") + 1).cast("int")
    )
    out = {}
    for key, level in levels.items():
        place_type = events.schema[key].dataType
        out[key] = ranked.filter(F.col("_kind") == key).select(
            F.col("_place").cast(place_type).alias(key), "event_cnt", F.col("_level").alias(level)
        )
    return out


def popularity_rank(
    events: DataFrame,
    key: str,
    level_name: str,
    counted: str = "eventid",
    mode: str = "intended",
) -> DataFrame:
    """(key, event_cnt, level_name) for one place column; see `popularity_ranks`."""
    return popularity_ranks(events, {key: level_name}, counted, mode)[key]
