"""Event-time streams over the invitation feed: the newest invitation of a key across
micro-batches, and tumbling-window counts with late rows put aside.

Both run on Structured Streaming's own watermark: the largest event time of the batches
before, less the delay, kept in the stream's checkpoint.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Mapping, Optional, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinity.operators.latest import latest_per_key
from affinity.sinks.ledger import BatchLedger
from affinity.sources.fact import good_and_bad, tag_payload
from affinity.streaming.stream import DEFAULT_TRIGGER

EVENT_TIME = "event_time"


def timed(df: DataFrame, column: str) -> DataFrame:
    """`df` with EVENT_TIME, the timestamp in `column`; null where it is none."""
    return df.withColumn(EVENT_TIME, F.col(column).try_cast("timestamp"))


# ---------------------------------------------------------------- newest row per key


def latest_updates(
    stream: DataFrame, keys: Sequence[str], order_by: Sequence[str], time_column: str, delay: str, span: str
) -> DataFrame:
    """A streaming aggregate for update mode: per key and `span` of event time the newest row
    so far, as columns of `stream` beside `window`.

    The state holds one row per key and span. A span leaves it when the watermark passes its
    end, so the state follows the recent feed, not its whole history; the newest of a key's
    spans is its newest row. Rows without an event time, and rows of a span that has left,
    are not counted.
    """
    rest = [c for c in stream.columns if c not in keys and c not in order_by]
    packed = F.struct(*order_by, *rest)
    newest = (
        timed(stream, time_column)
        .withWatermark(EVENT_TIME, delay)
        .groupBy(F.window(EVENT_TIME, span), *keys)
        .agg(F.max(packed).alias("_top"))
    )
    return newest.select("window", *(F.col(c) if c in keys else F.col("_top")[c].alias(c) for c in stream.columns))


def run_latest(
    spark: SparkSession,
    source: DataFrame,
    out: str,
    checkpoint_location: str,
    keys: Sequence[str] = ("userid", "eventid"),
    order_by: Sequence[str] = ("times", "invited"),
    time_column: str = "times",
    delay: str = "1 day",
    span: str = "30 days",
    trigger: Optional[Mapping[str, object]] = None,
) -> StreamingQuery:
    """Keep `out` at the newest invitation per key of the payload stream `source`: each
    micro-batch adds the keys that changed, in a folder of its own that a replay leaves as it
    is. `read_latest` gives the table; `compact_latest` folds the folders into one."""
    rows = good_and_bad(tag_payload(source))[0]
    ledger = BatchLedger(spark, f"{checkpoint_location.rstrip('/')}_ledger")

    def write(changed: DataFrame, batch_id: int) -> None:
        ledger.publish(changed, out, batch_id)

    return (
        latest_updates(rows, keys, order_by, time_column, delay, span)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
        .start()
    )


def read_latest(
    spark: SparkSession,
    out: str,
    keys: Sequence[str] = ("userid", "eventid"),
    order_by: Sequence[str] = ("times", "invited"),
) -> DataFrame:
    """The newest row per key of what `run_latest` wrote."""
    return latest_per_key(spark.read.parquet(out).drop("window", "batch_id"), keys, order_by)


def compact_latest(
    spark: SparkSession,
    out: str,
    keys: Sequence[str] = ("userid", "eventid"),
    order_by: Sequence[str] = ("times", "invited"),
) -> None:
    """Fold the folders of `out` into one per key's newest row, while no stream writes there.
    The folder of the last batch takes the result and the others go afterwards, so a run
    that stops in between leaves rows twice, which reads the same."""
    ledger = BatchLedger(spark, f"{out.rstrip('/')}/_compaction")
    batches = sorted(int(n.split("=")[1]) for n in ledger.files.names(out) if n.startswith("batch_id="))
    if len(batches) < 2:
        return
    window = F.lit(None).cast(spark.read.parquet(out).schema["window"].dataType)
    staged = f"{out.rstrip('/')}/_staging/compact"
    ledger.files.remove(staged)
    read_latest(spark, out, keys, order_by).withColumn("window", window).write.parquet(staged)
    for name in ledger.files.names(staged):
        if name.endswith(".parquet"):
            ledger.files.move(f"{staged}/{name}", f"{out.rstrip('/')}/batch_id={batches[-1]}/compact-{name}")
    for batch_id in batches[:-1]:
        ledger.files.remove(f"{out.rstrip('/')}/batch_id={batch_id}")


# ---------------------------------------------------------------- tumbling windows


@dataclass(frozen=True)
class WindowSinks:
    """Folders for the counts per window and for rows that cannot be counted."""

    counts_out: str
    quarantine_out: str


def batch_watermark(spark: SparkSession, checkpoint_location: str, batch_id: int) -> int:
    """The watermark, in milliseconds, that Spark runs this micro-batch with: it logs it in
    the checkpoint before the batch starts, so a replay sees the same one."""
    log = spark.read.text(f"{checkpoint_location.rstrip('/')}/offsets/{batch_id}")
    lines = [r.value for r in log.where(F.col("value").contains("batchWatermarkMs")).collect()]
    return json.loads(lines[0])["batchWatermarkMs"]


def run_window_counts(
    spark: SparkSession,
    source: DataFrame,
    sinks: WindowSinks,
    checkpoint_location: str,
    time_column: str = "times",
    width: str = "1 day",
    delay: str = "1 hour",
    trigger: Optional[Mapping[str, object]] = None,
) -> StreamingQuery:
    """Count the payload stream's invitations per tumbling window of event time.

    A row is late when the watermark has passed the end of its window, the same rule by
    which a streaming window aggregate drops rows; here it goes to quarantine with the
    reason `late` (`times` without an event time, else the parser's reasons). Counts are
    written per micro-batch and add up (`read_window_counts`), so no state is held and a
    replayed batch counts once.
    """
    ledger = BatchLedger(spark, f"{checkpoint_location.rstrip('/')}_ledger")

    def count(batch: DataFrame, batch_id: int) -> None:
        passed = F.timestamp_millis(F.lit(batch_watermark(spark, checkpoint_location, batch_id)))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.where(F.col("reason").isNull()).withColumn("window", F.window(EVENT_TIME, width))
            late = F.col("window.end") <= passed
            counts = rows.where(~late).groupBy("window").agg(F.count("*").alias("n"))
            # A window takes only rows with an event time.
            untimed = F.coalesce("reason", F.when(F.col(EVENT_TIME).isNull(), F.lit(time_column)))
            bad = batch.withColumn("reason", untimed).where(F.col("reason").isNotNull())
            kept = [t.select("value", "n_fields", "reason") for t in (bad, rows.where(late).withColumn("reason", F.lit("late")))]
            ledger.publish(counts.select("window.start", "window.end", "n"), sinks.counts_out, batch_id)
            ledger.publish(kept[0].unionByName(kept[1]), sinks.quarantine_out, batch_id)
        finally:
            batch.unpersist()

    return (
        timed(tag_payload(source), time_column)
        .withWatermark(EVENT_TIME, delay)
        .writeStream.foreachBatch(count)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
        .start()
    )


def read_window_counts(spark: SparkSession, counts_out: str) -> DataFrame:
    """(start, end, n): the invitations of every window so far."""
    return spark.read.parquet(counts_out).groupBy("start", "end").agg(F.sum("n").alias("n"))
