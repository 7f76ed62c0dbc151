"""Exact de-duplication by skew-safe combining (DataFrame functions only).

Equal texts are combined in three steps, each of which groups by the full content beside
its digest: within a map task (partial aggregation), across tasks within a salt of the
digest group, and across the salts. A hot group reaches the last step as one row per salt.
"""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import BROADCAST_ROWS, broadcast_if_small, written

SALTS = 16


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame,
    salts: int = SALTS,
    digest: Optional[Callable[[Column], Column]] = None,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, digest.

    Texts are equal when identical; null counts as empty. Of equal texts the largest doc_id
    stays. Rows that repeat a doc_id and its text share one verdict; a group without any
    doc_id keeps its rows (keep_id null). Empty tables give no rows; further columns are
    ignored. `digest` may be any function of the text: texts with equal digests are still
    told apart by their content.
    """
    digest = digest or sha256_of
    content = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", content.alias("content")).withColumn("digest", digest(F.col("content")))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    by_salt = salted.groupBy("digest", "salt", "content").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("n")
    )
    winners = by_salt.groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")
    )
    classes = written(
        winners.groupBy("digest").agg(
            F.count("*").alias("contents"), F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
        ),
        "exact-classes",
    )
    rows = keyed.select("doc_id", "digest").join(classes.where("contents = 1").drop("contents"), "digest")
    clash = classes.where("contents > 1").select("digest")
    if not clash.isEmpty():
        # Different contents under one digest: join these few back on their full content.
        hit = written(keyed.join(clash, "digest", "left_semi"), "exact-clash")
        own = hit.groupBy("digest", "content").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        rows = rows.unionByName(hit.join(own, ["digest", "content"]).drop("content"))
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. A row goes by its doc_id and its
    own text, so rows that repeat a doc_id with another text have a verdict of their own.
    Rows without doc_id stay."""
    dropped = written(
        exact_groups(docs, salts)
        .where("NOT kept AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("dropped_id"), F.col("digest").alias("dropped_digest"))
        .distinct(),
        "exact-dropped",
    )
    dropped = broadcast_if_small(dropped, BROADCAST_ROWS // 8)  # 40 bytes a row, not 8
    digest = sha256_of(F.coalesce(docs["text"], F.lit("")))
    gone = (docs["doc_id"] == dropped["dropped_id"]) & (digest == dropped["dropped_digest"])
    return docs.join(dropped, gone, "left_anti")
