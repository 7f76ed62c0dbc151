"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed 60-bit hash. Words are summed by source and leading hash digit; the
running sum says in which bucket a source's budget ends. Only the rows of that boundary
bucket are summed again by the next digit, until one hash value is left. A row is taken
when its hash is below its source's threshold, so nothing is sorted, a smaller budget takes
a subset of what a larger one takes, and reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import BROADCAST_ROWS, broadcast_if_small, written
from affinity.operators.rank import order_index

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: the word rule
HASH_BITS, DIGIT_BITS = 60, 12


@dataclass(frozen=True)
class Mix:
    """Source weights in the order of the sources (repeating), the words of the mix as a
    fraction of all words, and how often a source may be repeated at most."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: tuple[int, int] = (3, 2)
    repeats: int = 2


def hashed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text, null: 0) and the 60-bit hash `h` of doc_id
    and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    digest = F.md5(F.encode(key, "utf-8"))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long").alias("h"),
    )


def _exact(a: Column | int, digits: int) -> Column:
    return (F.lit(str(a)) if isinstance(a, int) else a).cast(f"decimal({digits},0)")


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size) to (source, source_size, target, budget): the words every source
    gives to the mix, as a double and rounded down.

    Sources are ordered by code point, null last. A share by weight that exceeds `repeats`
    times the source stops there, and the excess is shared again by weight, one aggregate
    over the sources a round, until no source is above. All comparisons are exact.
    """
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), ((F.col("nth") - 1) % len(mix.weights) + 1).cast("int"))
    ranked = written(
        order_index(sizes, [F.col("source").asc_nulls_last()], "nth").select(
            "source", "source_size", weight.alias("weight"), (F.col("source_size") * mix.repeats).alias("cap")
        ),
        "mix-sources",
    )
    total = int(ranked.agg(F.sum("source_size")).first()[0] or 0)
    num, den = mix.share
    above, state = F.lit(False), None
    while True:
        capped = F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0))
        free = F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        c, w = map(int, ranked.agg(capped, free).first())
        # Free sources get weight * words / parts.
        words, parts = num * total - den * c, den * w
        if not w:
            above = F.lit(True)
        if not w or (c, w) == state:
            break
        state = c, w
        above = _exact(F.col("weight"), 12) * _exact(words, 25) > _exact(F.col("cap"), 20) * _exact(parts, 17)
    given = _exact(F.col("weight"), 12) * _exact(words, 25)
    free_target = given.cast("double") / F.lit(float(max(parts, 1)))
    return ranked.select(
        "source",
        "source_size",
        F.when(above, F.col("cap").cast("double")).otherwise(free_target).alias("target"),
        F.when(above, F.col("cap")).otherwise(_div(given, _exact(max(parts, 1), 17))).alias("budget"),
    )


def _div(a: Column, b: Column) -> Column:
    """The exact integer quotient of two decimals."""
    return F.call_function("div", a, b)


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Where each source's last, partial pass ends: source, cut (a hash), `before` (words of
    the rows below it) and `at` (words of the rows that have it; one row, or equal rows).

    `budgets` has source and `rest`, the words of that pass, less than the source has.
    Sources without words have no threshold.
    """
    edge_rows = rows.join(broadcast_if_small(budgets, BROADCAST_ROWS // 8), rows["source"].eqNullSafe(budgets["source"]))
    edge_rows = edge_rows.select(rows["source"], "size", "h", "rest", F.lit(0).cast("long").alias("before"))
    shift = HASH_BITS
    while True:
        shift -= DIGIT_BITS
        bucket = F.shiftright("h", shift)
        running = Window.partitionBy("source").orderBy("bucket")  # at most 2**DIGIT_BITS rows a source
        edges = written(
            edge_rows.groupBy("source", bucket.alias("bucket"))
            .agg(
                F.sum("size").alias("at"),
                F.min("h").alias("cut"),
                F.max("h").alias("last"),
                F.first("rest").alias("rest"),
                F.first("before").alias("before"),
            )
            .withColumn("before", F.col("before") + F.sum("at").over(running) - F.col("at"))
            .where("before <= rest AND rest < before + at"),
            "mix-edges",
        )
        if shift == 0 or edges.where("cut < last").isEmpty():
            return edges.select("source", "cut", "before", "at")
        edge = broadcast_if_small(
            edges.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.col("before").alias("below")),
            BROADCAST_ROWS // 8,
        )
        inside = edge_rows["source"].eqNullSafe(edge["s"]) & (bucket == edge["b"])
        edge_rows = written(
            edge_rows.join(edge, inside).select("source", "size", "h", "rest", F.col("below").alias("before")),
            "mix-boundary",
        )


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of `docs` (doc_id, text,
    source).

    A row is taken once for every full pass over its source that the budget holds, and once
    more below the threshold. The row at the threshold is taken in part (its first words),
    so the words taken from a source are its target rounded down; equal rows there share
    the rest evenly. Null and empty texts have no words and are taken with none; a null
    source is a source; null and repeated doc_ids are data like any other. An empty table
    gives no rows; further columns are ignored.
    """
    rows = written(hashed_rows(docs), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = written(
        source_targets(sizes, mix)
        .withColumn("passes", F.coalesce(F.expr("budget div nullif(source_size, 0)"), F.lit(0)))
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("source_size")),
        "mix-plan",
    )
    cuts = thresholds(rows, plan.where("source_size > 0").select("source", "rest"))
    cuts = cuts.withColumnRenamed("source", "cut_source")
    plan = plan.join(cuts, plan["source"].eqNullSafe(cuts["cut_source"]), "left").drop("cut_source")
    plan = broadcast_if_small(written(plan, "mix-cuts"), BROADCAST_ROWS // 8).withColumnRenamed("source", "of")
    part = _div(_exact(F.col("size"), 18) * _exact(F.col("rest") - F.col("before"), 19), _exact(F.col("at"), 19))
    last = F.when(F.col("h") < F.col("cut"), F.col("size")).when(F.col("h") == F.col("cut"), part).otherwise(F.lit(0))
    return rows.join(plan, rows["source"].eqNullSafe(plan["of"])).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("passes") + last).cast("long").alias("taken"),
    )
