"""Near-duplicate groups by b-bit MinHash.

1. One Arrow pass per text: its set of word shingles as 64-bit hashes, `PERMUTATIONS`
   minima, band keys from the full minima, and the low `BITS` bits of every minimum packed
   into bit planes (the b-bit signature). Texts with equal sets become one class.
2. Candidates come from bands. A band bucket is never expanded into all its pairs: first
   every member is paired with the smallest one. Buckets whose members are then in one
   component are done. In the others, members outside the largest component become pivots,
   up to `PIVOTS` a round; they are compared with the members of other components by
   signature inside the join, and leave the bucket. Texts with too many shingles of their
   own to reach the threshold with any text there leave it first. Every pair of a bucket that could still
   join two components is compared in some round, so large buckets lose nothing.
3. Candidates are pruned by the collision-corrected similarity of the signatures (at a
   margin that loses a pair at the threshold with the chance `MISS`) and confirmed on the
   full sets.
4. Links give connected components, labelled by the smallest doc_id.
"""

from __future__ import annotations

import hashlib
import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import kernels as K
from affinity.llm.common import BROADCAST_ROWS, broadcast_if_small, in_arrow, written
from affinity.llm.components import components
from affinity.operators.rank import order_index

PERMUTATIONS = 252
WORDS_64 = 4  # 64-bit words a bit plane takes (256 bits for 252 minima)
BITS = 4
MISS = 1e-5  # chance that a pair at the threshold shares no band, or is pruned, at most
CELLS = 8192  # hash cells of a text's shingles, for an upper bound of what two texts share
PIVOTS = 512  # pivots of a bucket in each round after the first

FEATURES = "doc_id long, text_hash long, n_shingles long, digest binary, signature array<long>, bands array<long>"


def rows_per_band(threshold: float, permutations: int = PERMUTATIONS, miss: float = MISS) -> int:
    """The most rows a band may have so that a pair at the threshold is missed rarely."""
    return max(r for r in range(1, 17) if (1 - threshold**r) ** (permutations // r) <= miss)


def _features(words: int, rows: int):
    multipliers = K.odd_constants(PERMUTATIONS, 7)
    places = K.odd_constants(rows, 8)
    n_bands = PERMUTATIONS // rows

    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for lo, hi in K.blocks(texts):
                sets = K.Words([t.lower() for t in texts[lo:hi]], K.SPACES).shingles(words)
                counts = np.array([len(s) for s in sets])
                full = np.flatnonzero(counts)
                minima = np.zeros((PERMUTATIONS, len(sets)), dtype=np.uint64)
                if len(full):
                    joined = np.concatenate(sets)
                    starts = np.concatenate([[0], np.cumsum(counts[full])])[:-1]
                    for i, m in enumerate(multipliers):
                        minima[i, full] = np.minimum.reduceat(joined * m, starts)
                by_band = minima[: n_bands * rows].reshape(n_bands, rows, len(sets))
                keys = (by_band * places[None, :, None]).sum(axis=1, dtype=np.uint64)
                keys = K.mix(keys + np.arange(n_bands, dtype=np.uint64)[:, None]).T
                low = np.zeros((len(sets), WORDS_64 * 64), dtype=np.uint8)
                low[:, :PERMUTATIONS] = (minima & np.uint64((1 << BITS) - 1)).T
                planes = [np.packbits((low >> b) & 1, axis=1).view(np.int64) for b in range(BITS)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo).cast(pa.int64()),
                        hashes.slice(lo, hi - lo),
                        pa.array(counts, pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array(list(np.concatenate(planes, axis=1)), pa.list_(pa.int64())),
                        pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "digest", "signature", "bands"],
                )

    return run


def _confirm(words: int, percent: int):
    def run(batches):
        for batch in batches:
            left = [t.lower() for t in batch.column("ta").cast(pa.binary()).to_pylist()]
            right = [t.lower() for t in batch.column("tb").cast(pa.binary()).to_pylist()]
            keep = np.zeros(len(left), dtype=bool)
            sizes = [x + y for x, y in zip(left, right)]  # blocks by both sides together
            for lo, hi in K.blocks(sizes):
                a = K.Words(left[lo:hi], K.SPACES).shingles(words)
                b = K.Words(right[lo:hi], K.SPACES).shingles(words)
                for i, (x, y) in enumerate(zip(a, b)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[lo + i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t.lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for lo, hi in K.blocks(texts):
                sets = K.Words(texts[lo:hi], K.SPACES).shingles(words)
                owner = np.repeat(np.array(ids[lo:hi], dtype=np.int64), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "shingle"]
                )

    return run


def _cells(words: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [t.lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for lo, hi in K.blocks(texts):
                cells, extra = [], []
                for x in K.Words(texts[lo:hi], K.SPACES).shingles(words):
                    taken = np.zeros(CELLS, dtype=np.uint8)
                    taken[(x & np.uint64(CELLS - 1)).astype(np.int64)] = 1
                    cells.append(np.packbits(taken).view(np.int64))
                    extra.append(len(x) - int(taken.sum()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(cells, pa.list_(pa.int64())), pa.array(extra, pa.int64())],
                    names=["id", "cells", "extra"],
                )

    return run


def _traits(docs: DataFrame, ids: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """What bounds the similarity of the given documents among themselves: `shared`, how many
    of their shingles some other of them has, and `cells`, which of CELLS cells their
    shingles hash to, with `extra`, the shingles that share a cell. Ids with several texts
    have no such bounds."""
    texts = _texts(docs, ids.select(F.col("id").alias("doc_id")))
    single = texts.groupBy("doc_id").agg(F.count("*").alias("c")).where("c = 1").select(F.col("doc_id").alias("id"))
    lone = (
        in_arrow(texts, _sets(words), "id long, shingle long")
        .groupBy("shingle")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"))
        .where("id = last")
        .groupBy("id")
        .agg(F.count("*").alias("own"))
    )
    cells = in_arrow(texts, _cells(words), "id long, cells array<long>, extra long").join(single, "id")
    return written(
        reps.join(ids.select("id").distinct(), "id", "left_semi")
        .join(cells, "id", "left")
        .join(lone.join(single, "id"), "id", "left")
        .select("id", "signature", "bands", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"), "cells", "extra"),
        "near-traits",
    )


def _could_link(percent: int, n_bands: int) -> Column:
    """Whether a bucket's member and pivot could be similar enough, from their traits: two
    exact bounds, the pruning estimate, and the first band that both share (a pair that
    shares several buckets is compared in one)."""
    most = F.least("shared", "p_shared")
    common = F.aggregate(
        F.zip_with("cells", "p_cells", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda a, x: a + x
    ) + F.least("extra", "p_extra")

    def enough(c: Column) -> Column:
        return 100 * c >= percent * (F.col("n") + F.col("p_n") - c)

    band = [(F.col("bands").getItem(i), F.col("p_bands").getItem(i)) for i in range(n_bands)]
    first_shared = F.coalesce(*(F.when(x == y, x) for x, y in band))
    return (
        (F.col("label") != F.col("pivot_label"))
        & enough(most)
        & _alike("signature", "p_signature", percent)
        & (first_shared == F.col("bucket"))
        & F.coalesce(enough(common), F.lit(True))
    )


def estimated_similarity(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: equal b-bit values, less chance collisions."""
    differing = None
    for w in range(WORDS_64):
        any_plane = None
        for p in range(BITS):
            x = a.getItem(p * WORDS_64 + w).bitwiseXOR(b.getItem(p * WORDS_64 + w))
            any_plane = x if any_plane is None else any_plane.bitwiseOR(x)
        n = F.bit_count(any_plane)
        differing = n if differing is None else differing + n
    chance = 2.0**-BITS
    return (1 - differing / F.lit(float(PERMUTATIONS)) - chance) / (1 - chance)


def prune_below(threshold: float) -> float:
    """The estimate that a pair at the threshold falls short of with the chance MISS."""
    chance = 2.0**-BITS
    p = threshold + (1 - threshold) * chance
    error = math.sqrt(p * (1 - p) / PERMUTATIONS) / (1 - chance)
    return threshold - NormalDist().inv_cdf(1 - MISS) * error


def _alike(a: str, b: str, percent: int) -> Column:
    return estimated_similarity(F.col(a), F.col(b)) >= prune_below(percent / 100)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The different (doc_id, text) of the given doc_ids."""
    ids = written(ids.distinct(), "near-ids")
    return written(docs.join(broadcast_if_small(ids), "doc_id", "left_semi").distinct(), "near-texts")


def _links(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b), a written table, that are similar enough on their full sets."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    texts = _texts(docs, ids)
    both = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a").join(
        texts.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b"
    )
    return written(
        in_arrow(both.select("a", "b", "ta", "tb"), _confirm(words, percent), "a long, b long"), "near-links"
    )


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _open(live: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, id, label) of the buckets whose members are in two components or more."""
    named = live.join(labels, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("label"))
    mixed = (
        named.groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo < hi")
        .select("bucket")
    )
    return written(named.join(mixed, "bucket"), "near-open")


def _pivots(open_: DataFrame, salt: int) -> DataFrame:
    """(bucket, pivot, pivot_label): up to PIVOTS members outside a bucket's largest component."""
    largest = (
        open_.groupBy("bucket", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
    )
    return written(
        open_.join(largest, "bucket")
        .where("label <> largest")
        .groupBy("bucket", F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(PIVOTS)).alias("part"))
        .agg(F.min("id").alias("pivot"), F.min_by("label", "id").alias("pivot_label"))
        .drop("part"),
        "near-pivots",
    )


def _featured(docs: DataFrame, words: int, rows: int) -> DataFrame:
    return in_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), _features(words, rows), FEATURES)


def _namesakes(docs: DataFrame, feats: DataFrame, words: int, rows: int):
    """Where a doc_id has texts with different sets, each such text gets an id of its own, a
    number above all doc_ids. Returns `docs` and `feats` under these ids, and whether there
    are any."""
    twice = written(
        feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
        .where("lo <> hi")
        .select("doc_id"),
        "near-namesakes",
    )
    if twice.isEmpty():
        return docs, feats, False
    small = broadcast_if_small(twice)
    top = docs.agg(F.max("doc_id")).first()[0]
    own = docs.where("text IS NOT NULL").join(small, "doc_id", "left_semi").distinct()
    own = order_index(own, [F.col("doc_id"), F.col("text")], "at")
    own = written(own.select((F.lit(top) + F.col("at")).alias("doc_id"), "text"), "near-apart")
    docs, feats = (t.join(small, "doc_id", "left_anti") for t in (docs, feats))
    return docs.unionByName(own), feats.unionByName(_featured(own, words, rows)), True


def near_verdicts(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of `docs` (doc_id,
    text); see `near_groups`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows_per_band(percent / 100)
    every = written(_featured(docs, words, rows), "near-features")
    docs, feats, renamed = _namesakes(docs.where("text IS NOT NULL"), every, words, rows)
    reps = written(
        feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "near-classes",
    )
    members = reps.select(F.explode("bands").alias("bucket"), "id")
    shared = members.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
    live = written(
        members.join(shared.select("bucket", "pivot"), "bucket").where("id <> pivot"), "near-buckets"
    )
    sig = reps.select("id", "signature")
    seen = written(
        live.select(*_pair("pivot", "id"))
        .distinct()
        .join(sig.withColumnsRenamed({"id": "a", "signature": "sa"}), "a")
        .join(sig.withColumnsRenamed({"id": "b", "signature": "sb"}), "b")
        .where(_alike("sa", "sb", percent))
        .select("a", "b"),
        "near-pairs",
    )
    edges = _links(seen, docs, words, percent)
    labels = written(components(edges, "near-components"), "near-labels")
    open_ = _open(live.drop("pivot"), labels)
    traits = _traits(docs, open_, reps, words)
    # No text can share more with another than its shingles that some other text here has.
    hopeful = traits.where(100 * F.col("shared") >= percent * F.col("n")).select("id")
    open_ = _open(open_.join(hopeful, "id", "left_semi").select("bucket", "id"), labels)
    rounds = 0
    while not open_.isEmpty():
        pivots = _pivots(open_, rounds)
        of_pivot = traits.select(*(F.col(c).alias(f"p_{c}") for c in traits.columns))
        pairs = written(
            open_.join(traits, "id")
            .join(pivots.join(of_pivot, F.col("pivot") == F.col("p_id")), "bucket")
            .where(_could_link(percent, PERMUTATIONS // rows))
            .select(*_pair("pivot", "id"))
            .distinct()
            .join(seen, ["a", "b"], "left_anti"),
            "near-pairs",
        )
        links = _links(pairs, docs, words, percent)
        seen = seen.unionByName(pairs)
        if not links.isEmpty():
            edges = edges.unionByName(links)
            labels = written(components(edges, "near-components"), "near-labels")
        left = open_.select("bucket", "id").join(
            pivots.select("bucket", F.col("pivot").alias("id")), ["bucket", "id"], "left_anti"
        )
        open_ = _open(left, labels)
        rounds += 1
    classes = reps.select("digest", "id").join(labels, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    found = every.select("doc_id", "text_hash", "n_shingles", "digest").join(classes, "digest", "left")
    if renamed:  # labels may be numbers of texts: name every component by its smallest doc_id
        found = written(found, "near-found")
        least = found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
        found = found.join(least, "component", "left").withColumn("component", F.col("least"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "text_hash", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def near_groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text).

    Words are runs of non-white-space of the text with A-Z lower-cased; two texts are linked
    when 100 * intersection >= percent * union of their shingle sets. Texts without words
    (null, empty, blank) and rows without doc_id are linked with nothing; the latter are
    kept, with a null component. Rows that repeat a doc_id with another text are judged by
    their own text. Empty tables give no rows; further columns are ignored.
    """
    return near_verdicts(docs, words, percent).drop("text_hash")


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates (the smallest doc_id), all columns. A row
    goes by its doc_id and its own text."""
    dropped = (
        near_verdicts(docs, words, percent)
        .where("NOT kept AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash"))
        .distinct()
    )
    dropped = broadcast_if_small(written(dropped, "near-dropped"), BROADCAST_ROWS // 2)
    gone = (docs["doc_id"] == dropped["dropped_id"]) & (F.xxhash64(docs["text"]) == dropped["dropped_hash"])
    return docs.join(dropped, gone, "left_anti")
