"""Prefix trie of conversations.

1. Conversations become sequences of turn digests (role and text), one row each, with the
   words of every turn. Texts are not shuffled.
2. The sequences are range-partitioned by (sequence, conv_id), so that a shard holds one
   stretch of the sorted sequences and a hot sequence is spread over several shards.
3. A shard is one Arrow task: digests become dense turn ids, a padded matrix of them is
   lexsorted strip by strip, and depth by depth the accumulated change mask of the columns
   marks where nodes start; `reduceat` over these starts aggregates each depth.
4. A node that holds neither the first nor the last row of its shard is complete. The
   others, the path of the first and of the last row, are summed over the shards under the
   digest of their prefix; what two neighbouring shards both counted on the path that they
   share is taken off again.
"""

from __future__ import annotations

import hashlib
import math
from typing import Callable, Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import BROADCAST_ROWS, broadcast_if_small, in_arrow, written
from affinity.llm.mixing import WORD

TURNS_PER_SHARD = 200_000
STRIP = 8  # columns of the padded matrix at a time
CHUNK = 8192  # bytes of joined conv_ids in one row
DIGEST = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# kind: `node` is complete, `part` is a shard's share of a boundary node, `ends` a piece of
# a boundary node's joined conv_ids, `edge` a shard's first and last sequence.
SHARD = (
    "kind string, shard int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, nth long, ends binary, "
    "first_turns array<binary>, last_turns array<binary>, last_words array<long>"
)
_TYPES = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64(),
          "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}
FIELDS = {n: _TYPES[t] for n, t in (x.split() for x in SHARD.split(", "))}


def digested_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and `turns`: its turns in order, each (turn id, words). The turn id is a
    digest of role and text; null role or text is empty. Order: turn, null first, then
    turn id. Rows without conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.encode(content, "utf-8"))).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    return (
        conversations.where("conv_id IS NOT NULL")
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )


def rebuilt(convs: DataFrame, base: Column, head: Column, longest_head: int) -> DataFrame:
    """Every conversation with its first `head` turns replaced by the first `head` turns of
    conversation `base` (all if it has fewer, none if there is no such conversation)."""
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, longest_head).alias("base_turns"))
    with_base = convs.select("conv_id", "turns", base.alias("base"), head.cast("int").alias("head"))
    taken = F.slice(F.coalesce("base_turns", F.array().cast(convs.schema["turns"].dataType)), F.lit(1), F.col("head"))
    own = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return with_base.join(heads, "base", "left").select("conv_id", F.concat(taken, own).alias("turns"))


def _sorted_rows(ids: np.ndarray, starts: np.ndarray, lens: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Row order by turn ids, a prefix first, then conv_id: lexsort of the padded matrix by
    strips of columns; only rows that still tie see the next strip."""
    order = np.empty(len(lens), np.int64)
    at, place, rows, tied = 0, np.arange(len(lens)), np.arange(len(lens)), np.zeros(len(lens), np.int64)
    while len(rows):
        matrix = np.zeros((len(rows), STRIP), np.int64)
        for j in range(STRIP):
            has = np.flatnonzero(lens[rows] > at + j)
            matrix[has, j] = ids[starts[rows[has]] + at + j]
        idx = np.lexsort((conv[rows], *matrix.T[::-1], tied))
        rows, matrix, tied = rows[idx], matrix[idx], tied[idx]
        order[place] = rows
        change = np.ones(len(rows), bool)
        change[1:] = (tied[1:] != tied[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)
        tied = np.cumsum(change)
        again = (np.bincount(tied)[tied] > 1) & (matrix[:, -1] > 0)
        at, place, rows, tied = at + STRIP, place[again], rows[again], tied[again]
    return order


class _Level:
    """The nodes of one depth of a shard, in sorted order."""

    def __init__(self, first, n, least, parent, words, enders):
        self.first, self.n, self.least, self.parent = first, n, least, parent
        self.words, self.enders = words, enders
        self.children = np.zeros(len(first), np.int64)


def _levels(ids, words, starts, lens, conv):
    """Per depth its nodes: first row, members, smallest conv_id, parent (index in the depth
    above), words of the last turn, rows that end there."""
    alive = np.arange(len(conv))
    node = np.zeros(len(conv), np.int64)
    zero = np.zeros(1, np.int64)
    levels = [_Level(zero, np.array([len(conv)]), conv.min(keepdims=True), None, zero, (lens == 0).sum(keepdims=True))]
    depth = 0
    while True:
        depth += 1
        stays = lens[alive] >= depth
        alive, above = alive[stays], node[stays]
        if not len(alive):
            break
        turn = ids[starts[alive] + depth - 1]
        # A node starts where this column changes or any column before it did.
        change = np.ones(len(alive), bool)
        change[1:] = (above[1:] != above[:-1]) | (turn[1:] != turn[:-1])
        first = np.flatnonzero(change)
        node = np.cumsum(change) - 1
        levels.append(
            _Level(
                alive[first],
                np.diff(np.append(first, len(alive))),
                np.minimum.reduceat(conv[alive], first),
                above[first],
                words[starts[alive[first]] + depth - 1],
                np.add.reduceat((lens[alive] == depth).astype(np.int64), first),
            )
        )
        levels[-2].children = np.bincount(above[first], minlength=len(levels[-2].first))
    for level in levels:
        level.leaves = (level.children == 0).astype(np.int64)
        level.saved = (level.n - 1) * level.words
    for upper, lower in zip(levels[-2::-1], levels[:0:-1]):
        np.add.at(upper.leaves, lower.parent, lower.leaves)
        np.add.at(upper.saved, lower.parent, lower.saved)
    return levels


def prefix_keys(turns) -> list[bytes]:
    """The digest of every prefix of a sequence of turn ids, the empty one first."""
    h, out = hashlib.md5(), []
    out.append(h.digest())
    for t in turns:
        h.update(t)
        out.append(h.digest())
    return out


def _batch(rows: dict) -> pa.RecordBatch:
    n = len(next(iter(rows.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[f], t) if f in rows else pa.nulls(n, t) for f, t in FIELDS.items()], names=list(FIELDS)
    )


def _shard_rows(shard: int, conv: np.ndarray, lens: np.ndarray, digests: np.ndarray, words: np.ndarray):
    """All rows of a shard. `digests` (16 bytes each) and `words` are the turns of its
    conversations one after another."""
    known, ids = np.unique(digests, return_inverse=True)
    starts = np.cumsum(lens) - lens
    order = _sorted_rows(ids + 1, starts, lens, conv)
    conv, starts, lens = conv[order], starts[order], lens[order]
    levels = _levels(ids, words, starts, lens, conv)
    # An S16 value drops trailing zero bytes; the padded buffer keeps them.
    raw = digests.tobytes()

    def sequence(row):
        a = starts[row] * DIGEST
        return [raw[a + i * DIGEST : a + (i + 1) * DIGEST] for i in range(lens[row])]

    first, last = sequence(0), sequence(-1)
    keys = prefix_keys(first), prefix_keys(last)
    yield _batch({
        "kind": ["edge"], "shard": [shard], "first_turns": [first], "last_turns": [last],
        "last_words": [words[starts[-1] : starts[-1] + lens[-1]]],
    })

    def path(depth, level):
        """Index and prefix digest of this depth's nodes on the two paths."""
        out = {}
        if depth <= lens[0]:
            out[0] = keys[0][depth]
        if depth <= lens[-1]:
            out[len(level.first) - 1] = keys[1][depth]
        return out

    above: dict[int, bytes] = {}
    for depth, level in enumerate(levels):
        on_path = path(depth, level)
        joined = [b""] * len(level.first)
        for k in np.flatnonzero(level.enders):
            a = level.first[k]
            joined[k] = ",".join(map(str, conv[a : a + level.enders[k]].tolist())).encode()
        edge = sorted(on_path)
        inner = np.ones(len(level.first), bool)
        inner[edge] = False
        for at in range(0, len(level.first), 10_000):
            idx = np.flatnonzero(inner[at : at + 10_000]) + at
            if not len(idx):
                continue
            up = level.parent[idx]
            parent_key = [above.get(p) for p in up.tolist()]
            least = levels[depth - 1].least[up]
            yield _batch({
                "kind": ["node"] * len(idx),
                "parent_key": parent_key,
                "depth": np.full(len(idx), depth),
                "conv_id": level.least[idx],
                "parent_conv_id": pa.array(least, mask=np.array([k is not None for k in parent_key])),
                "n_convs": level.n[idx],
                "n_children": level.children[idx],
                "n_leaves": level.leaves[idx],
                "saved_tokens": level.saved[idx],
                "ends_sha256": [hashlib.sha256(joined[k]).hexdigest() for k in idx],
            })
        for k in edge:
            yield _batch({
                "kind": ["part"],
                "key": [on_path[k]],
                "parent_key": [above.get(int(level.parent[k])) if depth else None],
                "depth": [depth],
                "conv_id": [level.least[k]],
                "n_convs": [level.n[k]],
                "n_children": [level.children[k]],
                "n_leaves": [level.leaves[k]],
                "saved_tokens": [level.saved[k]],
            })
            for i in range(0, len(joined[k]), CHUNK):
                yield _batch({"kind": ["ends"], "shard": [shard], "key": [on_path[k]], "nth": [i // CHUNK],
                              "ends": [joined[k][i : i + CHUNK]]})
        above = on_path


def _shard(batches):
    """One range shard. It is bounded by the number of shards, which follows the turns."""
    parts = []
    shard = None
    for batch in batches:
        shard = batch.column("shard")[0].as_py() if batch.num_rows else shard
        turns = batch.column("turns")
        flat = turns.flatten()
        raw = np.frombuffer(b"".join(flat.field("id").to_pylist()), dtype=f"S{DIGEST}")
        parts.append((
            batch.column("conv_id").to_numpy(zero_copy_only=False),
            np.diff(turns.offsets.to_numpy()).astype(np.int64),
            raw,
            flat.field("words").to_numpy(zero_copy_only=False),
        ))
    if sum(len(p[0]) for p in parts):
        yield from _shard_rows(shard, *(np.concatenate(x) for x in zip(*parts)))


def _shared_path(batches):
    """What two neighbouring shards both counted, to be taken off, for every node on the path
    that the first one's last sequence shares with the second one's first."""
    for batch in batches:
        out = {f: [] for f in ("kind", "key", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")}
        columns = (batch.column(c).to_pylist() for c in ("last_turns", "last_words", "next_turns"))
        for turns, words, following in zip(*columns):
            shared = 0
            while shared < min(len(turns), len(following)) and turns[shared] == following[shared]:
                shared += 1
            keys = prefix_keys(turns[:shared])
            twice = sum(words[:shared])  # nodes of the path below the root, counted in both
            for depth in range(shared + 1):
                if depth > 1:
                    twice -= words[depth - 2]
                out["kind"].append("part")
                out["key"].append(keys[depth])
                out["depth"].append(depth)
                out["n_convs"].append(0)
                out["n_children"].append(-1 if depth < shared else 0)
                # The last sequence went for a leaf; the next shard goes on with it.
                out["n_leaves"].append(-1 if shared == len(turns) else 0)
                out["saved_tokens"].append(twice)
        yield _batch(out)


def _ends_digests(batches):
    """SHA-256 of every key's pieces, which come sorted by (key, shard, nth)."""
    key = digest = None
    for batch in batches:
        done = []
        pieces = zip(*(batch.column(c).to_pylist() for c in ("key", "nth", "ends")))
        for k, nth, piece in pieces:
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            elif nth == 0:  # the first piece of a further shard
                digest.update(b",")
            digest.update(piece)
        if done:
            yield _ends_batch(done)
    if key is not None:
        yield _ends_batch([(key, digest.hexdigest())])


def _ends_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), pa.string()))],
                                      names=["key", "ends_sha256"])


def prefix_trie(convs: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """The nodes of the trie over `convs` (conv_id, turns: array of (id, words), 16 bytes an
    id): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Without conversations there are no nodes, not even the root.

    Memory: a shard's turn ids and words, bounded by `turns_per_shard` on average and by the
    longest conversation; a piece of `CHUNK` bytes a row of a hot node's conv_ids, which one
    task reads in order, as a digest needs.
    """
    convs = written(convs.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"], t["words"])).alias("turns")),
                    "trie-sequences")
    turns = convs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    ids = F.transform("turns", lambda t: t["id"])
    shards = convs.withColumn("ids", ids).repartitionByRange(math.ceil(turns / turns_per_shard) or 1, "ids", "conv_id")
    shards = shards.select("conv_id", "turns", F.spark_partition_id().alias("shard"))
    out = written(in_arrow(shards, _shard, SHARD), "trie-shards")

    edges = out.where("kind = 'edge'").select("shard", "first_turns", "last_turns", "last_words")
    follows = F.lead("shard").over(Window.orderBy("shard"))  # one number a shard
    following = edges.select("shard", follows.alias("after")).where("after IS NOT NULL")
    starts = edges.select(F.col("shard").alias("after"), F.col("first_turns").alias("next_turns"))
    pairs = edges.drop("first_turns").join(following, "shard").join(starts, "after")
    twice = in_arrow(pairs.select("last_turns", "last_words", "next_turns"), _shared_path, SHARD)

    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    parts = out.where("kind = 'part'").unionByName(twice).groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), *(F.sum(c).alias(c) for c in sums)
    )
    pieces = out.where("kind = 'ends'").select("key", "shard", "nth", "ends")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "shard", "nth")
    ends = in_arrow(pieces, _ends_digests, "key binary, ends_sha256 string")
    path = written(
        parts.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))),
        "trie-path",
    )
    columns = ["conv_id", "depth", "parent_conv_id", *sums, "ends_sha256"]
    parents = path.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    parents = broadcast_if_small(parents, BROADCAST_ROWS // 4)
    # Children of a boundary node learn their parent's smallest member only now.
    nodes, path = (
        t.select(*(c for c in columns if c != "parent_conv_id"), "parent_key") for t in (out.where("kind = 'node'"), path)
    )
    waiting = nodes.where("parent_key IS NOT NULL").unionByName(path.where("parent_key IS NOT NULL"))
    root = path.where("parent_key IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        out.where("kind = 'node' AND parent_key IS NULL").select(*columns)
        .unionByName(waiting.join(parents, "parent_key").select(*columns))
        .unionByName(root.select(*columns))
    )
