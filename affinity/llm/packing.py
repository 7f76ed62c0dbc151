"""Packing documents into sequences with minimum bin slack.

Documents become token ids; every full window of a document is a sequence of its own, and
the remainders are packed. For each window the largest remainder left is taken, and a
subset-sum over the multiset of remaining lengths (reachable sums as one integer's bits)
finds the fill closest to the capacity; the counts used are traced back through the bits.
Remainders are dealt into groups of bounded size that are packed independently.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import in_arrow, written

END_ID = 1  # fixed value: the id after every document
GROUP_PIECES = 4096  # pieces that are packed together, on average
SEQUENCE_BITS = 32  # of a sequence id, below the group's number

PIECES = "doc_id long, start long, length long, doc_tokens long, row long, ids binary"

# Characters on which the two tokenizer libraries were compared; others go the slower way.
_PLAIN = re.compile("[\x00-ɏ]*").fullmatch


class Tokenizer:
    """Ids of a byte-level BPE given as a tokenizer file. The same vocabulary as ranks, if
    given, encodes plain texts faster; texts with other characters or with a special token's
    string are encoded by the file itself."""

    def __init__(self, file: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(file)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and _PLAIN(text) and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids


_loaded: dict[tuple, Tokenizer] = {}  # per worker process


def _tokenizer(*args) -> Tokenizer:
    if args not in _loaded:
        _loaded[args] = Tokenizer(*args)
    return _loaded[args]


def _cut(source: tuple, window: int):
    def run(batches):
        tok, row = _tokenizer(*source), 0
        try:
            for batch in batches:
                out = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    ids = np.array(tok.ids(text.as_py() or "") + [END_ID], dtype="<u4")
                    for at in range(0, len(ids), window):
                        piece = ids[at : at + window]
                        out.append((doc_id, at, len(piece), len(ids), row, piece.tobytes()))
                        row += 1
                    if len(out) >= 512:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)
        finally:
            # The worker process goes on to other tasks, which need this memory.
            tok = None
            _loaded.clear()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.binary()]
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and how many of each, out of `counts`, whose sum is the largest reachable one
    up to `capacity`."""
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        steps.append((length, reach))
        left = min(counts[length], capacity // length)
        take = 1
        while left:  # 1, 2, 4, ... copies at once
            take = min(take, left)
            reach |= (reach << (take * length)) & mask
            left -= take
            take *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> at & 1:
            used[length] = used.get(length, 0) + 1
            at -= length
    return used


def pack_lengths(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of every piece, in the order given; pieces of one length
    are taken in that order."""
    waiting = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        waiting[int(lengths[i])].append(i)
    counts = {length: len(x) for length, x in waiting.items()}
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    while counts:
        top = max(counts)
        counts[top] -= 1
        usable = {k: v for k, v in counts.items() if v}
        plan = fill(usable, window - top)
        plan[top] = plan.get(top, 0) + 1
        counts[top] += 1
        times = min(counts[k] // v for k, v in plan.items())  # the same fill, as often as it goes
        for _ in range(times):
            at = 0
            for length, copies in plan.items():
                for _ in range(copies):
                    i = waiting[length].pop()
                    sequence[i], offset[i] = n, at
                    at += length
            n += 1
        for k, v in plan.items():
            counts[k] -= v * times
            if not counts[k]:
                del counts[k]
    return sequence, offset


def _pack_group(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "row"], kind="stable", ignore_index=True)
        sequence, offset = pack_lengths(pdf["length"].to_numpy(), window)
        base = np.int64(pdf["pack"].iloc[0]) << SEQUENCE_BITS
        return pdf.drop(columns=["pack", "row"]).assign(sequence_id=base + sequence, offset=offset)

    return run


def pieces(docs: DataFrame, tokenizer: tuple, window: int = 2048) -> DataFrame:
    """Every document's token ids (END_ID last) cut at multiples of `window`: doc_id, start,
    length, doc_tokens, ids (little-endian unsigned 32-bit), row (its number in the task)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(docs, _cut(tokenizer, window), PIECES)


def pack_documents(
    docs: DataFrame, tokenizer: tuple, window: int = 2048, carry_ids: bool = True
) -> DataFrame:
    """Every piece with its place: doc_id, start, length, doc_tokens, ids_crc32, ids (unless
    `carry_ids` is off), sequence_id and offset in the sequence (gapless from 0).

    `tokenizer` is (tokenizer file, file of the same vocabulary as ranks or None, its split
    pattern or None). Null and empty texts are END_ID alone. Rows without doc_id and rows
    that repeat one are packed like any other. An empty table gives no rows.
    """
    cut = pieces(docs, tokenizer, window).withColumn("ids_crc32", F.crc32("ids"))
    # Written, so that a task run again deals its pieces as before (`row` is a task's count).
    cut = written(cut if carry_ids else cut.drop("ids"), "pieces")
    # Full windows need no company: they are dealt apart, so that neither many documents nor
    # many windows of long ones make a group large.
    full = F.col("length") == window
    n = cut.agg(F.count_if(~full).alias("rests"), F.count_if(full).alias("full")).first()
    groups, more = (max(1, math.ceil(x / GROUP_PIECES)) for x in (n["rests"], n["full"]))
    place = F.xxhash64("doc_id", "start", "ids_crc32", "row")
    dealt = cut.withColumn(
        "pack", F.when(full, F.pmod(place, F.lit(more)) + groups).otherwise(F.pmod(place, F.lit(groups)))
    )
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name != "row")
    return dealt.groupBy("pack").applyInPandas(_pack_group(window), f"{kept}, sequence_id long, offset long")
