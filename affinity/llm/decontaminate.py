"""Benchmark decontamination by spaced-seed hashing.

A mask over `SPAN` successive words hashes only the positions it selects, so a substituted
word at an ignored position leaves the hash alone. Hashes of all benchmark windows are
joined with those of all document windows; around every hit the two word sequences are
compared along the diagonal, and an overlap counts when enough words agree.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import kernels as K
from affinity.llm.common import in_arrow

SPAN = 10
MASKS = ("1110010011", "1101001011", "1010110101", "1100111010")  # 1: the position is hashed
MIN_WORDS = 10  # words that must agree (or MIN_SHARE of the item, if it is shorter than 14)
MIN_SHARE = 0.75  # of the overlap's words, at least, must agree
BLOCK = 8 << 20  # bytes of benchmark text that one pass over the documents holds

OVERLAPS = (
    "doc_id long, item_id long, doc_start int, doc_end int, item_start int, item_end int, "
    "matched int, similarity double"
)

_PLACE = K.odd_constants(SPAN * len(MASKS), 11).reshape(len(MASKS), SPAN)
_TABLE_BITS = 22
HITS = 1 << 20  # pairs of equal seeds held at once


# Scripts written without spaces: every character is a word.
_SPACELESS = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def _words(texts: list[str]) -> K.Words:
    lower = [t.lower() for t in texts]
    out = [t.encode() for t in lower]
    wide = [i for i, t in enumerate(lower) if not t.isascii()]
    if wide:
        plain = pc.replace_substring_regex(pa.array([lower[i] for i in wide]), r"[^\p{L}\p{M}\p{N}]+", " ")
        plain = pc.replace_substring_regex(plain, _SPACELESS, r" \1 ")
        for i, t in zip(wide, plain.cast(pa.binary()).to_pylist()):
            out[i] = t
    return K.Words(out, K.NOT_WORD)


def _seeds(w: np.ndarray, mask: int) -> np.ndarray:
    """The hash of every window of SPAN words under a mask, in order of its start."""
    n = max(0, len(w) - SPAN + 1)
    acc = np.zeros(n, dtype=np.uint64)
    for j, chosen in enumerate(MASKS[mask]):
        if chosen == "1":
            acc += w[j : j + n] * _PLACE[mask, j]
    return K.mix(acc)


def _needed(n: int) -> int:
    """The words of an item of n words that must agree."""
    return min(MIN_WORDS, math.ceil(MIN_SHARE * n))


class Index:
    """Seed hashes of a bounded block of benchmark items, with the words to verify."""

    def __init__(self, items: list[tuple[int, str]]):
        words = _words([t for _, t in items])
        self.ids = [i for i, _ in items]
        self.words = [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        # Items of which fewer than MIN_WORDS suffice, or just as many: (item, place) by word. One
        # more of their longest words than may differ, so one of these agrees.
        self.short = defaultdict(list)
        sizes = words.ends - words.starts
        hashes, owner, start = [], [], []
        for k, w in enumerate(self.words):
            if 0 < len(w) and MIN_SHARE * len(w) <= MIN_WORDS:
                longest = np.argsort(-sizes[words.bounds[k] : words.bounds[k + 1]], kind="stable")
                for q in longest[: len(w) - _needed(len(w)) + 1]:
                    self.short[int(w[q])].append((k, int(q)))
            for m in range(len(MASKS)):
                s = _seeds(w, m)
                hashes.append(s), owner.append(np.full(len(s), k)), start.append(np.arange(len(s)))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, int))[order]
        self.start = (np.concatenate(start) if start else np.zeros(0, int))[order]
        self.maybe = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.maybe[self.hashes & np.uint64((1 << _TABLE_BITS) - 1)] = True
        self.short_words = np.array(sorted(self.short), dtype=np.uint64)

    def hits(self, words: K.Words):
        """Arrays of (window start in the block, item number, window start in the item) of
        equal seeds, HITS pairs at a time; a seed that many items share takes several."""
        low = np.uint64((1 << _TABLE_BITS) - 1)
        for m in range(len(MASKS)):
            s = _seeds(words.hashes, m)
            at = np.flatnonzero(self.maybe[s & low])
            left = np.searchsorted(self.hashes, s[at], "left")
            many = np.searchsorted(self.hashes, s[at], "right") - left
            upto = np.cumsum(many)
            for lo in range(0, int(upto[-1]) if len(upto) else 0, HITS):
                pair = np.arange(lo, min(lo + HITS, int(upto[-1])))
                of = np.searchsorted(upto, pair, "right")
                entry = left[of] + pair - (upto[of] - many[of])
                yield at[of], self.owner[entry], self.start[entry]
        if len(self.short_words):
            at = np.flatnonzero(np.isin(words.hashes, self.short_words))
            found = [(p, k, q) for p in at.tolist() for k, q in self.short[int(words.hashes[p])]]
            if found:
                yield tuple(np.array(x) for x in zip(*found))

    def overlap(self, doc: np.ndarray, k: int, shift: int):
        """The best overlap of item k laid at word `shift` of a document, or None: the run
        of the highest score (an agreeing word +1, another -2) or, where too few of its words
        agree, the run with most agreeing words of all that have MIN_SHARE of them."""
        item = self.words[k]
        lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
        same = doc[shift + lo : shift + hi] == item[lo:hi]
        need = _needed(len(item))
        if np.count_nonzero(same) < need:
            return None
        total = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
        gain = total - np.minimum.accumulate(total)
        end = int(np.argmax(gain))
        begin = int(np.argmin(total[: end + 1]))
        matched = int(same[begin:end].sum())
        if matched < need or matched < MIN_SHARE * (end - begin):
            begin, end = _longest(same)
            matched = int(same[begin:end].sum())
            if matched < need:
                return None
        return matched, shift + lo + begin, shift + lo + end, lo + begin, lo + end


def _longest(same: np.ndarray) -> tuple[int, int]:
    """The run with most agreeing words, of all runs of which MIN_SHARE agree."""
    agree = np.concatenate([[0], np.cumsum(same)])
    spare = agree - MIN_SHARE * np.arange(len(agree))  # no less at a run's end than at its start
    # for every end the leftmost start: the first place where the least so far is low enough
    begin = np.searchsorted(-np.minimum.accumulate(spare), -spare, "left")
    end = int(np.argmax(agree - agree[begin]))
    kept = np.flatnonzero(same[begin[end] : end]) + begin[end]
    return int(kept[0]), int(kept[-1]) + 1


def _found(ix: Index, texts: list[str]) -> list[tuple]:
    """(text number, item number, overlap) of all overlaps. Where those of one text and item
    share words of the text, the better one counts, so the others lie apart from it."""
    words = _words(texts)
    diagonals = []
    for p, k, q in ix.hits(words):
        d = np.searchsorted(words.bounds, p, "right") - 1
        diagonals.append(np.unique(np.stack([d, k, p - words.bounds[d] - q], axis=1), axis=0))
    if not diagonals:
        return []
    good = defaultdict(list)
    for d, k, shift in np.unique(np.concatenate(diagonals), axis=0).tolist():
        got = ix.overlap(words.hashes[words.bounds[d] : words.bounds[d + 1]], k, shift)
        if got:
            good[d, k].append(got)
    out = []
    for (d, k), every in good.items():
        starts, ends = [], []  # of the ranges taken, ascending
        for got in sorted(every, reverse=True):
            at = bisect_right(starts, got[1])
            if (at and ends[at - 1] > got[1]) or (at < len(starts) and starts[at] < got[2]):
                continue
            starts.insert(at, got[1])
            ends.insert(at, got[2])
            out.append((d, k, got))
    return out


def _in_blocks(ix: Index, batch: pa.RecordBatch):
    texts = [t or "" for t in batch.column("text").cast(pa.string()).to_pylist()]
    for lo, hi in K.blocks(texts):
        yield lo, _found(ix, texts[lo:hi])


def _search(index):
    def run(batches):
        ix = index.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo, found in _in_blocks(ix, batch):
                rows = [
                    (ids[lo + d], ix.ids[k], g[1], g[2], g[3], g[4], g[0], g[0] / (g[2] - g[1])) for d, k, g in found
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES
                    )

    return run


def _filter(index):
    def run(batches):
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            for lo, found in _in_blocks(index.value, batch):
                clean[[lo + d for d, _, _ in found]] = False
            yield batch.filter(pa.array(clean))

    return run


_NAMES = [x.split()[0] for x in OVERLAPS.split(", ")]
_TYPES = [
    {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[x.split()[1]] for x in OVERLAPS.split(", ")
]


def _indexes(benchmark: DataFrame):
    """Broadcast indexes of the benchmark's non-null texts, about BLOCK bytes of text each."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for b in range(n_blocks):
        held = [(r["item_id"], r["text"]) for r in items.where(block == b).collect()]  # about BLOCK bytes
        yield benchmark.sparkSession.sparkContext.broadcast(Index(held))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per overlap of a document and a benchmark item, with its word ranges in both,
    the words that agree and their share. An item that stands several times in a document
    has a row each; overlaps of one item never share words of the document.

    Words are runs of letters, marks and digits, lower-cased, and single characters in
    scripts without spaces. The benchmark is held in blocks of
    bounded size, one pass over the documents each, so it may be of any size. Null and empty
    texts overlap with nothing, on either side; repeated rows are reported each; rows
    without an id are reported with a null id; further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return reduce(DataFrame.unionByName, (in_arrow(docs, _search(x), OVERLAPS) for x in _indexes(benchmark)))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that overlap with no benchmark item, with all their columns. Every
    row is judged by its own text, whether its doc_id is null, repeated or neither."""
    for index in _indexes(benchmark):
        docs = in_arrow(docs, _filter(index), docs.schema)
    return docs
