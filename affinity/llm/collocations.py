"""Phrase collocations by best-first branch and bound.

1. Words are counted per language; a word's id is a 64-bit hash of language and word,
   checked to be unique among the counted words. Runs of frequent words are written as ids.
2. A phrase scores 1000 * a * n / (l * r) at its worst cut. Its count a is at most that of
   any part, so no phrase that starts with a word of count f scores above 1000 * n / f.
   Words are expanded in the order of this bound: each round takes the best part of a
   language's frontier and grows all its prefixes word by word, keeping those that are
   frequent enough.
3. A round counts the suffixes that the cuts of the new phrases need, and the words around
   each phrase: a phrase that always has the same neighbour lies inside a longer one with
   the same count, and is dropped.
4. A language is settled when its best unexpanded bound is below its `top`-th surviving
   score. Then no other phrase can enter the list, ties included.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import kernels as K
from affinity.llm.common import BROADCAST_ROWS, broadcast_if_small, in_arrow, written

MAX_WORDS = 5
UNKNOWN = "und"
#: A set of ids or phrases as bits; a wrong hit only counts a phrase in vain.
FILTER_BITS = 1 << 25
TASK_WORDS = 1 << 20  # words of runs that a task counts together
ROW_WORDS = 512  # words of runs in a row
ROUND_SHARE = (8, 2)  # the first rounds reach this part of a language's frequent words
ROUNDS = len(ROUND_SHARE)  # before the last one, which takes the rest
SALTS = 64
AROUND = ("before_min", "before_max", "after_min", "after_max")
RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"

# What ends a piece, and what separates words.
_PIECE_END = K.byte_table(b".,;:!?\n\x0b\x0c\r")
_BREAKS = _PIECE_END | K.byte_table(b" \t")
_STEP = K.odd_constants(MAX_WORDS, 12)
WORDS = [f"w{i}" for i in range(1, MAX_WORDS + 1)]


def _tokens(batches, seed: int):
    """Per block of texts of one language: the joined text, starts, ends and ids of its
    words, and whether each word goes on the piece of the word before it. An id depends on
    language, word and `seed`."""
    base, own, place = (int(x) for x in K.odd_constants(3, 40 + seed))
    byte_value = K.odd_constants(256, 80 + seed)
    inverse = pow(base, -1, 1 << 64)

    def hashes(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(byte_value[joined] * K.powers(base, len(joined)), out=total[1:])
        h = (total[ends] - total[starts]) * K.powers(inverse, len(joined))[starts]
        return h + (ends - starts).astype(np.uint64) * np.uint64(own)

    for batch in batches:
        by_lang = defaultdict(list)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            by_lang[lang].append(text.lower())
        for lang, texts in by_lang.items():
            name = np.frombuffer(b"l" + lang.encode(), np.uint8)
            of_lang = hashes(name, np.array([0]), np.array([len(name)])) * np.uint64(place)
            for lo, hi in K.blocks(texts):
                joined = b"\n".join(texts[lo:hi])
                b = np.frombuffer(joined, np.uint8)
                inside = np.concatenate([[False], ~_BREAKS[b], [False]])
                change = np.flatnonzero(inside[1:] != inside[:-1])
                starts, ends = change[0::2], change[1::2]
                if not len(starts):
                    continue
                ids = K.mix(hashes(b, starts, ends) + of_lang)
                ids[ids == 0] = 1  # 0 stands for the end of a run
                piece = np.cumsum(_PIECE_END[b])[starts]
                goes_on = np.zeros(len(piece), bool)
                goes_on[1:] = piece[1:] == piece[:-1]
                yield lang, joined, starts, ends, ids, goes_on


def _count_words(seed: int):
    def run(batches):
        for lang, joined, starts, ends, ids, _ in _tokens(batches, seed):
            known, first, n = np.unique(ids, return_index=True, return_counts=True)
            spelled = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(known), pa.string()),
                    pa.array(known.view(np.int64)),
                    pa.array(spelled, pa.binary()).cast(pa.string()),
                    pa.array(n, pa.int64()),
                ],
                names=["lang", "id", "word", "n"],
            )

    return run


class Filter:
    """A set of 64-bit values as a power of two of bits, without false negatives."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, values: np.ndarray) -> np.ndarray:
        cell, bit = places(values, len(self.bits) * 64)
        return (self.bits[cell] & bit) != 0


def places(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of 64 bits and the bit in it that a value has among `bits`."""
    at = values >> np.uint64(65 - bits.bit_length())
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _grown(keys: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Hashes of phrases of `length` words from those of their prefixes and the last words;
    a phrase of one word has its id."""
    return K.mix(keys * _STEP[length - 1] + ids)


def _places(bits: int):
    def run(batches):
        for batch in batches:
            words = [batch.column(c).to_numpy().view(np.uint64) for c in WORDS]
            key = words[0]
            for j, w in enumerate(words[1:], 2):
                key = np.where(w != 0, _grown(key, w, j), key)
            cell, bit = places(key, bits)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bit.view(np.int64))], names=["cell", "bit"])

    return run


def _filter_of(phrases: DataFrame, bits: int) -> Filter:
    """The filter of the phrases in columns WORDS (0 where shorter). Whatever the table's
    size, at most bits / 64 rows of two numbers reach the driver."""
    cells = in_arrow(phrases.select(*WORDS), _places(bits), "cell long, bit long")
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return Filter(table.view(np.uint64))


def _write_runs(seed: int, frequent):
    """Runs of frequent words inside a piece, each followed by a 0, cut into rows of about
    ROW_WORDS at ends of runs. Words without a frequent neighbour are left out."""

    def run(batches):
        for _, _, _, _, ids, goes_on in _tokens(batches, seed):
            keep = frequent.value.has(ids)
            joined = np.zeros(len(ids) + 1, bool)  # word i and the one before it are in one run
            joined[1:-1] = (keep[1:] & keep[:-1] & goes_on[1:])
            inside = joined[:-1] | joined[1:]
            at = np.flatnonzero(inside)
            if not len(at):
                continue
            last = ~joined[1:][at]  # the run ends with this word
            out = np.zeros(len(at) + int(last.sum()), np.int64)
            out[np.arange(len(at)) + np.cumsum(last) - last] = ids[at].view(np.int64)
            ends = np.flatnonzero(out == 0) + 1
            cuts = np.unique(ends[np.searchsorted(ends, np.arange(ROW_WORDS, len(out) + ROW_WORDS, ROW_WORDS)).clip(max=len(ends) - 1)])
            offsets = np.concatenate([[0], cuts]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(out))], names=["ids"])

    return run


def _buffers(batches):
    """The rows of runs, about TASK_WORDS words at a time."""
    held, size = [], 0
    for batch in batches:
        column = batch.column("ids")
        offsets, flat = column.offsets.to_numpy().astype(np.int64), column.flatten().to_numpy().view(np.uint64)
        offsets = offsets - offsets[0]
        lo = 0
        while lo < len(offsets) - 1:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + TASK_WORDS - size, side="right")) - 1)
            held.append(flat[offsets[lo] : offsets[hi]])
            size += len(held[-1])
            lo = hi
            if size >= TASK_WORDS or lo < len(offsets) - 1:
                yield np.concatenate(held)
                held, size = [], 0
    if size:
        yield np.concatenate(held)


def _equal_rows(hashes: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows are neighbours, and where they start in it. Rows whose
    hashes clash may start more than once; Spark adds them up again."""
    order = np.argsort(hashes)
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.flatnonzero(new)


def _extend(length: int, prefixes):
    """Counts of the phrases of `length` words whose prefix passes the filter."""

    def run(batches):
        for ids in _buffers(batches):
            at = np.flatnonzero(ids)
            key = ids[at]
            for j in range(1, length):  # a run ends with a 0, so at + j stays inside
                if j > 1:
                    key = _grown(key, ids[at + j - 1], j)
                goes_on = ids[at + j] != 0
                if j == length - 1:
                    goes_on &= prefixes.value.has(key)
                at, key = at[goes_on], key[goes_on]
            if not len(at):
                continue
            words = [ids[at + j] for j in range(length)]
            order, first = _equal_rows(_grown(key, words[-1], length), words)
            pick = order[first]
            zero = np.zeros(len(pick), np.int64)
            full = [w[pick].view(np.int64) for w in words] + [zero] * (MAX_WORDS - length)
            counts = np.diff(np.append(first, len(order)))
            yield pa.RecordBatch.from_arrays([*map(pa.array, full), pa.array(counts)], names=[*WORDS, "n"])

    return run


def _surroundings(wanted):
    """Counts of the phrases of two and more words that pass the filter, with the smallest and
    the largest id of the words before and after them (0: a run starts or ends)."""

    def run(batches):
        for ids in _buffers(batches):
            at = np.flatnonzero(ids)
            key = ids[at]
            for length in range(2, MAX_WORDS + 1):
                last = ids[at + length - 1]
                at, key, last = (x[last != 0] for x in (at, key, last))
                if not len(at):
                    break
                key = _grown(key, last, length)
                hit = wanted.value.has(key)
                where = at[hit]
                if not len(where):
                    continue
                words = [ids[where + j] for j in range(length)]
                order, first = _equal_rows(key[hit], words)
                before = np.where(where > 0, ids[where - 1], 0).view(np.int64)[order]
                after = ids[where + length].view(np.int64)[order]
                pick = order[first]
                zero = np.zeros(len(pick), np.int64)
                full = [w[pick].view(np.int64) for w in words] + [zero] * (MAX_WORDS - length)
                around = [f.reduceat(x, first) for x in (before, after) for f in (np.minimum, np.maximum)]
                counts = np.diff(np.append(first, len(order)))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, full), pa.array(counts), *map(pa.array, around)], names=[*WORDS, "n", *AROUND]
                )

    return run


def _scan(runs: DataFrame, task, filtered: DataFrame, bits: int, columns: tuple[str, ...] = ()) -> DataFrame:
    """A pass over the runs with a filter of the phrases of `filtered`; counts added up."""
    shared = runs.sparkSession.sparkContext.broadcast(_filter_of(filtered, bits))
    schema = ", ".join(f"{c} long" for c in (*WORDS, "n", *columns))
    sums = [F.sum("n").alias("n"), *((F.max if c.endswith("max") else F.min)(c).alias(c) for c in columns)]
    return in_arrow(runs, task(shared), schema).groupBy(*WORDS).agg(*sums)


def _phrase() -> Column:
    words = F.array(*WORDS)
    return F.slice(words, F.lit(1), F.size(F.filter(words, lambda x: x != 0)))


def word_table(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, int]:
    """(lang, id, word, n) of all words, and the seed under which no two words of which one
    may be frequent share an id. `docs` has lang and text without nulls."""
    while True:
        counted = in_arrow(docs, _count_words(seed), "lang string, id long, word string, n long")
        words = written(counted.groupBy("lang", "id", "word").agg(F.sum("n").alias("n")), "phrase-words")
        if words.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
            return words, seed
        seed += 1


def _in_rounds(words: DataFrame, at_least: int) -> DataFrame:
    """The frequent words with their language's total, their bound, and the round that they
    are expanded in: the highest bounds first, by powers of two of the count (at most 63
    groups a language), up to growing parts of the language's words."""
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.where(F.col("n") >= at_least).withColumn("size", F.length(F.bin("n")))
    groups = frequent.groupBy("lang", "size").agg(F.sum("n").alias("held"))
    up_to = Window.partitionBy("lang").orderBy("size")
    groups = groups.withColumns({
        "below": F.sum("held").over(up_to) - F.col("held"), "all": F.sum("held").over(Window.partitionBy("lang")),
    })
    turn = F.lit(ROUNDS)
    for i in reversed(range(ROUNDS)):
        turn = F.when(F.col("below") * ROUND_SHARE[i] < F.col("all"), F.lit(i)).otherwise(turn)
    return (
        frequent.join(totals, "lang")
        .join(groups.select("lang", "size", turn.alias("turn")), ["lang", "size"])
        .select("lang", "id", "word", "n", "total", F.expr("1000 * total div n").alias("bound"), "turn")
    )


def _top(scored: DataFrame, top: int) -> DataFrame:
    """Each language's rows up to rank `top` by score and count, ties included. Salted, so
    that a language's phrases meet only as the best of each salt."""
    salted = scored.withColumn("salt", F.pmod(F.xxhash64(*WORDS), F.lit(SALTS)))
    for keys in (("lang", "salt"), ("lang",)):
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("a").desc())
        salted = salted.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place")
    return salted.drop("salt")


def _scored(counts: DataFrame, starts: DataFrame, words: DataFrame, at_least: int) -> DataFrame:
    """The surviving candidates that begin with a word of `starts`, with the cut that counts."""
    known = counts.select(_phrase().alias("phrase"), "n").unionByName(
        words.select(F.array("id").alias("phrase"), "n")
    )
    known = broadcast_if_small(written(known, "phrase-parts"), BROADCAST_ROWS // 16)
    size = F.size("phrase")
    same = [(F.col(f"{x}_min") == F.col(f"{x}_max")) & (F.col(f"{x}_min") != 0) for x in ("before", "after")]
    first = starts.select(F.col("id").alias("w1"), "lang", "total")
    candidates = (
        counts.where(F.col("n") >= at_least)
        .withColumn("phrase", _phrase())
        .where((size == MAX_WORDS) | ~(same[0] | same[1]))
        .join(broadcast_if_small(first, BROADCAST_ROWS // 4), "w1")
        .select("lang", "total", *WORDS, "phrase", F.col("n").alias("a"))
    )
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    for name, part in (
        ("l", F.slice("phrase", F.lit(1), F.col("k"))),
        ("r", F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k"))),
    ):
        of = known.select(F.col("phrase").alias("part"), F.col("n").alias(name))
        cuts = cuts.withColumn("part", part).join(of, "part").drop("part")
    score = F.expr(
        "(cast(1000 AS decimal(4,0)) * cast(a AS decimal(15,0)) * cast(total AS decimal(17,0)))"
        " div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
    )
    best = cuts.groupBy("lang", *WORDS, "a", F.col("total").alias("n")).agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    return best.select("lang", *WORDS, "a", "n", "cut.l", "cut.r", "cut.score")


def _parts(grown: DataFrame) -> DataFrame:
    """The phrases and, of each, the suffixes of two and more words."""
    shifted = [
        F.array(*(F.col(w) for w in WORDS[k:]), *([F.lit(0).cast("long")] * k)) for k in range(MAX_WORDS - 1)
    ]
    part = grown.select(F.explode(F.array(*shifted)).alias("p"))
    return part.select(*(F.col("p")[i].alias(w) for i, w in enumerate(WORDS))).where("w2 <> 0").distinct()


def collocations(
    docs: DataFrame, top: int = 2000, at_least: int = 100, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of every language of `docs` (text, lang) its
    first `top` phrases of 2 to MAX_WORDS words.

    A-Z are lower-cased; texts break into pieces at . , ; : ! ? and line ends, pieces into
    words at spaces and tabs. a, l and r count all occurrences of the phrase and of the two
    parts of its lowest-scoring cut, n all words of the language. Only phrases with a >=
    `at_least` count, and only those that lie in no longer one of as many occurrences. A
    null text is empty, a null lang is `und`; repeated rows count again; doc_ids play no
    part. Languages without such phrases, and empty tables, give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")
    ).where("text <> ''")
    vocabulary, seed = word_table(docs)
    words = written(_in_rounds(vocabulary, at_least), "phrase-frequent")
    none = [F.lit(0).cast("long").alias(w) for w in WORDS[1:]]
    frequent = spark.sparkContext.broadcast(_filter_of(words.select(F.col("id").alias("w1"), *none), filter_bits))
    runs = written(in_arrow(docs, _write_runs(seed, frequent), "ids array<long>"), "phrase-runs")
    best = None
    for turn in range(ROUNDS + 1):
        starts = words.where(F.col("turn") == turn)
        if best is not None:
            settled = best.groupBy("lang").agg(F.count("*").alias("c"), F.min("score").alias("least"))
            starts = starts.join(settled.where(F.col("c") >= top), "lang", "left").where(
                "least IS NULL OR bound >= least"
            )
        starts = written(starts.select("lang", "id", "total"), "phrase-starts")
        if starts.isEmpty():
            continue
        first = broadcast_if_small(starts.select(F.col("id").alias("w1")))
        grown, level = None, starts.select(F.col("id").alias("w1"), *none)
        for length in range(2, MAX_WORDS + 1):
            counted = _scan(runs, lambda f, length=length: _extend(length, f), level, filter_bits)
            level = counted.where(F.col("n") >= at_least).join(first, "w1", "left_semi").select(*WORDS)
            level = written(level, "phrase-level")
            grown = level if grown is None else grown.unionByName(level)
        counts = written(_scan(runs, _surroundings, _parts(grown), filter_bits, AROUND), "phrase-counts")
        scored = _scored(counts, starts, words, at_least)
        best = written(_top(scored if best is None else best.unionByName(scored), top), "phrase-best")
    if best is None:
        return spark.createDataFrame([], RESULT)
    spelled = best
    names = broadcast_if_small(words.select("id", "word"), BROADCAST_ROWS // 4)
    for w in WORDS:
        of = names.select(F.col("id").alias(w), F.col("word").alias(f"{w}_word"))
        spelled = spelled.join(of, w, "left")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        spelled.withColumn("phrase", F.concat_ws(" ", *(f"{w}_word" for w in WORDS)))
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
