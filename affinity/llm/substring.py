"""Repeated passages by content-defined chunks, extended to their true byte ends.

A gear hash rolls over the `WINDOW` bytes up to a place; a cut falls where it is the smallest
of some `REACH` successive ones, so cuts move with the text and lie at most REACH bytes apart.
Chunks run from cut to cut and are de-duplicated by digest. Texts that share 2 * REACH +
WINDOW - 1 bytes have two successive cuts in common there, whatever stands around, hence a
chunk. Repeated chunks that follow each other wherever they stand are joined to stretches; the
bytes around a stretch are compared with those around its other occurrences, and ranges that
touch make one passage.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import kernels as K
from affinity.llm.common import in_arrow, written

WINDOW, REACH = 8, 46  # any 99 bytes hold a whole chunk
LEAST = 32  # bytes that a digest speaks for at least: the chunk's, the gear window's, those that follow
MIN_BYTES = 101  # of a passage that is reported: 51 words of one letter and the blanks between
AROUND = 48  # bytes compared on either side: a shared cut lies no farther from a passage's ends
SPARE = 4  # last bytes of a stretch kept with what follows it, to end on a whole character
WIDTH = AROUND + SPARE
SAMPLE_DOCS = 20_000  # documents about, in which hot chunks are sought; decides where rows go, not the result
HOT_SHARE = 1000  # a chunk is hot if one in so many chunks is its copy

CHUNKS = "doc_id long, text_hash long, digest long, spot long"  # spot: 256 * place + bytes to the next cut
SEEDS = "doc_id long, text_hash long, start int, size int, n int, d1 long, d2 long, before binary, after binary"

_GEAR = K.mix(np.arange(256, dtype=np.uint64) + np.uint64(77)).astype(np.uint32)
_VALUE = K.odd_constants(256, 21)
_BASE = 0x5851F42D4C957F2D  # odd
_TOP = np.uint32(0xFFFFFFFF)
_PAIR = struct.Struct("<qq")


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash (twice the hash before, plus the byte's value) of the WINDOW bytes that
    end at every place; the window is doubled instead of rolled."""
    h, width = _GEAR[data], 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, 2 * width
    return h


def _sliding(h: np.ndarray, least) -> np.ndarray:
    """`least` (np.minimum or np.maximum) of every REACH successive values."""
    width = 1
    while width < REACH:
        step = min(width, REACH - width)
        h = least(h[:-step], h[step:])
        width += step
    return h


def cuts(h: np.ndarray) -> np.ndarray:
    """Ascending places whose value is the smallest of some REACH successive ones. Where the
    same value returns over and over, as in periodic text, about one in LEAST places is kept."""
    if len(h) <= REACH:
        at = np.flatnonzero(h == h.min())
    else:
        beside = np.zeros(REACH - 1, dtype=h.dtype)
        at = np.flatnonzero(_sliding(np.concatenate([beside, _sliding(h, np.minimum), beside]), np.maximum) == h)
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (h[at[1:]] != h[at[:-1]]) | (np.diff(at) > REACH)
    order = np.arange(len(at))
    head = np.maximum.accumulate(np.where(fresh, order, 0))
    since = at - at[head]
    keep = order - head < 4
    keep[1:] |= since[1:] // LEAST != since[:-1] // LEAST
    return at[keep]


def _end(place, stop, length):
    """Where the bytes end that the digest of the chunk from `place` to `stop` speaks for."""
    return np.minimum(np.maximum(stop, place + LEAST - WINDOW + 1), length)


def _chunk(batches):
    for batch in batches:
        ids, hashes = batch.column("doc_id"), batch.column("text_hash")
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in K.blocks(texts):
            data = np.frombuffer(b"".join(texts[lo:hi]), dtype=np.uint8)
            lengths = np.fromiter((len(t) for t in texts[lo:hi]), dtype=np.int64, count=hi - lo)
            begins = np.cumsum(lengths) - lengths
            long = np.flatnonzero(lengths >= LEAST)
            if not len(long):
                continue
            # characters begin where no continuation byte stands; a text is cut by its own bytes alone
            h = np.where((data & 0xC0) == 0x80, _TOP, gear(data))
            h[(begins[long][:, None] + np.arange(WINDOW - 1)).ravel()] = _TOP
            at, owner = [], []
            for i in long:
                found = cuts(h[begins[i] : begins[i] + lengths[i]])
                found = np.concatenate([[0], found[found > 0]])
                at.append(found), owner.append(np.full(len(found), i))
            at, owner = np.concatenate(at), np.concatenate(owner)
            last = np.append(owner[1:] != owner[:-1], True)
            stop = np.where(last, lengths[owner], np.append(at[1:], 0))
            lead = np.minimum(at, WINDOW - 1)
            a, b = begins[owner] + at - lead, begins[owner] + _end(at, stop, lengths[owner])
            shape = K.mix((lead * (1 << 32) + stop - at).astype(np.uint64))
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(_VALUE[data] * K.powers(_BASE, len(data)), out=total[1:])
            digest = K.mix((total[b] - total[a]) * K.powers(pow(_BASE, -1, 1 << 64), len(data))[a] + shape)
            owner = pa.array(owner + lo)
            spot = pa.array(at * 256 + stop - at)  # cuts are fewer than 256 bytes apart
            yield pa.RecordBatch.from_arrays(
                [ids.take(owner), hashes.take(owner), pa.array(digest.view(np.int64)), spot],
                names=["doc_id", "text_hash", "digest", "spot"],
            )


def chunks(docs: DataFrame) -> DataFrame:
    """Every chunk of the texts of at least LEAST bytes: its place and length in bytes, and a
    digest of 64 bits, which finds repeated chunks; whole stretches are told apart by 128."""
    return in_arrow(docs, _chunk, CHUNKS)


def _stretch(batches):
    """Joins the repeated chunks of a text that follow each other wherever they stand, and
    adds a digest of each stretch and the AROUND bytes on either side, those before in reverse."""
    names = [x.split()[0] for x in SEEDS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    for batch in batches:
        if not batch.num_rows:
            continue
        seeds = batch.column("seeds")
        owner = np.repeat(np.arange(batch.num_rows), seeds.value_lengths().to_numpy())
        spot, link = seeds.flatten().flatten()
        known, link = link.is_valid().to_numpy(zero_copy_only=False), link.fill_null(0).to_numpy()
        place = spot.to_numpy() >> 8
        stop = place + (spot.to_numpy() & 255)
        joined = (owner[1:] == owner[:-1]) & (stop[:-1] == place[1:]) & known[1:] & known[:-1]
        joined &= (link[1:] >> 32).astype(np.int32) == link[:-1].astype(np.int32)
        first = np.flatnonzero(np.append(True, ~joined))
        last = np.append(first[1:], len(place)) - 1
        ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
        rows, row, text = [], -1, b""
        for f, e in zip(first.tolist(), last.tolist()):
            if owner[f] != row:
                row = int(owner[f])
                text = batch.column("text")[row].as_py().encode()
            a = int(place[f]) - min(int(place[f]), WINDOW - 1)
            b = int(_end(place[e], stop[e], len(text)))
            d1, d2 = _PAIR.unpack(hashlib.blake2b(text[a:b], digest_size=16).digest())
            before, after = text[max(0, a - AROUND) : a][::-1], text[b - SPARE : b + AROUND]
            rows.append((ids[row], hashes[row], a, b - a, e - f + 1, d1, d2, before, after))
            if len(rows) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _matrix(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(v.ljust(WIDTH, b"\0") for v in values), dtype=np.uint8)
    return flat.reshape(-1, WIDTH), np.fromiter((len(v) for v in values), dtype=np.int64, count=len(values))


def _common(m: np.ndarray, size: np.ndarray, x, y) -> np.ndarray:
    """How many first bytes rows x and y have in common."""
    differ = m[x] != m[y]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH)
    return np.minimum(first, np.minimum(size[x], size[y]))


def _whole(column: str, m: np.ndarray, size: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Lengths cut back to whole characters (at most three bytes), without blanks at the end."""
    rows = np.arange(len(n))
    while True:
        last = m[rows, np.maximum(n - 1, 0)]
        edge = last if column == "before" else m[rows, np.minimum(n, WIDTH - 1)]
        split = ((edge & 0xC0) == 0x80) & ((n < size) | (column == "before"))
        less = (n > 0) & (split | K.SPACES[last])
        if not less.any():
            return n
        n = n - less


def _keys(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)


def _join(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _against_first(batches):
    """Rows ascend by digest, document and start. Adds the first document of the digest, and
    the bytes in common with its first occurrence; repeated occurrences are left out."""
    first = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = [x for x in (first, last) if x is not None]
        rows = _join([*held, batch])
        digest, place = _keys(rows, ["d1", "d2"]), _keys(rows, ["doc_id", "text_hash", "start"])
        n = rows.num_rows
        new = np.ones(n, dtype=bool)
        new[1:] = (digest[1:] != digest[:-1]).any(axis=1)
        again = np.zeros(n, dtype=bool)
        again[1:] = ~new[1:] & (place[1:] == place[:-1]).all(axis=1)
        hub = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        shared = []
        for column in ("before", "after"):
            m, size = _matrix(rows.column(column).to_pylist())
            shared.append(_whole(column, m, size, _common(m, size, np.arange(n), hub)))
        own = (place == place[hub]).all(axis=1)
        out = rows
        for name, value in (
            ("first_doc_id", place[hub, 0]),
            ("own", own),
            ("first_before", shared[0].astype(np.int32)),
            ("first_after", shared[1].astype(np.int32)),
        ):
            out = out.append_column(name, pa.array(value))
        keep = ~again
        keep[: len(held)] = False
        first, last = rows.slice(int(hub[-1]), 1), rows.slice(n - 1, 1)
        yield out.filter(pa.array(keep))


def _against_next(column: str):
    """Rows ascend by digest and `column`. Adds the most bytes in common with another row of
    the digest, which is the one before or the one after. A digest's only row (its chunks met
    others by a digest of 64 bits alone) is left out."""

    def finish(rows, skip, stop):
        digest = _keys(rows, ["d1", "d2"])
        m, size = _matrix(rows.column(column).to_pylist())
        x = np.arange(rows.num_rows - 1)
        same = (digest[1:] == digest[:-1]).all(axis=1)
        step = np.where(same, _common(m, size, x, x + 1), 0)
        most = _whole(column, m, size, np.maximum(np.append(step, 0), np.append(0, step)))
        several = pa.array((np.append(same, False) | np.append(False, same))[skip:stop])
        rows = rows.append_column(f"any_{column}", pa.array(most.astype(np.int32)))
        return rows.slice(skip, stop - skip).filter(several)

    def run(batches):
        held, skip = None, 0  # the last row waits for its neighbour; the one before it is done
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else _join([held, batch])
            n = rows.num_rows
            yield finish(rows, skip, n - 1)
            keep = min(2, n)
            held, skip = rows.slice(n - keep, keep), keep - 1
        if held is not None:
            yield finish(held, skip, held.num_rows)

    return run


def _hot(docs: DataFrame) -> DataFrame | None:
    """What `_spread` adds, of chunks that would fill a task, summed before they are
    shuffled: a table of about HOT_SHARE rows at most, None if there is no such chunk."""
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    every = max(1, rows // SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(every)) == 0)
    enough = max(64, (size or 0) * 2 // (REACH * every * HOT_SHARE))
    found = chunks(sample).groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") >= enough)
    hot = written(found.select("digest"), "hot-chunks")
    if hot.isEmpty():
        return None
    whole = _placed(chunks(docs).join(F.broadcast(hot), "digest")).groupBy("digest")
    return written(whole.agg(*(f.alias(c) for c, f in _spread().items())), "hot-places")


def _placed(every: DataFrame) -> DataFrame:
    place = F.shiftright("spot", 8)
    mark = lambda at: F.xxhash64("doc_id", "text_hash", at)
    return every.withColumns({"here": mark(place), "there": mark(place + F.col("spot").bitwiseAND(255))})


def _spread() -> dict:
    """Of a digest: whether it stands at several places, and sums over its places and those
    of the chunks after it (null if too large; then the chunk is joined to no other)."""
    total = lambda c: F.try_sum(F.shiftright(c, 24))
    return {"least": F.min("here"), "most": F.max("here"), "follows": total("here"), "leads": total("there")}


def _repeated(docs: DataFrame) -> DataFrame:
    """Every chunk that stands at several places: doc_id, text_hash, spot, link (the low halves
    of both sums). Hot ones stay where they are, the others meet by digest."""
    every, hot = chunks(docs), _hot(docs)
    rest = every if hot is None else every.join(F.broadcast(hot), "digest", "left_anti")
    digest = Window.partitionBy("digest")
    # places are hashed after the shuffle, which carries the narrow rows alone
    found = _placed(rest.repartition("digest")).withColumns({c: f.over(digest) for c, f in _spread().items()})
    if hot is not None:
        found = found.unionByName(_placed(every).join(F.broadcast(hot), "digest"))
    low = F.col("leads").bitwiseAND(F.lit((1 << 32) - 1))
    link = F.shiftleft("follows", 32).bitwiseOR(low).alias("link")
    return found.where("least < most").select("doc_id", "text_hash", "spot", link)


def repeated_passages(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, start, end (bytes), n_chunks, first_doc_id, kept, copies: every passage of at
    least `min_bytes` whose bytes also stand in another document or elsewhere in the same.

    Ends are the true ends, on whole characters, without blanks. n_chunks are the chunks that
    repeat in the passage, first_doc_id the smallest document that has one of its stretches,
    and `kept` is true in that document. `copies` are the (start, end) of the stretches that
    stand at an earlier place, in a smaller document or before in the same: a passage may join
    stretches of several origins, and removing the copies everywhere leaves the first of each.
    Null and empty texts and rows without doc_id have no passages; rows that repeat a doc_id
    and its text are one, another text under the same doc_id has passages of its own; further
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    seeds = (
        _repeated(docs)
        .repartition("doc_id", "text_hash")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("spot", "link"))).alias("seeds"))
        .join(docs, ["doc_id", "text_hash"])
        .select("doc_id", "text_hash", "text", "seeds")
    )
    places = ("doc_id", "text_hash", "start")
    found = in_arrow(seeds, _stretch, SEEDS).repartition("d1", "d2").sortWithinPartitions("d1", "d2", *places)
    held = f"{SEEDS}, first_doc_id long, own boolean, first_before int, first_after int"
    found = in_arrow(found, _against_first, held)
    for column in ("before", "after"):
        held += f", any_{column} int"
        found = in_arrow(found.sortWithinPartitions("d1", "d2", column), _against_next(column), held)
    found = found.select(
        "doc_id",
        "text_hash",
        "first_doc_id",
        "own",
        "n",
        (F.col("start") - F.col("any_before")).alias("start"),
        (F.col("start") + F.col("size") - SPARE + F.col("any_after")).alias("end"),
        (F.col("start") - F.col("first_before")).alias("from"),
        (F.col("start") + F.col("size") - SPARE + F.col("first_after")).alias("to"),
    )
    copy = lambda c: F.when(~F.col("own"), F.col(c))
    by_start = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    by_copy = Window.partitionBy("doc_id", "text_hash", "run").orderBy("from", "to")
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("start") > F.max("end").over(past(by_start)), F.lit(True))
    cut = ~F.col("own") & F.coalesce(F.col("from") > F.max(copy("to")).over(past(by_copy)), F.lit(True))
    return (
        found.withColumn("apart", apart.cast("int"))
        .withColumn("run", F.sum("apart").over(so_far(by_start)))
        .withColumn("cut", cut.cast("int"))
        .withColumn("piece", F.sum("cut").over(so_far(by_copy)))
        .groupBy("doc_id", "text_hash", "run", "piece")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("n").alias("n_chunks"),
            F.min("first_doc_id").alias("first_doc_id"),
            F.min(copy("from")).alias("from"),
            F.max(copy("to")).alias("to"),
        )
        .groupBy("doc_id", "text_hash", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("n_chunks").alias("n_chunks"),
            F.min("first_doc_id").alias("first_doc_id"),
            F.sort_array(
                F.collect_list(F.when(F.col("from").isNotNull(), F.struct(F.col("from").alias("start"), F.col("to").alias("end"))))
            ).alias("copies"),
        )
        .where(F.col("end") - F.col("start") >= min_bytes)
        .select(
            "doc_id",
            "start",
            "end",
            "n_chunks",
            "first_doc_id",
            (F.col("doc_id") == F.col("first_doc_id")).alias("kept"),
            "copies",
        )
    )
