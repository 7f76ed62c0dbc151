"""Source mixing, phrase collocations and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import collocations as C
from affinity.llm import mixing as M
from affinity.llm import prefix_trie as T
from tests.llm.cases import CLASHING, DOCS, frame, hostile, sentence

# ---------------------------------------------------------------- mixing


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def mix_brute(rows, mix):
    """(doc_id, size, source_size, target, taken) by sharing the excess round by round and
    taking rows in the order of their hash."""
    size = [words_of(r[1]) for r in rows]
    total = Counter()
    for r, s in zip(rows, size):
        total[r[3]] += s
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    target, left, open_ = {s: Fraction(0) for s in order}, Fraction(sum(total.values()) * mix.share[0], mix.share[1]), set(order)
    while left and open_:
        parts = sum(weight[s] for s in open_)
        excess = Fraction(0)
        for s in list(open_):
            target[s] += left * weight[s] / parts
        for s in list(open_):
            if target[s] > mix.repeats * total[s]:
                excess += target[s] - mix.repeats * total[s]
                target[s] = Fraction(mix.repeats * total[s])
                open_.discard(s)
        left = excess
    out = []
    for s in order:
        mine = [
            (int(hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest()[:15], 16), n, r[0])
            for r, n in zip(rows, size)
            if r[3] == s
        ]
        passes, rest = divmod(int(target[s]), total[s]) if total[s] else (0, 0)
        for h, n, doc in mine:
            before = sum(x for g, x, _ in mine if g < h)
            same = sum(x for g, x, _ in mine if g == h)
            more = n if before + same <= rest else (n * (rest - before) // same if before <= rest and same else 0)
            out.append((doc, n, total[s], float(target[s]), n * passes + more))
    return out


def mixed(df, mix=M.Mix()):
    got = M.mix_sources(df, mix).select("doc_id", "size", "source_size", "target", "taken").collect()
    return Counter((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got)


def rounded(rows):
    return Counter((a, b, c, round(d, 6), e) for a, b, c, d, e in rows)


def many_sources(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(240):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "", None, "é", "Z", "tiny"])
        n = 1 if source == "tiny" else int(rng.paretovariate(0.8)) + 1
        rows.append((i, " ".join(["w"] * min(n, 4000)), "en", source, 1))
    return rows


@pytest.mark.parametrize("mix", [M.Mix(), M.Mix((1, 5), (19, 10), 2), M.Mix((2, 7, 1), (1, 3), 1)])
def test_mix_matches_brute_force(spark, mix):
    rows = many_sources(3)
    assert mixed(frame(spark, rows), mix) == rounded(mix_brute(rows, mix))


def test_mix_reaches_targets_and_reruns_agree(spark):
    rows = many_sources(4)
    got = M.mix_sources(frame(spark, rows)).collect()
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(0 <= target[s] - taken[s] < 1 for s in target)
    again = M.mix_sources(frame(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_smaller_budgets_take_a_subset(spark):
    rows = [(i, "w " * (i % 9 + 1), "en", "s", 1) for i in range(300)]
    df = frame(spark, rows)
    small, large = (
        {r.doc_id: r.taken for r in M.mix_sources(df, M.Mix((1,), share, 1)).collect()} for share in ((1, 5), (2, 5))
    )
    assert all(small[k] <= large[k] for k in small) and sum(small.values()) < sum(large.values())


def test_mix_hostile_rows(spark):
    rows = hostile() + [(50, "same words here", "en", "dup", 1)] * 7 + [(51, "x", "en", "dup", 1)]
    got = mixed(frame(spark, rows))
    want = mix_brute(rows, M.Mix())
    assert got == rounded(want)
    assert M.mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    blank = mixed(frame(spark, [(1, None, "en", None, 1), (2, "", "en", "a", 1)]))
    assert blank == Counter({(1, 0, 0, 0.0, 0): 1, (2, 0, 0, 0.0, 0): 1})


# ---------------------------------------------------------------- phrases


def phrases_brute(rows, top, at_least):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            n[lang] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    f[lang, ws[i : i + k]] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= at_least}
    inside = set()
    for (lang, p), a in candidates.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and a >= f[lang, p[i:j]]:
                    inside.add((lang, p[i:j]))
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) in inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return {
        (lang, i, p.decode(), -a, l, r, n_, -s)
        for lang, found in out.items()
        for i, (s, a, p, l, r, n_) in enumerate(sorted(found)[:top], 1)
    }


def phrase_rows(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = {x: [f"{x}{i}" for i in range(30)] for x in ("a", "é", "z")}
    fixed = ["New  York\tCity Hall Park", "to be or not to be", "x y z", "la la la la la la"]
    rows = []
    for i in range(docs):
        lang = rng.choice(["a", "é", "z"])
        ws = [rng.choice(vocabulary[lang][: rng.choice([2, 5, 30])]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            ws.insert(rng.randint(0, len(ws)), rng.choice(fixed))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!", "\r"]) for w in ws)
        rows.append((i, text, rng.choice([lang, lang, None, ""]) if i % 7 == 0 else lang, "s", 1))
    return rows


@pytest.mark.parametrize("top, at_least", [(2000, 2), (7, 2)])
def test_phrases_match_brute_force(spark, top, at_least):
    rows = phrase_rows(top)
    got = C.collocations(frame(spark, rows), top, at_least).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == phrases_brute(rows, top, at_least)


def test_phrases_hostile_rows(spark):
    rows = hostile() + [(1, "the one two. the one two", None, None, None)] * 3
    # A filter of 64 bits: nearly every answer is a wrong hit.
    got = set(map(tuple, C.collocations(frame(spark, rows), 50, 3, filter_bits=64).collect()))
    assert got == phrases_brute(rows, 50, 3)
    assert C.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert C.collocations(frame(spark, [(1, None, None, None, 1), (2, " \t", "en", "s", 1)])).count() == 0


def test_settled_languages_stop(spark, monkeypatch):
    """Rare words fill the list; phrases that start with a frequent word are never grown."""
    rows = [(i, f"rare{i % 6} mate{i % 6}. " + "of the " * 20, "en", "s", 1) for i in range(60)]
    grown, extend = [], C._extend
    monkeypatch.setattr(C, "_extend", lambda n, f: grown.append(n) or extend(n, f))
    got = set(map(tuple, C.collocations(frame(spark, rows), 4, 5).collect()))
    assert got == phrases_brute(rows, 4, 5)
    assert len(grown) == C.MAX_WORDS - 1  # one round


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [(1, 2, 0, 0, 0, 900_000_000_000, 0, 1, 0, 1)], ", ".join(f"{c} long" for c in (*C.WORDS, "n", *C.AROUND))
    )
    big = 10**15
    words = spark.createDataFrame([("x", 1, "u", 10**12, big), ("x", 2, "v", 10**12 + 7, big)],
                                  "lang string, id long, word string, n long, total long")
    row = C._scored(counts, words, words, 100).first()
    assert row.score == 1000 * 900_000_000_000 * big // (10**12 * (10**12 + 7))


def test_buffers_keep_every_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "TASK_WORDS", 10)
    rng = random.Random(1)
    rows = [[rng.randint(1, 9)] * rng.randint(1, 25) + [0] for _ in range(50)]
    column = pa.array(rows, pa.list_(pa.int64()))
    batches = [pa.RecordBatch.from_arrays([column.slice(a, 13)], names=["ids"]) for a in range(0, 50, 13)]
    got = np.concatenate(list(C._buffers(batches))).tolist()
    assert got == [x for r in rows for x in r]


# ---------------------------------------------------------------- trie

TURNS = "conv_id long, turn long, role string, text string"


def rebuild_brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, key, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_brute(rebuilt):
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = sum(not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in members) for q in below)
        saved = sum((len(members[q]) - 1) * words_of(q[-1][1]) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in cs if len(rebuilt[c]) == len(p))))
        out.add((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs),
            sum(len(q) == len(p) + 1 for q in below), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def trie(spark, rows, shard=200_000, clash=True):
    df = spark.createDataFrame(rows, TURNS)
    if clash:
        df = df.selectExpr("*", *(f"'x' AS `{c}`" for c in [*CLASHING, "turns", "kind", "key", "base", "head", "words"]))
    convs = T.digested_turns(df)
    conv = F.col("conv_id")
    rebuilt = T.rebuilt(convs, conv - conv % 20, F.crc32(conv.cast("string")) % 4, 3)
    got = T.prefix_trie(rebuilt, shard).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def conversations(seed, n=90):
    rng = random.Random(seed)
    said = ["hello there", "", None, "ok", "a b c", "Hello there", "hello  there"]
    rows = []
    for c in rng.sample(range(-40, 200), n):
        turns = ["hello there", "ok"] if c % 3 == 0 else [rng.choice(said) for _ in range(rng.choice([1, 2, 3, 3, 4, 5, 11]))]
        rows += [(c, i, rng.choice(["user", "user", "bot", None]) if c % 3 else "user", t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [3, 17, 200_000])
def test_trie_matches_brute_force(spark, shard):
    rows = conversations(shard)
    assert trie(spark, rows, shard) == trie_brute(rebuild_brute(rows))


def test_trie_of_copies_over_many_shards(spark):
    """A third of all conversations are one sequence, and one of them goes on."""
    same = [("u", "a b"), ("v", "c"), ("u", "d e f")]
    rows = [(20 * i, t, r, x) for i in range(60) for t, (r, x) in enumerate(same)]
    rows += [(20 * 70, t, "u", "long " * (t % 5)) for t in range(300)]
    rows += [(20 * 71, t, r, x) for t, (r, x) in enumerate([*same, ("v", "on")])]
    rows += [(20 * (80 + i), 0, "u", f"other {i}") for i in range(60)]
    assert trie(spark, rows, 10) == trie_brute(rebuild_brute(rows))


def test_trie_hostile_rows(spark):
    rows = [
        (None, 1, "u", "lost"), (1, None, "u", "first"), (1, 5, None, None), (1, 5, None, None), (1, 5, "a", "b"),
        (2, None, None, None), (20, 0, "u", "x " * 40_000), (21, 0, "u", "only"), (-3, 0, "u", "below zero"), (5, 2, "12", "3"),
        (6, 2, "1", "23"),
    ]
    assert trie(spark, rows) == trie_brute(rebuild_brute(rows))
    assert trie(spark, [], clash=False) == set()
    assert trie(spark, [(None, 1, "u", "x")], clash=False) == set()


def test_strips_sort_like_python():
    rng = random.Random(2)
    seqs = [[rng.randint(1, 2) for _ in range(rng.randint(0, 40))] for _ in range(200)] + [[1] * 33] * 20
    lens = np.array(list(map(len, seqs)))
    ids = np.array([x for s in seqs for x in s], np.int64)
    conv = np.array(rng.sample(range(1000), len(seqs)))
    order = T._sorted_rows(ids, np.cumsum(lens) - lens, lens, conv)
    assert order.tolist() == sorted(range(len(seqs)), key=lambda i: (seqs[i], conv[i]))


def test_long_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    rows = [(1000 + i, 0, "u", "same") for i in range(120)]
    assert trie(spark, rows, 13) == trie_brute(rebuild_brute(rows))
