"""Exact and near de-duplication, components, repeated passages."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import kernels as K
from affinity.llm.components import components
from affinity.llm.exact_dedup import exact_dedup, exact_groups
from affinity.llm.near_dedup import near_dedup, near_groups, prune_below, rows_per_band
from affinity.llm.substring import REACH, cuts, gear, repeated_passages
from tests.llm.cases import DOCS, frame, hostile, sentence


def exact_brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = [i for i in groups[r[1] or ""] if i is not None]
        keep = max(ids) if ids else None
        out.append((r[0], keep, len(groups[r[1] or ""]), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_match_brute_force(spark, weak):
    rows = hostile()
    digest = (lambda t: F.encode((F.length(t) % 3).cast("string"), "utf-8")) if weak else None
    got = exact_groups(frame(spark, rows), salts=3, digest=digest).collect()
    want = exact_brute(rows)
    if weak:  # texts with equal digests are still told apart
        assert Counter(r[:4] for r in got) == Counter(r[:4] for r in want.elements())
    else:
        assert Counter((*r[:4], r["digest"].hex()) for r in got) == want


def test_exact_dedup_keeps_columns_and_empty(spark):
    df = frame(spark, hostile())
    kept = exact_dedup(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {2, 3, 6, 5, 7, 8, 9, 10, 11, 12, None}
    empty = spark.createDataFrame([], DOCS)
    assert exact_groups(empty).count() == 0 and exact_dedup(empty).count() == 0


def near_brute(rows, words, percent):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        k = min(words, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {(i, len(sets[i]), root(i), root(i) == i) for i in ids}


def near_cases(seed, n=260):
    """Families of copies with a few words changed each, so links, chains and near misses mix."""
    rng = random.Random(seed)
    rows, base = [], [sentence(rng, "en", rng.choice([1, 2, 3, 40, 120, 300])) for _ in range(12)]
    for i in range(n):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 8])):
            w[rng.randrange(len(w))] = rng.choice(["x", "y", f"z{rng.randint(0, 5)}"])
        rows.append((i * 3 + 1, " ".join(w), "en", "s", 1))
    return rows


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_groups_match_brute_force(spark, words, percent):
    rows = near_cases(words)
    got = near_groups(spark.createDataFrame(rows, DOCS), words, percent).collect()
    assert {tuple(r) for r in got} == near_brute(rows, words, percent)


def test_namesakes_are_judged_by_their_own_text(spark):
    """A doc_id with a near copy, an unrelated text, a null, and a copy under a null id."""
    rng = random.Random(8)
    base, other = sentence(rng, "en", 120), sentence(rng, "fr", 120)
    near = base.split()
    near[60] = "changed"
    near = " ".join(near)
    rows = [(1, base), (2, near), (2, other), (2, None), (2, ""), (3, other), (3, None), (4, None), (None, base), (9, near), (9, near)]
    for third in (None, sentence(rng, "de", 60)):
        docs = frame(spark, [(i, t, "en", "s", 1) for i, t in [*rows, (5, third), (5, base)]])
        got = near_groups(docs, 5, 80).collect()
        assert len(got) == len(rows) + 2
        by = {(r.doc_id, r.n_shingles > 0): set() for r in got}
        for r in got:
            by[r.doc_id, r.n_shingles > 0].add((r.component_id, r.kept))
        assert by[1, True] == {(1, True)} and by[9, True] == {(1, False)}
        assert by[2, True] == {(1, False), (2, True)} and by[2, False] == {(2, True)}
        assert by[3, True] == {(2, False)} and by[3, False] == {(3, True)} and by[4, False] == {(4, True)}
        assert by[None, True] == {(None, True)}
        assert by[5, True] == ({(1, False)} if third is None else {(1, False), (5, True)})
        left = Counter((r.doc_id, r.text) for r in near_dedup(docs, 5, 80).collect())
        want = [(1, base), (2, other), (2, None), (2, ""), (3, None), (4, None), (None, base), (5, third)]
        assert left == Counter(want)


def test_near_groups_hostile_rows(spark):
    got = near_groups(frame(spark, hostile()), 3, 85).collect()
    assert len(got) == len(hostile())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 1, 1, 4, 5, 6, 7, 7]
    assert [by_id[i].n_shingles for i in (4, 5, 6, 7)] == [0, 0, 0, 1]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert near_groups(spark.createDataFrame([], DOCS), 3, 85).count() == 0
    kept = near_dedup(frame(spark, hostile()), 3, 85)
    assert kept.columns == frame(spark, hostile()).columns
    assert {2, 3, 8}.isdisjoint({r.doc_id for r in kept.collect()})


def test_banding_misses_rarely():
    for t in (0.8, 0.85):
        r = rows_per_band(t)
        assert (1 - t**r) ** (252 // r) <= 1e-5 and prune_below(t) < t


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {x: x for e in edges for x in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for a, b in edges if a != b for i in (a, b)}


def test_words_match_plain_python():
    texts = [b"a b  c", b"", b"one", b"\tx\x0by\n", b"a b c d a b c d"]
    words = K.Words(texts, K.SPACES)
    assert list(words.bounds) == [0, 3, 3, 4, 6, 14]
    assert [len(s) for s in words.shingles(3)] == [1, 0, 1, 1, 4]
    assert words.hashes[0] == words.hashes[6] and words.hashes[0] != words.hashes[1]


def test_repeated_passages(spark):
    rng = random.Random(1)
    passage = sentence(rng, "fr", 60)
    rows = [(i, sentence(rng, "en", 150), "en", "s", 1) for i in range(20)]
    for i in (3, 7, 11):  # the same passage at different shifts
        rows[i] = (i, sentence(rng, "de", 30 + i) + " " + passage + " " + sentence(rng, "de", 40), "en", "s", 1)
    rows += [(50, None, None, None, None), (51, "", None, None, None), (None, passage, None, None, None)]
    rows.append(rows[3])  # a repeated row is one document
    got = repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == {3, 7, 11}
    text = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        assert text[r.doc_id][r.start : r.end].decode() in passage
        assert r.first_doc_id == 3 and r.kept == (r.doc_id == 3)
    assert repeated_passages(spark.createDataFrame([], DOCS)).count() == 0


def test_repeated_passages_keep_one_copy_of_neighbours(spark):
    rng = random.Random(6)
    a, b = sentence(rng, "fr", 60), sentence(rng, "en", 60)
    own = [sentence(rng, "de", 40) for _ in range(6)]
    rows = [
        (1, f"{own[0]} {a} {own[1]}", "en", "s", 1),
        (5, f"{own[2]} {a} {b} {own[3]}", "en", "s", 1),  # b is first here, a is not
        (7, f"{own[4]} {a} {b} {own[5]}", "en", "s", 1),
    ]
    got = repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    left = {r[0]: r[1].encode() for r in rows}
    for r in sorted(got, key=lambda r: -r.start):
        for start, end in reversed(r.copies):
            left[r.doc_id] = left[r.doc_id][:start] + left[r.doc_id][end:]
    for passage in (a, b):
        core = passage.encode()[100:-100]
        assert sum(core in t for t in left.values()) == 1
    assert {(r.doc_id, r.kept) for r in got} == {(1, True), (5, False), (7, False)}


def test_exact_dedup_judges_repeated_ids_by_text(spark):
    rows = [(20, "only here", None, "s", 1), (20, "copy", "en", "s", 1), (21, "copy", "en", "s", 1)]
    kept = exact_dedup(frame(spark, rows))
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(20, "only here"), (21, "copy")}


def passages(spark, texts):
    rows = [(i, t, "en", "s", 1) for i, t in texts.items()]
    return {(r.doc_id, r.start, r.end): r for r in repeated_passages(spark.createDataFrame(rows, DOCS)).collect()}


def test_repeated_passages_of_short_words_reach_their_ends(spark):
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    texts, want = {}, set()
    for k in range(150):  # 51 words of 1 to 3 letters, in two unrelated texts each
        passage = " ".join(noise(3).replace(" ", "e")[: rng.randint(1, 1 + k % 3)] for _ in range(51))
        for i in (2 * k, 2 * k + 1):
            before = noise(rng.randint(0, 90)) + str(i % 2)
            texts[i] = f"{before}{passage}{'XY'[i % 2]}{noise(rng.randint(0, 90))}"
            want.add((i, len(before), len(before) + len(passage)))
    assert set(passages(spark, texts)) == want


def test_repeated_passages_of_periodic_text(spark):
    rng = random.Random(13)
    texts = {i: f"{sentence(rng, 'de', 30 + i)} {i}{unit * (720 // len(unit))}{i} {sentence(rng, 'fr', 40)}"
             for i, unit in enumerate(["lorem ipsum ", "lorem ipsum ", "a", "a"])}
    got = passages(spark, texts)
    for i, t in texts.items():
        at = t.index("lorem" if i < 2 else "a" * 300)
        at = len(t[:at].encode())
        assert any(d == i and start <= at and end >= at + 719 for d, start, end in got), i


def test_repeated_passages_between_copies_of_earlier_pieces(spark):
    rng = random.Random(14)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    whole = "q" + noise(398) + "q"
    texts = {i: noise(80) + whole[40 * i : 40 * i + 40] + noise(80) for i in range(10)}  # earlier, too short
    texts |= {20: noise(50) + "1" + whole + "2" + noise(50), 21: noise(70) + "3" + whole + "4" + noise(50)}
    assert set(passages(spark, texts)) == {(20, 51, 451), (21, 71, 471)}


def test_repeated_passages_inside_one_document(spark):
    rng = random.Random(15)
    block = sentence(rng, "fr", 60)
    texts = {4: " | ".join(x for i in range(30) for x in (sentence(rng, "en", 9), f"{i} {block}"))}
    texts[9] = f"{sentence(rng, 'de', 20)} {block} {sentence(rng, 'de', 20)}"
    got = passages(spark, texts)
    assert {d for d, _, _ in got} == {4, 9} and len(got) == 31
    left = {i: t.encode() for i, t in texts.items()}
    for (doc, _, _), r in sorted(got.items(), reverse=True):
        for start, end in reversed(r.copies):
            left[doc] = left[doc][:start] + left[doc][end:]
    assert [left[i].count(block.encode()) for i in (4, 9)] == [1, 0]
    assert not any(w in left[9].decode() for w in block.split() if w[-1].isdigit() and len(w) > 4)
    alone = passages(spark, {5: f"{block}. {sentence(rng, 'en', 30)}. {block}"})
    assert [(start, len(r.copies)) for (_, start, _), r in sorted(alone.items())] == [(0, 0), (min(s for _, s, _ in alone if s), 1)]


def test_repeated_passages_of_namesakes_stay_in_their_text(spark):
    rng = random.Random(16)
    texts = [sentence(rng, "fr", 60), sentence(rng, "de", 60)]
    rows = [
        (1, f"1 {texts[0]} A {sentence(rng, 'en', 40)}", "en", "s", 1),
        (1, f"{sentence(rng, 'en', 40)} 2 {texts[1]} B", "en", "s", 1),
        (2, f"3 {texts[0]} C", "en", "s", 1),
        (3, f"4 {texts[1]} D", "en", "s", 1),
    ]
    got = repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    spans = [(i, t.encode().index(x.encode()), t.encode().index(x.encode()) + len(x.encode()))
             for (i, t, *_), x in zip(rows, [texts[0], texts[1], *texts])]
    assert sorted((r.doc_id, r.start, r.end) for r in got) == sorted(spans)


def _covered(texts: dict, n: int) -> dict:
    """Per text the places inside some n bytes that stand at another place, in any text, too."""
    seen = {}
    for i, t in texts.items():
        for at in range(len(t) - n + 1):
            seen.setdefault(t[at : at + n], []).append((i, at))
    out = {i: set() for i in texts}
    for places in seen.values():
        for i, at in places if len(places) > 1 else ():
            out[i].update(range(at, at + n))
    return out


def test_repeated_passages_match_all_shared_substrings(spark):
    rng = random.Random(17)
    texts = {}
    for i in range(60):  # pieces of earlier texts between own words, over few and many letters
        letters = "ab é" if i % 3 == 0 else "abcdefghijklmnopqrstuvwxyzäß "
        own = lambda n: "".join(rng.choice(letters) for _ in range(n))
        parts = [own(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 4)):
            if texts:
                source = texts[rng.choice(list(texts))]
                at = rng.randint(0, len(source))
                parts += [source[at : at + rng.randint(20, 300)], own(rng.choice([0, 1, 30]))]
        texts[i] = "".join(parts) + own(40)
    raw = {i: t.encode() for i, t in texts.items()}
    must, may = _covered(raw, 101 + 8), _covered(raw, 28)  # ends give up blanks and parts of characters
    got = {i: set() for i in raw}
    for i, start, end in passages(spark, texts):
        got[i].update(range(start, end))
    assert sum(map(len, must.values())) > 5000
    for i, t in raw.items():
        assert got[i] <= may[i], i
        lost = must[i] - got[i]
        assert all(t[x] in b" " or t[x] >= 0x80 for x in lost), (i, len(lost))


def test_gear_cuts_are_content_defined():
    rng = np.random.default_rng(3)
    shared = rng.integers(97, 123, 4000, dtype=np.uint8)
    for lead in (0, 1, 777):
        data = np.concatenate([rng.integers(97, 123, lead, dtype=np.uint8), shared])
        at = cuts(gear(data)) - lead
        assert np.diff(at).max() <= REACH
        if lead:
            assert set(at[(at > 2 * REACH) & (at < 3900)]) == set(own[(own > 2 * REACH) & (own < 3900)])
        own = at
