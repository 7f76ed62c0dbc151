"""Language mixtures, packing, sharding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import language, packing, sharding
from affinity.llm.common import table
from affinity.llm.contract import default_tokenizer, op2_language_mixture, op9_bin_slack_packing
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, WORDS, frame, hostile, sentence


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, lang, 80), lang, "s", 1) for i in range(40) for lang in WORDS]
    return language.fit(spark.createDataFrame(rows, DOCS))


def test_language_held_out_accuracy(spark):
    truth = table(spark, SF_SMALL, "documents").select("doc_id", "lang")
    got = op2_language_mixture(spark, SF_SMALL).join(truth, "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 20 and right / n >= 0.97


def test_held_out_is_the_crc_rule(spark):
    got = spark.range(200).select("id", language.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_language_mixture_and_hostile_rows(spark, model):
    rng = random.Random(3)
    mixed = sentence(rng, "en", 200) + " " + sentence(rng, "fr", 100)
    rows = [*hostile(), (99, mixed, None, None, None)]
    got = language.predict(frame(spark, rows), model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].lang_pred for i in (4, 5, 6, 10)] == ["und"] * 4
    assert by_id[9].lang_pred == "de" and by_id[12].lang_pred == "fr"
    assert by_id[99].languages == ["en", "fr"] and 0.5 < by_id[99].score < 0.85
    assert all(0 <= r.score <= 1 for r in got)
    assert language.predict(spark.createDataFrame([], DOCS), model).count() == 0


def test_language_without_training_rows(spark):
    none = language.fit(spark.createDataFrame([(1, None, "en", "s", 1), (2, "a b", None, "s", 1)], DOCS))
    assert {r.lang_pred for r in language.predict(frame(spark, hostile()), none).collect()} == {"und"}


def test_fill_is_the_best_subset_sum():
    rng = random.Random(5)
    for _ in range(60):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        cap = rng.randint(0, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        used = packing.fill(counts, cap)
        assert all(used[k] <= counts[k] for k in used)
        assert sum(k * v for k, v in used.items()) == max(s for s in sums if s <= cap)


@pytest.mark.parametrize("group_pieces", [packing.GROUP_PIECES, 3])
def test_packing_round_trip(spark, monkeypatch, group_pieces):
    monkeypatch.setattr(packing, "GROUP_PIECES", group_pieces)
    rows = hostile()
    got = packing.pack_documents(frame(spark, rows), default_tokenizer(), 256).collect()
    tok = packing.Tokenizer(default_tokenizer()[0])
    want = sorted(tuple(tok.ids(r[1] or "") + [1]) for r in rows)
    by_place, docs = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_place[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, tuple(ids), r.doc_tokens))
    for places in by_place.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    once = {r[0]: tuple(tok.ids(r[1] or "") + [1]) for r in rows if r[0] not in (None, 2)}
    for i, ids in once.items():
        assert tuple(x for _, part, _ in sorted(docs[i]) for x in part) == ids
        assert {t for *_, t in docs[i]} == {len(ids)}
    assert sum(r.length for r in got) == sum(map(len, want))
    assert packing.pack_documents(spark.createDataFrame([], DOCS), default_tokenizer()).count() == 0


def test_packing_has_little_padding(spark):
    got = op9_bin_slack_packing(spark, SF_SMALL).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert 1 - sum(r.n for r in got) / (2048 * len(got)) < 0.02


def test_both_tokenizers_agree():
    fast = packing.Tokenizer(*default_tokenizer())
    slow = packing.Tokenizer(default_tokenizer()[0])
    rng = random.Random(6)
    pool = [chr(c) for c in range(0x250)] + list("  \n\t's're 12") * 40
    for _ in range(400):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 120)))
        assert fast.ids(text) == slow.ids(text)
    assert fast.ids("a <|endoftext|> \U0001f600") == slow.ids("a <|endoftext|> \U0001f600")


def test_sharding_by_bytes(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    docs = table(spark, SF_SMALL, "documents")
    got = sharding.shard_documents(docs, 8, map_path=path).collect()
    text = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    load, places = defaultdict(int), defaultdict(list)
    for r in got:
        assert r.size == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id])
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= max(len(t) for t in text.values())
    first, now = sharding.load_map(spark, path, 1), sharding.load_map(spark, path, 2)
    assert first == sharding.first_map(8) and now.shards == 8
    assert {(r.virtual_slot, r.shard) for r in got} <= set(enumerate(now.shard_of))


def test_rebalance_edits_few_slots():
    rng = random.Random(7)
    load = {s: rng.randint(500, 1500) for s in range(2000)}
    first = sharding.rebalance(sharding.first_map(10, 2000), load)
    more = sharding.rebalance(first, load, shards=11)
    moved = sum(a != b for a, b in zip(first.shard_of, more.shard_of))
    assert more.version == first.version + 1 and moved < 0.25 * 2000
    sums = [sum(load[s] for s in load if more.shard_of[s] == k) for k in range(11)]
    assert max(sums) - min(sums) <= 1500


def test_sharding_hostile_rows(spark):
    got = sharding.shard_documents(frame(spark, hostile()), 4).collect()
    assert len(got) == len(hostile())
    assert {r.size for r in got if r.doc_id in (4, 5)} == {16}
    assert sharding.shard_documents(spark.createDataFrame([], DOCS), 4).count() == 0


def test_shares_stand_still_and_the_set_is_the_best_of_all():
    """Small models of overlapping languages: the shares are those of a very long EM, and the
    chosen set has the best penalised likelihood of all sets."""
    from itertools import combinations

    from affinity.llm import language as L

    rng = np.random.default_rng(5)
    best = 0
    for case in range(40):
        prob = rng.dirichlet(np.full(40, 0.3), 4) * 0.5 + rng.dirichlet(np.full(40, 0.3)) * 0.5
        truth = rng.dirichlet([0.4] * 4)
        grams = rng.choice(40, 400, p=truth @ prob)
        ids, n = np.unique(grams, return_counts=True)
        local = prob[:, ids]

        def long_run(rows):
            w = np.full(len(rows), 1 / len(rows))
            for _ in range(4000):
                w = w * (local[rows] @ (n / (w @ local[rows]))) / n.sum()
            return w, float(n @ np.log(w @ local[rows]))

        chosen, w = L.mixture(prob, grams)
        exact, ll = long_run(chosen)
        assert np.abs(w - exact).max() < 0.12
        penalty = L.PENALTY * np.log(n.sum())
        score = {s: long_run(list(s))[1] - penalty * len(s) for k in range(1, 5) for s in combinations(range(4), k)}
        best += ll - penalty * len(chosen) >= max(score.values()) - 0.5
    assert best >= 38
