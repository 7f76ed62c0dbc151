"""The pipeline against a brute-force version, and the registered queries' oracles."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from affinity.llm import contract
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, frame, hostile, sentence
from tests.llm.test_dedup import near_brute
from tests.oracle_compare import compare


def corpus():
    rng = random.Random(11)
    rows = [(i, sentence(rng, "en", 150), "en", f"s{i}", 1) for i in range(30)]
    items = [(0, sentence(rng, "en", 25)), (1, None)]
    rows.append((40, sentence(rng, "en", 60) + " " + items[0][1], "en", "s", 1))  # a leak
    rows += [(41, rows[5][1], "en", "s", 1), (42, rows[5][1], "fr", None, 1)]  # exact copies
    near = rows[9][1].split()
    near[70] = "swapped"
    rows += [(43, " ".join(near), "en", "s", 1), (44, None, "en", "s", 1), (45, "123 456", "en", "s", 1)]
    return rows, items


def test_stage_names_and_order():
    assert [n for n, _ in P.STAGES] == [
        "language_id", "exact_dedup", "minhash_near_dedup", "benchmark_decontamination", "packing",
    ]


def test_run_matches_brute_force(spark, tmp_path):
    rows, items = corpus()
    sf = f"file://{tmp_path}"
    frame(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    kept = list({r[1]: r for r in sorted(kept)}.values())  # the largest doc_id of equal texts
    stays = {i for i, _, _, k in near_brute(kept, 5, 80) if k}
    kept = [r for r in kept if r[0] in stays and items[0][1] not in r[1]]
    got = P.run(spark, sf).collect()
    assert {r.doc_id for r in got} == {r[0] for r in kept}
    assert {40, 5, 41, 43, 44, 45}.isdisjoint({r.doc_id for r in got})


def test_filter_stages_keep_columns_on_hostile_rows(spark, tmp_path):
    sf = f"file://{tmp_path}"
    spark.createDataFrame([(1, "x y z")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = frame(spark, hostile())
    empty = spark.createDataFrame([], DOCS)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns, name
        assert stage(spark, empty, sf).count() == 0, name
    assert P.STAGES[-1][1](spark, empty, sf).count() == 0


def test_filters_judge_repeated_ids_by_text(spark, tmp_path):
    rows, items = corpus()
    sf = f"file://{tmp_path}"
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    twice = frame(spark, [*rows, (0, None, None, None, None), (1, items[0][1], "en", "s", 1)])
    stages = dict(P.STAGES)
    known = stages["language_id"](spark, twice, sf).collect()
    assert sorted(r.doc_id for r in known).count(0) == 1 and len(known) == len(rows) - 1
    clean = stages["benchmark_decontamination"](spark, twice, sf).collect()
    assert [r.text for r in clean if r.doc_id == 1] == [rows[1][1]] and len(clean) == len(rows)


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in entry.queries()) == 1 for n in names)
    assert entry.queries()["pipeline"] is P.run
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_oracle(spark, name):
    r = compare(spark, name, SF_SMALL)
    assert r["columns_match"] and r["values_match"], r
