"""Every contract query against its DuckDB oracle on the smallest test tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

# The optional training-data queries have their own tests.
OPTIONAL = re.compile(r"op[0-9]+_|pipeline$")
ORACLE_KEYS = sorted(k for k in entry.oracle_sql() if not OPTIONAL.match(k))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {k for k in entry.queries() if not OPTIONAL.match(k)} == set(ORACLE_KEYS)


@pytest.mark.parametrize("name", ORACLE_KEYS)
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == list(entry.WIDE_COLUMNS)
    assert df.count() > 0


def test_score_rows(spark):
    df = entry.queries()["score"](spark, SF_SMALL)
    assert df.columns == ["user_id", "event_id", "prediction"]
    assert df.count() == entry.queries()["wide"](spark, SF_SMALL).count()
