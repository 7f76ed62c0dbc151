"""The wide table and its blocks on hand-built native rows, in both modes."""

import math

import pytest
from pyspark.sql import functions as F

from affinity.plans import features as feat
from affinity.plans.scoring import model_input
from affinity.plans.wide import build_wide
from affinity.schemas import WIDE_COLUMNS
from tests.fixtures import native

AS_OF = "2002-01-01"


@pytest.fixture(scope="module")
def data(spark):
    return native(spark)


@pytest.fixture(scope="module")
def wide(spark, data):
    fact, dims = data
    return {(r.user_id, r.event_id): r for r in build_wide(fact, dims, as_of=AS_OF).collect()}


@pytest.fixture(scope="module")
def wide_ref(spark, data):
    fact, dims = data
    return {(r.user_id, r.event_id): r for r in build_wide(fact, dims, as_of=AS_OF, mode="reference").collect()}


def test_grain(wide, wide_ref):
    expected = {("u1", "e1"), ("u1", "e2"), ("u2", "e1"), ("u3", "e2"), ("u4", "e3"), ("u5", "e5")}
    assert set(wide) == expected
    assert set(wide_ref) == expected


def test_columns(spark, data):
    fact, dims = data
    assert tuple(build_wide(fact, dims, as_of=AS_OF).columns) == WIDE_COLUMNS


def test_latest_invitation_and_invite_days(wide):
    r = wide[("u1", "e1")]
    assert r.user_invited == "1"
    assert r.invite_days == 28


def test_null_times_row_kept(wide):
    assert wide[("u5", "e5")].invite_days == 0


def test_no_event_gives_zero_invite_days(spark, data):
    fact, dims = data
    hist = {(r.userid, r.eventid): r for r in feat.user_history_features(feat.dedup_fact(fact), dims).collect()}
    assert hist[("u3", "e9")].invite_days == 0


def test_calendar(wide):
    r = wide[("u1", "e1")]
    assert (r.event_month, r.event_dayofweek, r.event_hour) == (10, "3", "23:30:00")
    assert wide[("u1", "e2")].event_hour == ""


def test_history_and_friends(wide):
    r = wide[("u1", "e1")]
    assert (r.attended_count, r.not_attended_count, r.maybe_attended_count, r.invited_event_count) == (2, 0, 0, 0)
    assert r.friend_count == 2
    none = wide[("u5", "e5")]
    assert none.friend_count == 0
    assert (none.uf_invited_prec, none.uf_attended_prec, none.uf_not_attended_prec, none.uf_maybe_prec) == (0.0,) * 4


def test_friend_ratio_divisor(wide, wide_ref):
    # u1 has 2 friends and 2 fact rows; on e1 one friend said yes, one said no.
    r = wide[("u1", "e1")]
    assert (r.uf_attended_count, r.uf_not_attended_count) == (1, 1)
    assert r.uf_attended_prec == 0.5
    assert wide_ref[("u1", "e1")].uf_attended_prec == 0.25


def test_event_without_attendees(spark, data, wide):
    r = wide[("u5", "e5")]
    assert (r.event_invited_count, r.event_attended_count, r.event_not_att_count, r.event_maybe_count) == (None,) * 4
    fact, dims = data
    mi = {(x.user_id, x.event_id): x for x in model_input(build_wide(fact, dims, as_of=AS_OF)).collect()}
    assert mi[("u5", "e5")].event_attended_count == 0.0


def test_event_counts(wide):
    r = wide[("u2", "e1")]
    assert (r.event_attended_count, r.event_not_att_count, r.event_maybe_count, r.event_invited_count) == (2, 1, 0, 0)


def test_gender_age_member_days(wide):
    assert [wide[k].gender for k in [("u1", "e1"), ("u2", "e1"), ("u3", "e2"), ("u4", "e3")]] == [0, 1, 2, 2]
    assert wide[("u1", "e1")].age == 22
    assert wide[("u1", "e1")].member_days == 0.0
    assert wide[("u2", "e1")].member_days == 1.0
    assert wide[("u3", "e2")].member_days == 0.5
    assert wide[("u4", "e3")].member_days is None


def test_host_is_friend(wide, wide_ref):
    assert wide[("u1", "e1")].creator_is_friend == 1   # edge h1 -> u1
    assert wide[("u3", "e2")].creator_is_friend == 1   # edge u1 -> u3, u1 hosts e2
    assert wide[("u2", "e1")].creator_is_friend == 0   # no edge h1 -> u2
    assert wide[("u4", "e3")].creator_is_friend == 0   # only u4 -> h2 (reversed)
    assert {r.creator_is_friend for r in wide_ref.values()} == {1}


def test_location_similar(wide, wide_ref):
    assert wide[("u1", "e1")].location_similar == 1   # city Paris
    assert wide[("u1", "e2")].location_similar == 0   # city '' never matches
    assert wide[("u2", "e1")].location_similar == 0   # NULL location
    assert wide[("u3", "e2")].location_similar == 1   # state Texas
    assert wide[("u4", "e3")].location_similar == 1   # city Lyon
    assert wide[("u5", "e5")].location_similar == 0   # NULL state and country, no error
    assert {r.location_similar for r in wide_ref.values()} == {0}


def test_popularity_levels(wide, wide_ref):
    # Nice has 2 events; '' , Lyon, Paris 1 each -> by name: '' 2, Lyon 3, Paris 4
    assert wide[("u5", "e5")].city_level == 1
    assert wide[("u1", "e2")].city_level == 2
    assert wide[("u4", "e3")].city_level == 3
    assert wide[("u1", "e1")].city_level == 4
    assert {r.city_level for r in wide_ref.values()} == {1}
    assert wide[("u5", "e5")].country_level is None


def test_geo_scale(wide):
    assert wide[("u1", "e1")].lat_prec == 0.0
    assert wide[("u4", "e3")].lat_prec == 1.0
    assert wide[("u1", "e2")].lat_prec is None
    assert wide[("u1", "e2")].lng_prec == 0.5


def test_model_input_modes(spark, data):
    fact, dims = data
    w = build_wide(fact, dims, as_of=AS_OF)
    intended = {(r.user_id, r.event_id): r for r in model_input(w, "intended").collect()}
    reference = model_input(w, "reference").collect()
    assert intended[("u1", "e1")].event_hour == 23.0
    assert intended[("u1", "e2")].event_hour == 0.0
    assert intended[("u4", "e3")].member_days == 0.0          # NULL -> 0
    # reference mode casts the text ids to double (NULL -> 0) and the clock text too
    assert {(r.user_id, r.event_id) for r in reference} == {(0.0, 0.0)}
    assert {r.event_hour for r in reference} == {0.0}
    for r in intended.values():
        assert all(not (isinstance(v, float) and math.isnan(v)) for v in r)


def test_duplicate_dimension_key_reported(spark, data):
    from affinity.plans.batch import validate_dims

    _, dims = data
    validate_dims(dims)
    from dataclasses import replace

    doubled = replace(dims, customers=dims.customers.unionByName(dims.customers.limit(1)))
    with pytest.raises(ValueError):
        validate_dims(doubled)


def test_creator_flags_leave_out_pairs_without_the_edge(spark):
    """An event with several hosts keeps a row for each of them, as the join with them gives."""
    from types import SimpleNamespace

    from affinity.operators import edge_multiplicity
    from affinity.plans.wide import creator_flags

    pairs = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)], "userid long, eventid long")
    hosts = spark.createDataFrame([(1, 9), (2, 8), (2, 7), (None, 9)], "eventid long, host long")
    edges = edge_multiplicity(spark.createDataFrame([(9, 1), (9, 1), (7, 3), (3, 7)], "userid long, friendid long"))
    flags = creator_flags(pairs, SimpleNamespace(hosts=hosts, edges=edges, host_edges=None))
    assert sorted(map(tuple, flags.collect())) == [(1, 1, 1), (3, 2, 0), (3, 2, 1), (4, 2, 0), (4, 2, 0)]


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = (f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()))
    return {n for n in names if n.startswith("shuffle_")}


def test_written_steps_keep_no_shuffle_files(spark):
    import time

    from affinity.session import SHUFFLE_CLEANUP, write_scratch

    before, conf = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    made = write_scratch(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "dropped")
    for _ in range(50):  # the files go in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == conf
    assert sorted(r["count"] for r in made.collect()) == [142] + [143] * 6


@pytest.mark.parametrize("mode", ["intended", "reference"])
def test_staged_wide_reads_written_blocks(spark, data, mode):
    """The plan left over joins the blocks: neither lists of friends nor the fact's duplicates are in it."""
    fact, dims = data
    staged = build_wide(fact, dims, as_of=AS_OF, mode=mode, staged=True)
    whole = build_wide(fact, dims, as_of=AS_OF, mode=mode)
    plan, lazy = (df._jdf.queryExecution().optimizedPlan().toString() for df in (staged, whole))
    assert "collect_list" in lazy and "collect_list" not in plan
    assert "max(struct" in lazy and "max(struct" not in plan
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(staged) == rows(whole) != []


def test_compressed_csv_is_read_back(spark, data, tmp_path):
    from affinity.sinks import write_table
    from affinity.sources.fact import read_wide_csv

    fact, dims = data
    wide = build_wide(fact, dims, as_of=AS_OF)
    for name, compression in (("packed", "gzip"), ("plain", None)):
        write_table(wide, str(tmp_path / name), fmt="csv", compression=compression)
    assert list((tmp_path / "packed").glob("*.csv.gz")) and not list((tmp_path / "packed").glob("*.csv"))
    packed, plain = (
        sorted(map(repr, read_wide_csv(spark, str(tmp_path / name), wide.schema).collect())) for name in ("packed", "plain")
    )
    assert packed == plain != []
