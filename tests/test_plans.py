"""Physical-plan properties the scale design depends on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from affinity.plans import features
from affinity.sources import analog
from tests.conftest import SF_SMALL


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def wide(spark):
    return entry.queries()["wide"](spark, SF_SMALL)


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    df = entry.queries()["latest_per_key"](spark, SF_SMALL)
    p = plan_text(df)
    assert "partial_max" in p
    assert "Window" not in p


@pytest.mark.parametrize("name", ["wide", "wide_reference", "friend_status_pivot", "host_affinity"])
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_only_windows_are_partition_offsets(spark, wide):
    # No window runs over data rows: the only windows are order_index's running offsets
    # over its one-row-per-partition table.
    windows = [l for l in plan_text(wide).splitlines() if "Window [" in l]
    assert windows
    for line in windows:
        assert "windowspecdefinition(_part" in line


def test_scans_read_only_needed_columns(spark):
    df = entry.queries()["friend_count"](spark, SF_SMALL)
    p = plan_text(df)
    scans = [l for l in p.splitlines() if "FileScan parquet" in l]
    assert scans
    for s in scans:
        schema = s.split("ReadSchema: ", 1)[1]
        assert "userid" in schema and "friendid" in schema


def test_bounds_are_scalar_subqueries(spark):
    df = entry.queries()["customer_features"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in p or "subquery" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_friend_match_expands_the_pairs_once(spark):
    p = plan_text(entry.queries()["friend_status_pivot"](spark, SF_SMALL))
    scans = [l for l in p.splitlines() if "FileScan parquet" in l]
    assert "REPARTITION_BY_NUM" not in p
    assert sum("struct<userid:bigint,eventid:bigint" in l for l in scans) == 1


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["userid", "eventid"])
def test_a_hot_key_is_split_in_the_fact_join(spark, small_skew_limits, hot):
    cold = {"userid": "eventid", "eventid": "userid"}[hot]
    i = F.col("id")
    fact = spark.range(0, 200_000, 1, 8).select(
        F.when(i % 5 == 0, i % 997).otherwise(F.lit(7)).alias(hot),
        i.alias(cold),
        F.lit("1").alias("invited"),
        F.lit("2012-10-02T10:00:00Z").alias("times"),
    )
    dims = analog.load(spark, SF_SMALL).dims
    block = features.user_history_features if hot == "userid" else features.event_stat_features
    out = block(fact, dims)
    assert len(out.toPandas()) == 200_000
    assert "skew=true" in plan_text(out)


def test_event_stats_restrict_events_before_the_blocks_meet(spark):
    """The events table is cut to the fact's events below its joins; bounds stay global."""
    d = analog.load(spark, SF_SMALL)
    some = d.fact.where("eventid % 10 = 0")
    out = features.event_stat_features(some, d.dims)
    whole = features.event_stat_features(d.fact, d.dims).where("eventid % 10 = 0")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert "FullOuter" in plan_text(out) and "LeftSemi" in optimized_text(features.event_profile(d.dims.events, "reference", some.select("eventid")))


def test_degrees_come_from_the_blocks_aggregates(spark):
    """The friend and attendance tables are grouped by one key once each."""
    d = analog.load(spark, SF_SMALL)
    feats = features.dim_features(d.dims, as_of="2002-01-01")
    got = {r.userid: r.user_deg for r in feats.user_degree.collect()}
    want = {r.userid: r["count"] for r in d.dims.user_friends.groupBy("userid").count().collect()}
    assert got == want
    assert feats.event_degree.agg(F.sum("event_deg")).first()[0] == d.dims.event_attendees.count()


@pytest.mark.parametrize("buckets", [1, 8])
def test_a_small_batch_reads_its_buckets_only(spark, tmp_path, buckets):
    from affinity.plans.wide import assemble_wide

    d = analog.load(spark, SF_SMALL)
    fact = features.dedup_fact(d.fact)
    written = features.dim_features(d.dims, as_of="2002-01-01").write(str(tmp_path), buckets)
    one = fact.where("userid = 7").limit(1)
    pairs = spark.createDataFrame(one.collect(), fact.schema)
    small = written.restricted(pairs)
    for name, key in features.BLOCK_KEYS.items():
        files = {r.f for r in getattr(small, name).select(F.input_file_name().alias("f")).distinct().collect()}
        folders = {f.split(features.BUCKET + "=")[1].split("/")[0] for f in files if features.BUCKET in f}
        assert len(folders) <= 1 and bool(folders) == (buckets > 1 and bool(files)), name
        if buckets > 1:
            assert f"{features.BUCKET}#" in plan_text(getattr(small, name)).split("PartitionFilters: ", 1)[1], name
    want = sorted(map(tuple, assemble_wide(pairs, written).collect()), key=repr)
    assert sorted(map(tuple, assemble_wide(pairs, small).collect()), key=repr) == want and want
    whole = features.dim_features(d.dims, as_of="2002-01-01")
    both = [sorted(map(tuple, assemble_wide(fact, x).collect()), key=repr) for x in (written, whole)]
    assert both[0] == both[1]


@pytest.mark.parametrize("name,made", [
    ("group_size", []),
    ("refreshed_bounds", []),
    ("refreshed_friend_count", ["friends"]),
    ("refreshed_attendance", ["order_lines"]),
    ("stream_windows", ["order_lines"]),
])
def test_a_query_has_only_its_joined_tables_written(spark, tmp_path, monkeypatch, name, made):
    monkeypatch.setattr(analog, "_WRITTEN", {})
    monkeypatch.setattr(analog, "scratch_path", lambda _, folder: str(tmp_path / folder))
    entry.queries()[name](spark, SF_SMALL).collect()
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"analog-{m}" for m in made]
