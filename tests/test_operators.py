"""Operators on hand-built rows, with equivalence checks against the as-written forms."""

import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from affinity.functions.expressions import (
    clock_text,
    days_between,
    event_month,
    gender_code,
    iso_day_of_week,
    min_max,
    same_place,
)
from affinity.operators import (
    attendance_multiplicity,
    check_unique,
    edge_multiplicity,
    friend_status_counts,
    latest_per_key,
    min_max_scale,
    order_index,
    popularity_rank,
    status_pivot,
)
from affinity.operators.edges import degrees
from affinity.schemas import FRIEND_STATUS, USER_STATUS
from affinity.sources.fact import parse_payload


def test_latest_per_key_later_row_wins(spark):
    df = spark.createDataFrame(
        [("u1", "e1", "0", "2012-10-02 15:53:05.754000+00:00"),
         ("u1", "e1", "1", "2012-10-03 15:53:05.754000+00:00")],
        "userid string, eventid string, invited string, times string",
    )
    rows = latest_per_key(df, ["userid", "eventid"], ["times", "invited"]).collect()
    assert [r.invited for r in rows] == ["1"]


def test_latest_per_key_nulls_sort_last(spark):
    df = spark.createDataFrame(
        [("u3", "e9", "0", None), ("u4", "e1", "0", None), ("u4", "e1", "1", "2012-01-01")],
        "userid string, eventid string, invited string, times string",
    )
    out = {(r.userid, r.eventid): (r.invited, r.times)
           for r in latest_per_key(df, ["userid", "eventid"], ["times", "invited"]).collect()}
    assert out[("u3", "e9")] == ("0", None)
    assert out[("u4", "e1")] == ("1", "2012-01-01")


def test_latest_per_key_matches_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 30), rnd.randint(0, 5), rnd.choice([None, rnd.randint(0, 20)]), rnd.random())
            for _ in range(2000)]
    df = spark.createDataFrame(rows, "k1 int, k2 int, t int, v double")
    got = latest_per_key(df, ["k1", "k2"], ["t", "v"])
    w = Window.partitionBy("k1", "k2").orderBy(F.desc("t"), F.desc("v"))
    want = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_status_pivot_matches_two_level_form(spark):
    rnd = random.Random(3)
    statuses = ["yes", "no", "maybe", "invited", None, "other"]
    rows = [(str(rnd.randint(0, 40)), rnd.choice([None, str(rnd.randint(0, 9))]), rnd.choice(statuses))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "userid string, eventid string, status string")
    single = status_pivot(df, ["userid"], USER_STATUS, counted="eventid")
    counted = df.groupBy("userid", "status").agg(F.count("eventid").alias("cnt"))
    two = counted.groupBy("userid").agg(*[
        F.max(F.when(F.col("status") == v, F.col("cnt")).otherwise(0)).alias(n) for n, v in USER_STATUS.items()
    ])
    assert single.exceptAll(two).isEmpty() and two.exceptAll(single).isEmpty()
    assert dict(single.dtypes)["attended_count"] == "bigint"


def test_history_counts(spark):
    df = spark.createDataFrame(
        [("e1", "u1", "yes"), ("e2", "u1", "yes"), ("e3", "u1", None), (None, "u1", "yes")],
        "eventid string, userid string, status string",
    )
    r = status_pivot(df, ["userid"], USER_STATUS, counted="eventid").first()
    assert (r.attended_count, r.not_attended_count, r.maybe_attended_count, r.invited_event_count) == (2, 0, 0, 0)


def test_min_max_scale_cases(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 6.0), (3, None), (4, 4.0)], "id int, x double")
    out = {r.id: r.s for r in min_max_scale(df, {"s": "x"}).collect()}
    assert out[1] == 0.0 and out[2] == 1.0 and out[3] is None and out[4] == 0.5
    same = spark.createDataFrame([(1, 3.0), (2, 3.0)], "id int, x double")
    assert all(math.isnan(r.s) for r in min_max_scale(same, {"s": "x"}).collect())


def test_min_max_bounds_cast_first(spark):
    # As text, max('9', '10') is '9'; the numeric bounds are 10 and 9.
    df = spark.createDataFrame([("9",), ("10",)], "x string")
    out = sorted(r.s for r in min_max_scale(df, {"s": "x"}).collect())
    assert out == [0.0, 1.0]


def test_expressions(spark):
    df = spark.createDataFrame(
        [("2012-10-31T23:30:00.001Z", "2012-10-03 15:53:05.754000+00:00"),
         ("2012-10-31T23:30:00Z", "2012-10-03 15:53:05.754000+00:00")],
        "start string, times string",
    )
    rows = df.select(
        event_month("start").alias("m"), iso_day_of_week("start").alias("d"),
        clock_text("start").alias("h"), days_between("start", "times").alias("n"),
    ).collect()
    assert (rows[0].m, rows[0].d, rows[0].h, rows[0].n) == (10, "3", "23:30:00", 28)
    assert rows[1].h == ""


def test_gender_codes(spark):
    df = spark.createDataFrame([("male",), ("female",), ("other",), (None,)], "g string")
    assert [r.c for r in df.select(gender_code("g").alias("c")).collect()] == [0, 1, 2, 2]


def test_same_place(spark):
    df = spark.createDataFrame(
        [(None, "Paris", None, "France"),
         ("Lille, France", "Paris", None, "France"),
         ("Lille", "Paris", None, None),
         ("Lille", "", None, None),
         ("Austin, Texas", None, "texas", "USA")],
        "addr string, city string, state string, country string",
    )
    got = [r.s for r in df.select(same_place("addr", "city", "state", "country").alias("s")).collect()]
    assert got == [0, 1, 0, 0, 1]


def test_min_max_expression_nulls(spark):
    df = spark.createDataFrame([(None, 2.0, 1.0), (1.5, None, 1.0)], "v double, hi double, lo double")
    assert [r.s for r in df.select(min_max("v", "hi", "lo").alias("s")).collect()] == [None, None]


def test_popularity_rank(spark):
    ev = spark.createDataFrame(
        [("a", "X"), ("b", "X"), ("c", "X"), ("d", "B"), ("e", "B"), ("f", "A"), ("g", "A"), ("h", None)],
        "eventid string, city string",
    )
    got = {r.city: r.city_level for r in popularity_rank(ev, "city", "city_level").collect()}
    assert got == {"X": 1, "A": 2, "B": 3}
    ref = {r.city: r.city_level for r in popularity_rank(ev, "city", "city_level", mode="reference").collect()}
    assert ref["X"] == ref["A"] == ref["B"] == 1


def test_order_index_matches_row_number(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.randint(0, 50), f"k{rnd.randint(0, 10**6)}_{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, cnt int, name string")
    order = [F.col("cnt").desc(), F.col("name").asc()]
    got = order_index(df, order, name="pos", num_partitions=7)
    want = df.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert got.select("id", "pos").exceptAll(want.select("id", "pos")).isEmpty()
    assert got.count() == 5000


def _brute_friend_counts(pairs, edges, attendance):
    ea = attendance.alias("ea")
    uf = edges.alias("uf")
    j = (pairs.alias("f").join(ea, F.col("f.eventid") == F.col("ea.eventid"))
         .join(uf, (F.col("f.userid") == F.col("uf.userid")) & (F.col("ea.userid") == F.col("uf.friendid"))))
    g = j.groupBy(F.col("f.eventid").alias("eventid"), F.col("f.userid").alias("userid"), F.col("ea.status").alias("status")) \
        .agg(F.count(F.col("uf.friendid")).alias("cnt"))
    return g.groupBy("userid", "eventid").agg(*[
        F.max(F.when(F.col("status") == v, F.col("cnt")).otherwise(0)).alias(n) for n, v in FRIEND_STATUS.items()
    ])


def test_friend_status_counts_match_row_level_join(spark):
    rnd = random.Random(5)
    users = [f"u{i}" for i in range(40)]
    events = [f"e{i}" for i in range(15)]
    # a hot user and a hot event, duplicate edges and attendance rows included
    pairs = {(rnd.choice(users), rnd.choice(events)) for _ in range(300)}
    pairs |= {("u0", e) for e in events} | {(u, "e0") for u in users}
    edges = [(rnd.choice(users), rnd.choice(users)) for _ in range(400)] + [("u0", u) for u in users]
    statuses = ["yes", "no", "maybe", "invited"]
    att = [(rnd.choice(events), rnd.choice(users), rnd.choice(statuses)) for _ in range(500)]
    att += [("e0", u, "yes") for u in users]
    # unlisted and NULL statuses: as written, they give pairs with all-zero counts
    att += [(rnd.choice(events), rnd.choice(users), rnd.choice([None, "other"])) for _ in range(60)]
    p = spark.createDataFrame(sorted(pairs), "userid string, eventid string")
    e = spark.createDataFrame(edges, "userid string, friendid string")
    a = spark.createDataFrame(att, "eventid string, userid string, status string")
    got = friend_status_counts(p, edge_multiplicity(e), attendance_multiplicity(a, FRIEND_STATUS), FRIEND_STATUS)
    want = _brute_friend_counts(p, e, a)
    cols = ["userid", "eventid", *FRIEND_STATUS]
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty()
    assert want.select(cols).exceptAll(got.select(cols)).isEmpty()


def test_check_unique(spark):
    df = spark.createDataFrame([("u1",), ("u1",), ("u2",)], "userid string")
    with pytest.raises(ValueError):
        check_unique(df, ["userid"], "customers")
    check_unique(df.distinct(), ["userid"], "customers")


def test_payload_parse(spark):
    df = spark.createDataFrame([("a,b,1,t",), ("a,b,,",), ("a,b,1,t,extra",), ("a,b",)], "value string")
    good, bad = parse_payload(df)
    assert [tuple(r) for r in good.collect()] == [("a", "b", "1", "t"), ("a", "b", "", ""), ("a", "b", "1", "t")]
    assert [(r.value, r.n_fields) for r in bad.collect()] == [("a,b", 2)]


def test_rollups_from_attendance_pivot_match_direct_aggregates(spark):
    from affinity.plans.features import (
        attendance_history,
        event_attendance,
        event_status_from_pivot,
        history_from_pivot,
    )

    rnd = random.Random(9)
    statuses = ["yes", "no", "maybe", "invited", None, "other"]
    rows = [(rnd.choice([None, f"e{rnd.randint(0, 6)}"]), rnd.choice([None, f"u{rnd.randint(0, 9)}"]),
             rnd.choice(statuses)) for _ in range(800)]
    rows += [("e_only_null_user", None, "yes"), ("e_unlisted", "u1", "other")]
    att = spark.createDataFrame(rows, "eventid string, userid string, status string")
    pivot = attendance_multiplicity(att, FRIEND_STATUS)
    for direct, derived in ((attendance_history(att), history_from_pivot(pivot)),
                            (event_attendance(att), event_status_from_pivot(pivot))):
        cols = direct.columns
        assert direct.exceptAll(derived.select(cols)).isEmpty()
        assert derived.select(cols).exceptAll(direct).isEmpty()


def test_popularity_rank_hot_tie_group(spark):
    # 3000 places share the count 1 (one hot tie group) next to a few popular ones.
    rows = [(f"ev{i}", f"p{i:05d}") for i in range(3000)]
    rows += [(f"hot{i}-{j}", f"top{i}") for i in range(5) for j in range(2 + i)]
    ev = spark.createDataFrame(rows, "eventid string, city string")
    got = popularity_rank(ev, "city", "city_level")
    counts = ev.groupBy("city").agg(F.count("eventid").alias("event_cnt"))
    want = counts.withColumn(
        "city_level", F.row_number().over(Window.orderBy(F.desc("event_cnt"), F.asc("city"))).cast("int")
    )
    assert got.exceptAll(want.select(got.columns)).isEmpty()
    assert got.count() == 3005


def test_friend_match_makes_no_row_per_friend(spark):
    """Pairs travel with lists: what the joins give out does not grow with the friends."""
    from affinity.operators import edges as module

    n = 300  # friends of a user and attendees of an event, of which three are the same
    e = spark.range(20).withColumn("friendid", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumnRenamed("id", "userid")
    a = spark.range(20).withColumn("userid", F.explode(F.sequence(F.lit(n - 3), F.lit(2 * n)))).withColumnRenamed("id", "eventid")
    p = spark.range(20).withColumnRenamed("id", "userid").crossJoin(spark.range(20).withColumnRenamed("id", "eventid"))
    attended = attendance_multiplicity(a.withColumn("status", F.lit("yes")), FRIEND_STATUS)
    got = friend_status_counts(p, edge_multiplicity(e), attended, FRIEND_STATUS)
    rows = got.collect()
    assert len(rows) == 400 and {r.uf_attended_count for r in rows} == {3}
    plan = got._jdf.queryExecution().executedPlan()
    joins, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if "Join" in kind:
            joins.append(node.metrics().apply("numOutputRows").value())
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    assert module.PIECE < n < module.PIECE * 2  # lists of two pieces
    assert max(joins) <= 20 * 2 * n  # the tables with their degrees, not 400 pairs times 300 friends


def test_equal_marks_of_different_friends_count_for_nothing(spark, monkeypatch):
    from affinity.operators import edges as module

    monkeypatch.setattr(module, "PIECE", 4)
    monkeypatch.setattr(module, "_mark", lambda h: F.pmod(h, F.lit(3)).cast("short"))
    rnd = random.Random(3)
    pairs = {(rnd.randint(0, 12), rnd.randint(0, 9)) for _ in range(90)}
    edges = [(rnd.randint(0, 12), rnd.randint(0, 60)) for _ in range(300)] + [(0, i) for i in range(60)]
    att = [(rnd.randint(0, 9), rnd.randint(0, 60), rnd.choice(["yes", "no", None])) for _ in range(300)]
    att += [(0, i, "maybe") for i in range(60)]
    p = spark.createDataFrame(sorted(pairs), "userid long, eventid long")
    e = spark.createDataFrame(edges + [(None, 1), (1, None)], "userid long, friendid long")
    a = spark.createDataFrame(att + [(None, 1, "yes"), (1, None, "yes")], "eventid long, userid long, status string")
    got = friend_status_counts(p, edge_multiplicity(e), attendance_multiplicity(a, FRIEND_STATUS), FRIEND_STATUS)
    want = _brute_friend_counts(p, e, a)
    cols = ["userid", "eventid", *FRIEND_STATUS]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


@pytest.mark.parametrize("users,events", [(3, 3), (3, 99), (99, 3), (99, 99)])
def test_long_lists_on_either_side_match_row_level_join(spark, monkeypatch, users, events):
    """Lists over PIECE on one side, both or none; a long list may be empty or have no piece 0."""
    from affinity.operators import edges as module

    monkeypatch.setattr(module, "PIECE", 8)
    monkeypatch.setattr(module, "SLACK", 2)
    rnd = random.Random(users * events)
    pairs = {(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(70)} | {(0, 0), (1, 0), (0, 1)}
    edges = [(rnd.randint(0, 9), rnd.randint(0, 60)) for _ in range(30)] + [(0, i) for i in range(60) if i % users]
    att = [(rnd.randint(0, 9), rnd.randint(0, 60), rnd.choice(["yes", "no", None])) for _ in range(30)]
    att += [(0, i, "maybe") for i in range(60) if i % events]
    p = spark.createDataFrame(sorted(pairs), "userid long, eventid long")
    e = spark.createDataFrame(edges + [(2, None)] * 9, "userid long, friendid long")
    a = spark.createDataFrame(att + [(2, None, "yes")] * 9, "eventid long, userid long, status string")
    got = friend_status_counts(
        p, edge_multiplicity(e), attendance_multiplicity(a, FRIEND_STATUS), FRIEND_STATUS,
        degrees(e, "userid", "user_deg"), degrees(a, "eventid", "event_deg"),
    )
    cols = ["userid", "eventid", *FRIEND_STATUS]
    want = _brute_friend_counts(p, e, a)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_friend_match_deals_each_table_once_per_use(spark):
    """A pair goes to its event, to its user and back. Without broadcasts it took 25 shuffles."""
    p = spark.createDataFrame([(1, 1)], "userid long, eventid long")
    e = spark.createDataFrame([(1, 2)], "userid long, friendid long")
    a = spark.createDataFrame([(1, 2, "yes")], "eventid long, userid long, status string")
    for conf in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(conf, {"spark.sql.adaptive.enabled": "false"}.get(conf, "-1"))
    try:
        got = friend_status_counts(p, edge_multiplicity(e), attendance_multiplicity(a, FRIEND_STATUS), FRIEND_STATUS)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for conf in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(conf)
    dealt = len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))
    assert dealt <= 16, dealt
    assert [tuple(r) for r in got.select("userid", "eventid", "uf_attended_count").collect()] == [(1, 1, 1)]
