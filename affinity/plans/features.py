"""Feature blocks.

Dimension-side blocks depend only on the dimension tables and are keyed by one grain
(user or event); they can be computed once and reused across micro-batches. Fact-side
blocks (C4–C7) attach them to the de-duplicated fact pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from functools import partial, reduce
from typing import Callable, Mapping, Optional

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.expressions import (
    age_at,
    as_date,
    clock_text,
    days_between,
    event_month,
    gender_code,
    iso_day_of_week,
    safe_ratio,
    same_place,
)
from affinity.operators.edges import (
    attendance_multiplicity,
    degrees,
    edge_multiplicity,
    friend_status_counts,
    has_edge,
)
from affinity.operators.latest import latest_per_key
from affinity.operators.pivot import status_pivot
from affinity.operators.rank import popularity_ranks
from affinity.operators.scale import min_max_scale
from affinity.schemas import EVENT_STATUS, FRIEND_STATUS, USER_STATUS, Dims, check_mode
from affinity.session import SCRATCH_CODEC, shuffles_dropped

U, E = "userid", "eventid"

# (count column, ratio column) of the friends-on-event block.
FRIEND_RATIOS = (
    ("uf_invited_count", "uf_invited_prec"),
    ("uf_attended_count", "uf_attended_prec"),
    ("uf_not_attended_count", "uf_not_attended_prec"),
    ("uf_maybe_attended_count", "uf_maybe_prec"),
)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def dedup_fact(fact: DataFrame) -> DataFrame:
    """C1 on the fact: latest invitation per (userid, eventid) by times, then invited."""
    return latest_per_key(fact, [U, E], ["times", "invited"])


# Place tables of at most this many rows (place and level) are broadcast.
PLACES_BROADCAST = 500_000

# ---------------------------------------------------------------- dimension-side blocks


def group_size_features(event_groups: DataFrame) -> DataFrame:
    """(eventid, event_type, event_count) — the number of events in the event's group type.

    Events whose group type is NULL drop out (the group-size join is an equi-join).
    The size table has one row per group type and is joined back on that key; a group
    type holding a third of all events is one row on the small side, never a window over
    the whole group.
    """
    sizes = event_groups.groupBy("grouptype").agg(F.count(E).alias("event_count"))
    return event_groups.join(sizes, "grouptype").select(E, F.col("grouptype").alias("event_type"), "event_count")


def customer_features(customers: DataFrame, as_of=None, mode: str = "intended") -> DataFrame:
    """(userid, locale, gender, age, timezone, member_days, location).

    member_days is joinedat min-max scaled over all customers; intended mode takes the
    bounds on the numeric value, reference mode on the column's own type.
    """
    check_mode(mode)
    scaled = min_max_scale(customers, {"member_days": "joinedat"}, cast_first=(mode == "intended"))
    return scaled.select(
        U,
        F.col("localename").alias("locale"),
        gender_code("gender").alias("gender"),
        age_at("birthyear", _as_of(as_of)).alias("age"),
        "timezone",
        "member_days",
        "location",
    )


def attendance_history(event_attendees: DataFrame) -> DataFrame:
    """A4: (userid, invited_event_count, attended_count, not_attended_count, maybe_attended_count)."""
    return status_pivot(event_attendees, [U], USER_STATUS, counted=E)


def friend_totals(user_friends: DataFrame) -> DataFrame:
    """(userid, friend_count) — outgoing edge rows with a non-NULL friend."""
    return user_friends.groupBy(U).agg(F.count("friendid").alias("friend_count"))


def event_attendance(event_attendees: DataFrame) -> DataFrame:
    """(eventid, event_invited_count, event_attended_count, event_not_att_count, event_maybe_count)."""
    return status_pivot(event_attendees, [E], EVENT_STATUS, counted=U)


def event_calendar(events: DataFrame) -> DataFrame:
    """(eventid, event_month, event_dayofweek, event_hour) from starttime."""
    return events.select(
        E,
        event_month("starttime").alias("event_month"),
        iso_day_of_week("starttime").alias("event_dayofweek"),
        clock_text("starttime").alias("event_hour"),
    )


def geo_scale(events: DataFrame, scope: Optional[DataFrame] = None) -> DataFrame:
    """A3 + C10: (eventid, lat_prec, lng_prec) with bounds over all events.

    `scope` (eventid) restricts the output rows, never the bounds.
    """
    rows = events if scope is None else events.join(scope, E, "left_semi")
    scaled = min_max_scale(rows, {"lat_prec": "lat", "lng_prec": "lng"}, bounds_from=events)
    return scaled.select(E, "lat_prec", "lng_prec")


def event_profile(events: DataFrame, mode: str = "intended", scope: Optional[DataFrame] = None) -> DataFrame:
    """Event-grain block: host, place, start time, calendar parts, popularity levels, scaled
    location. `scope` (eventid) restricts the output rows, never levels or bounds."""
    check_mode(mode)
    rows = events if scope is None else events.join(scope, E, "left_semi")
    scaled = min_max_scale(rows, {"lat_prec": "lat", "lng_prec": "lng"}, bounds_from=events)
    base = scaled.select(
        E,
        F.col(U).alias("host"),
        "starttime",
        as_date("starttime").alias("start_date"),
        "city",
        "state",
        "country",
        event_month("starttime").alias("event_month"),
        iso_day_of_week("starttime").alias("event_dayofweek"),
        clock_text("starttime").alias("event_hour"),
        "lat_prec",
        "lng_prec",
    )
    levels = {"city": "city_level", "country": "country_level"}
    if mode == "reference":  # the rank inside a place's own partition
        return base.withColumns({level: F.when(F.col(k).isNotNull(), F.lit(1)) for k, level in levels.items()})
    ranks = popularity_ranks(events, levels)
    # The levels of a key are its places' positions, so one pass over both tables counts them.
    sizes = reduce(DataFrame.unionByName, (ranks[k].select(F.lit(k).alias("key")) for k in levels))
    small = {r["key"]: r["count"] <= PLACES_BROADCAST for r in sizes.groupBy("key").count().collect()}
    for key, level in levels.items():
        base = _attach_level(base, ranks[key].select(key, level), key, small.get(key, True))
    return base


def _attach_level(base: DataFrame, places: DataFrame, key: str, small: bool) -> DataFrame:
    """`places` (one row per place) joined to the events: broadcast when their number was
    found small, so that a hot place moves no event; else shuffled, with the NULL places
    spread by event."""
    if small:
        return base.join(F.broadcast(places), key, "left")
    spread = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\0"), F.col(E).cast("string")))
    keyed = places.withColumn("_place", F.col(key).cast("string")).drop(key)
    return base.withColumn("_place", spread).join(keyed, "_place", "left").drop("_place")


# The key that each block is bucketed by when it is written, and the bucket's column.
BLOCK_KEYS = {
    "users": U, "events": E, "edges": U, "attendance": E, "hosts": E, "user_degree": U, "event_degree": E,
}
BUCKET = "_bucket"

# Reads a block: the folders of the given buckets (None: all), each of its tables cut by a function.
Reader = Callable[[Optional[list[int]], Callable[[DataFrame], DataFrame]], DataFrame]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def write_block(df: DataFrame, key: str, path: str, buckets: int) -> DataFrame:
    """`df` written with a folder for each bucket of `key`, and read back with BUCKET.
    Rebalancing gives a bucket one file, or several where a hot key makes it large."""
    tagged = df.withColumn(BUCKET, bucket_of(key, buckets))
    with shuffles_dropped(df.sparkSession):
        writer = tagged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET)
        writer.parquet(path, compression=SCRATCH_CODEC)
    return df.sparkSession.read.schema(tagged.schema).parquet(path)


def read_buckets(
    written: DataFrame, buckets: Optional[list[int]], cut: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    return cut((written if buckets is None else written.where(F.col(BUCKET).isin(buckets))).drop(BUCKET))


@dataclass(frozen=True)
class DimFeatures:
    """Dimension-side blocks of the wide table, pre-joined by grain.

    users:  customers ⟕ history ⟕ friend totals, one row per customer (joined inner)
    events: groups ⋈ events ⟕ whole-event status counts, one row per grouped event
            (joined inner)
    edges, attendance: the inputs of the friends-on-event match.
    hosts:  (eventid, host) of every event, for the host edge.

    The blocks of one grain are joined with each other while they are small, so the fact
    side is joined once per grain instead of once per block.
    """

    users: DataFrame            # userid grain
    events: DataFrame           # eventid grain
    edges: DataFrame            # (userid, friendid, edge_n)
    attendance: DataFrame       # (eventid, friendid, <friend status counts>)
    hosts: DataFrame            # (eventid, host)
    user_degree: DataFrame      # (userid, user_deg)
    event_degree: DataFrame     # (eventid, event_deg)
    host_edges: Optional[DataFrame] = None  # the edges that the host match reads, if not all
    buckets: int = 1            # of the written blocks; see `write`
    bucketed: Mapping[str, Reader] = field(default_factory=dict)  # how to read a part of a block

    def frames(self) -> dict[str, DataFrame]:
        frames = {f.name: getattr(self, f.name) for f in fields(self)}
        return {k: v for k, v in frames.items() if isinstance(v, DataFrame)}

    def _touched(self, keys: DataFrame, *columns: str) -> dict[str, Optional[list[int]]]:
        """Per key column the buckets that its values fall into (at most `buckets` numbers
        each), or None where that is all of them or the blocks are not bucketed."""
        if self.buckets == 1:
            return dict.fromkeys(columns)
        found = keys.select(F.explode(F.array(*(
            F.struct(F.lit(c).alias("key"), bucket_of(c, self.buckets).alias("b")) for c in columns
        ))).alias("x")).select("x.*").distinct().collect()
        by_key = {c: sorted(r["b"] for r in found if r["key"] == c) for c in columns}
        return {c: None if len(b) == self.buckets else b for c, b in by_key.items()}

    def _block(self, name: str, buckets: Optional[list[int]], *keys: tuple[DataFrame, str]) -> DataFrame:
        """A block, or only the folders of the given buckets of it, cut to some columns' keys."""
        def cut(df: DataFrame) -> DataFrame:
            return reduce(lambda x, k: x.join(k[0], k[1], "left_semi"), keys, df)

        return self.bucketed[name](buckets, cut) if name in self.bucketed else cut(getattr(self, name))

    def restricted(self, pairs: DataFrame) -> "DimFeatures":
        """The blocks cut down to what `pairs` (userid, eventid; of checked, small size) can
        reach: of bucketed blocks only the folders of the keys are read, and broadcast semi
        joins right above the scans leave the keys' rows. The assembly then reads, shuffles
        and aggregates no whole table. Ranks and bounds are in the blocks already."""
        users, events = F.broadcast(pairs.select(U).distinct()), F.broadcast(pairs.select(E).distinct())
        at = self._touched(pairs, U, E)
        hosts = self._block("hosts", at[E], (events, E))
        of_hosts = F.broadcast(hosts.select(F.col("host").alias(U)).distinct())
        towards = F.broadcast(pairs.select(F.col(U).alias("friendid")).distinct())
        host_edges = self._block("edges", self._touched(hosts, "host")["host"], (of_hosts, U), (towards, "friendid"))
        user_keyed = {k: self._block(k, at[U], (users, U)) for k, c in BLOCK_KEYS.items() if c == U}
        event_keyed = {k: self._block(k, at[E], (events, E)) for k, c in BLOCK_KEYS.items() if c == E}
        event_keyed["hosts"] = hosts
        return replace(self, **user_keyed, **event_keyed, host_edges=host_edges, buckets=1, bucketed={})

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "DimFeatures":
        return replace(self, **{k: v.persist(level) for k, v in self.frames().items()})

    def write(self, base: str, buckets: int = 1, lazy: tuple[str, ...] = ()) -> "DimFeatures":
        """Materialise every block as parquet under `base` (a shared folder) and read it back.

        With several `buckets`, a block has a folder for each bucket of its key, so that
        `restricted` reads the folders of a micro-batch's keys only. `lazy` blocks are not written.
        """
        out, bucketed = {}, {}
        for name, df in self.frames().items():
            if name in lazy:
                continue
            path, spark = f"{base.rstrip('/')}/{name}", df.sparkSession
            if buckets == 1 or name not in BLOCK_KEYS:
                with shuffles_dropped(spark):
                    df.write.mode("overwrite").parquet(path, compression=SCRATCH_CODEC)
                out[name] = spark.read.schema(df.schema).parquet(path)
                continue
            written = write_block(df, BLOCK_KEYS[name], path, buckets)
            bucketed[name] = partial(read_buckets, written)
            out[name] = written.drop(BUCKET)
        return replace(self, **out, buckets=buckets, bucketed=bucketed)

    def unpersist(self) -> None:
        for df in self.frames().values():
            df.unpersist()


def _rollup(pivot: DataFrame, key: str, other: str, outputs: dict[str, str]) -> DataFrame:
    """Sum the (event, person) attendance pivot up to one key.

    Equals `status_pivot` on the raw rows with `counted=other`: only rows whose `other`
    column is non-NULL are counted, and every key with any attendance row gets a row.
    """
    by_status = {status: col for col, status in FRIEND_STATUS.items()}
    counted = F.col(other).isNotNull()
    return pivot.groupBy(F.col(key).alias(U if key == "friendid" else key)).agg(*[
        F.sum(F.when(counted, F.col(by_status[status])).otherwise(F.lit(0))).cast("long").alias(name)
        for name, status in outputs.items()
    ])


def history_from_pivot(pivot: DataFrame) -> DataFrame:
    """A4 from the attendance pivot: (userid, <user status counts>)."""
    return _rollup(pivot, "friendid", "eventid", USER_STATUS)


def event_status_from_pivot(pivot: DataFrame) -> DataFrame:
    """A6 from the attendance pivot: (eventid, <whole-event status counts>)."""
    return _rollup(pivot, "eventid", "friendid", EVENT_STATUS)


def with_user_counts(customers: DataFrame, history: DataFrame, friends: DataFrame) -> DataFrame:
    """The user block of `customer_features`, A4 and A7."""
    counted = customers.join(history, U, "left").join(friends, U, "left")
    return counted.fillna(0, subset=[*USER_STATUS, "friend_count"])


def grouped_events(dims: Dims, mode: str = "intended") -> DataFrame:
    """The event block without the whole-event status counts."""
    return group_size_features(dims.event_groups).join(event_profile(dims.events, mode), E)


def event_hosts(events: DataFrame) -> DataFrame:
    return events.select(E, F.col(U).alias("host"))


def user_degrees(friends: DataFrame) -> DataFrame:
    """(userid, user_deg) from A7."""
    return friends.where(F.col(U).isNotNull()).select(U, F.col("friend_count").alias("user_deg"))


def event_degrees(status: DataFrame) -> DataFrame:
    """(eventid, event_deg) from A6."""
    attended = reduce(lambda a, b: a + b, (F.col(c) for c in EVENT_STATUS))
    return status.where(F.col(E).isNotNull()).select(E, attended.alias("event_deg"))


def dim_features(dims: Dims, as_of=None, mode: str = "intended") -> DimFeatures:
    """All dimension blocks. The user history and the whole-event counts are counted on the
    attendance rows, which partial aggregates make few before their shuffles; only the friend
    match reads the larger pivot per (event, person)."""
    check_mode(mode)
    friends, status = friend_totals(dims.user_friends), event_attendance(dims.event_attendees)
    # The degrees only choose a side of the friend match. They read the aggregates that the
    # user and event blocks need anyway, so no large table is grouped by one key twice.
    return DimFeatures(
        users=with_user_counts(
            customer_features(dims.customers, as_of, mode), attendance_history(dims.event_attendees), friends
        ),
        events=grouped_events(dims, mode).join(status, E, "left"),
        edges=edge_multiplicity(dims.user_friends),
        attendance=attendance_multiplicity(dims.event_attendees, FRIEND_STATUS),
        hosts=event_hosts(dims.events),
        user_degree=user_degrees(friends),
        event_degree=event_degrees(status),
    )


# ---------------------------------------------------------------- fact-side blocks


def fact_events(fact: DataFrame) -> DataFrame:
    """The distinct events of the fact."""
    return fact.select(E).distinct()


def restrict_to_fact_events(df: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of `df` whose eventid occurs in the fact (a left semi join)."""
    return df.join(fact.select(E), E, "left_semi")


def user_history_features(fact: DataFrame, dims: Dims) -> DataFrame:
    """C4: (userid, eventid, invite_days, attended/not/maybe/invited counts, friend_count).

    invite_days = days from the invitation to the event start, 0 when unknown; the counts
    are the user's own attendance history and friend total, 0 when absent.
    """
    starts = dims.events.select(E, "starttime")
    hist = attendance_history(dims.event_attendees)
    fr = friend_totals(dims.user_friends)
    # One join on the user: Spark can split a hot user there, not in a chain of joins.
    users = hist.join(fr, U, "full")
    out = (
        fact.select(U, E, "times")
        .join(starts, E, "left")
        .withColumn("invite_days", days_between("starttime", "times"))
        .join(users, U, "left")
    )
    cols = ["invite_days", *USER_STATUS, "friend_count"]
    return out.select(U, E, *cols).fillna(0, subset=cols)


def friend_ratio_denominator(fact: DataFrame, friends: DataFrame, mode: str) -> DataFrame:
    """(userid, fri_count) for the fact's users.

    intended: the user's friend count. reference: friend count × the user's number of
    fact rows (the count is taken over the fact ⟕ friends fan-out); computed as the
    product of two aggregates, without materialising the fan-out.
    """
    check_mode(mode)
    users = fact.groupBy(U).agg(F.count(F.lit(1)).alias("_fact_rows"))
    joined = users.join(friends, U, "left").withColumn("friend_count", F.coalesce("friend_count", F.lit(0)))
    if mode == "intended":
        return joined.select(U, F.col("friend_count").cast("long").alias("fri_count"))
    return joined.select(U, (F.col("friend_count") * F.col("_fact_rows")).cast("long").alias("fri_count"))


def with_friend_ratios(df: DataFrame, denominator: str = "fri_count") -> DataFrame:
    return df.withColumns({ratio: safe_ratio(count, denominator) for count, ratio in FRIEND_RATIOS})


def friends_on_event(fact: DataFrame, dims: Dims) -> DataFrame:
    """(userid, eventid, <friend status counts>): `friend_status_counts` over the dimension
    tables, with the degrees counted on their rows."""
    return friend_status_counts(
        fact,
        edge_multiplicity(dims.user_friends),
        attendance_multiplicity(dims.event_attendees, FRIEND_STATUS),
        FRIEND_STATUS,
        degrees(dims.user_friends, U, "user_deg"),
        degrees(dims.event_attendees, E, "event_deg"),
    )


def friend_attendance_features(fact: DataFrame, dims: Dims, mode: str = "intended") -> DataFrame:
    """Per fact pair, the user's friends on the event by status, and those counts
    divided by the friend count (`fri_count`, see `friend_ratio_denominator`)."""
    counts = friends_on_event(fact, dims)
    out = fact.select(U, E).join(counts, [U, E], "left").fillna(0, subset=list(FRIEND_STATUS))
    out = out.join(friend_ratio_denominator(fact, friend_totals(dims.user_friends), mode), U, "left")
    return with_friend_ratios(out).select(
        U, E, *FRIEND_STATUS, "fri_count", *[r for _, r in FRIEND_RATIOS]
    )


def event_stat_features(fact: DataFrame, dims: Dims, mode: str = "intended") -> DataFrame:
    """Per fact pair, whole-event status counts (NULL when the event has no attendance
    rows), calendar parts, popularity levels and scaled location."""
    # Both blocks only for the fact's events (J6); popularity and bounds stay global.
    scope = fact_events(fact)
    status = event_attendance(dims.event_attendees.join(scope, E, "left_semi"))
    prof = event_profile(dims.events, mode, scope)
    cols = [
        *EVENT_STATUS, "event_month", "event_dayofweek", "event_hour",
        "city_level", "country_level", "lat_prec", "lng_prec",
    ]
    # One join on the event, so that Spark can split a hot one.
    return fact.select(U, E).join(status.join(prof, E, "full"), E, "left").select(E, U, *cols)


def host_affinity_features(fact: DataFrame, dims: Dims, mode: str = "intended") -> DataFrame:
    """Per fact pair with a customer row, creator_is_friend and location_similar.

    intended: creator_is_friend = 1 iff the directed edge (host -> user) exists;
    location_similar = the user's location names the event's city, state or country.
    reference: the two flags come out constant 1 and 0.
    """
    check_mode(mode)
    located = fact.select(U, E).join(dims.customers.select(U, "location"), U)
    if mode == "reference":
        return located.select(U, E, F.lit(1).alias("creator_is_friend"), F.lit(0).alias("location_similar"))
    places = dims.events.select(E, F.col(U).alias("host"), "city", "state", "country")
    with_place = located.join(places, E, "left")
    flagged = has_edge(with_place, edge_multiplicity(dims.user_friends), "host", U, "creator_is_friend")
    return flagged.select(
        U, E, "creator_is_friend",
        same_place("location", "city", "state", "country").alias("location_similar"),
    )
