"""One-hop edge matching on a directed social graph."""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators.pivot import status_pivot
from affinity.session import write_scratch

# A user's friends and an event's attendees are kept as lists in 2^level pieces of about this
# many, of at most 2^MAX_LEVEL (the bits of a hash that name a piece).
PIECE, MAX_LEVEL = 256, 16
# A pair goes by its user's friends unless they are more than the attendees by this many.
SLACK = 8
# At most this many keys with several pieces are broadcast.
LONG_BROADCAST = 500_000


def edge_multiplicity(edges: DataFrame, src: str = "userid", dst: str = "friendid") -> DataFrame:
    """(userid, friendid, edge_n): one row per directed edge with its duplicate count."""
    return (
        edges.select(F.col(src).alias("userid"), F.col(dst).alias("friendid"))
        .filter(F.col("userid").isNotNull() & F.col("friendid").isNotNull())
        .groupBy("userid", "friendid")
        .agg(F.count(F.lit(1)).alias("edge_n"))
    )


def attendance_multiplicity(
    attendance: DataFrame, statuses: Mapping[str, str], event: str = "eventid", person: str = "userid"
) -> DataFrame:
    """(eventid, friendid, <one count per output>): attendance rows per (event, person) and
    status, one row per (event, person) pair that has any attendance row (NULL keys and
    unlisted statuses included, with zero counts).

    Kept unfiltered so that the per-user history and the per-event status counts can be
    summed from it exactly (one scan and one shuffle of the attendance table for all three
    uses); the equi-joins of the friend match drop the NULL keys by themselves.
    """
    rows = attendance.select(
        F.col(event).alias("eventid"), F.col(person).alias("friendid"), F.col("status")
    )
    return status_pivot(rows, ["eventid", "friendid"], statuses)


def degrees(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): the rows of each non-NULL key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def friend_status_counts(
    pairs: DataFrame,
    edge_n: DataFrame,
    attend_n: DataFrame,
    outputs: Mapping[str, str],
    user_deg: Optional[DataFrame] = None,
    event_deg: Optional[DataFrame] = None,
    staged: bool = False,
    below: Optional[str] = None,
) -> DataFrame:
    """For each (userid, eventid) in `pairs`: how many of the user's friends have each status
    on that event. Returns only pairs with at least one match.

    `edge_n` comes from `edge_multiplicity`, `attend_n` from `attendance_multiplicity` with
    the same `outputs`. A friend counts once per (edge row, attendance row) combination,
    i.e. duplicates in either input multiply, as a row-level join of
    pairs ⋈ attendance ⋈ edges would.

    The product pairs ⋈ friends ⋈ attendance is the heavy step. Each pair is matched from
    the smaller side: through the user's friends when the user has no more friends than
    the event has attendees, else through the event's attendees, and the other side is
    probed. The work per pair is therefore min(friends of user, attendees of event), so
    neither a hot event nor a hot user makes it quadratic. The degrees (userid, user_deg)
    and (eventid, event_deg) only choose the side and cut the lists, so plain row counts do;
    they are counted here unless given.

    No row is made per friend. A pair meets its event's degree, then its user's friends; if
    those are the smaller list (or larger by less than SLACK, which is cheaper than one more
    pass of the pair), it takes a two-byte mark per friend (the high bits of its hash) to the
    event's attendees, else it fetches the attendees' marks and comes back to the friends.
    Friends whose marks occur on both sides are then looked up among the edges and the
    attendance, so equal marks of different friends count for nothing.

    A list of more than PIECE friends is cut by their hash into pieces of about that size, and
    marks go to the piece that they fall into; AQE splits a hot key of either kind. Long lists
    are counted first: where there are none, no list is cut. A key's rows are dealt once, to
    the place where its list is joined.

    `staged`: the candidates are written to the shared checkpoint folder (or `below`) before they
    are looked up, so that the disk does not hold the shuffles of the lists and those of the
    lookups at once. For `edge_n` and `attend_n` that are read from files.

    AQE picks the strategy of the joins from exact runtime sizes: a broadcast hash join
    under `spark.sql.adaptive.autoBroadcastJoinThreshold` (the pairs are then never
    shuffled), a shuffled hash join when each partition is under
    `spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold`, else a sort-merge join.
    """
    names = list(outputs)
    user_deg = degrees(edge_n, "userid", "user_deg") if user_deg is None else user_deg
    event_deg = degrees(attend_n, "eventid", "event_deg") if event_deg is None else event_deg
    # The friends of both tables are compared as they are when their types agree, else as text.
    same_friends = edge_n.schema["friendid"].dataType == attend_n.schema["friendid"].dataType
    friend = F.col("friendid") if same_friends else F.col("friendid").cast("string")
    # Every reader reads all columns of the aggregates (the conditions on counts always hold)
    # and the same rows, so that Spark shuffles each aggregate once.
    edge_n = edge_n.where(F.col("edge_n") >= 0)
    known = F.col("eventid").isNotNull() & F.col("friendid").isNotNull()
    attend_n = attend_n.where(known & (F.greatest(*names, F.lit(0)) >= 0))
    long_users, long_events = _long(user_deg, "userid", "user_deg"), _long(event_deg, "eventid", "event_deg")
    users = _lists(edge_n.select("userid", friend.alias("friendid")), "userid", long_users)
    events = _lists(attend_n.select("eventid", friend.alias("friendid")), "eventid", long_events)

    # The pairs are read once: those that take marks to the event and those that fetch some go
    # together to the event, and what either brings goes together to the user.
    near = pairs.select("userid", "eventid").join(event_deg.select("eventid", "event_deg"), "eventid").join(
        # Marks are made once per list, not once per pair; only cut lists are dealt by whole hashes.
        users.select(
            "userid", "piece", F.col("deg").alias("user_deg"),
            _marks("hashes").alias("hashes") if long_events is None else F.col("hashes"),
        ),
        "userid",
    )
    by_user = F.col("user_deg") <= F.col("event_deg") + SLACK
    of_event, of_user = _level(F.col("event_deg")), _level(F.col("user_deg")).alias("level")
    near = near.where(by_user | (F.col("piece") == 0))  # every list has a piece 0
    if long_events is None:
        sent = near.select("userid", "eventid", of_user, F.when(by_user, F.col("hashes")).alias("marks"))
    else:
        none = F.lit(None).cast("array<smallint>")
        last = F.pow(F.lit(2), of_event).cast("int") - 1
        all_pieces = F.transform(F.sequence(F.lit(0), last), lambda p: F.struct(p.alias("piece"), none.alias("marks")))
        sent = near.select(
            "userid", "eventid", of_user, F.inline(F.when(by_user, _by_piece(F.col("hashes"), of_event)).otherwise(all_pieces))
        )
    at_event = sent.join(_probed(events, "eventid"), _on("eventid", long_events)).where(
        F.col("marks").isNull() | (F.size(_both()) > 0)
    )
    brings = F.col("marks").isNotNull()
    if long_users is None:
        back = at_event.select(
            "userid", "eventid", F.when(brings, _candidates()).alias("found"), F.when(~brings, F.col("_marks")).alias("marks")
        )
    else:
        none = F.lit(None).cast("array<smallint>")
        one = F.array(F.struct(F.lit(0).alias("piece"), none.alias("marks")))
        back = at_event.select(
            "userid", "eventid", F.when(brings, _candidates()).alias("found"),
            F.inline(F.when(brings, one).otherwise(_by_piece(F.col("_hashes"), F.col("level")))),
        )
    at_user = back.join(_probed(users, "userid"), _on("userid", long_users)).where(
        F.col("found").isNotNull() | (F.size(_both()) > 0)
    )
    found = at_user.select("userid", "eventid", F.explode(F.coalesce("found", _candidates())).alias("friendid"))
    if staged:
        found = write_scratch(found, "friend-candidates", below)
    matches = found.join(edge_n, ["userid", "friendid"]).join(attend_n, ["eventid", "friendid"])
    return matches.groupBy("userid", "eventid").agg(
        *[F.sum(F.col(n) * F.col("edge_n")).cast("long").alias(n) for n in names]
    )


def _long(degree: DataFrame, key: str, count: str) -> Optional[DataFrame]:
    """(key, deg): the keys with lists of several pieces, to be broadcast when their number was
    found small; None when there are none."""
    rows = degree.where(F.col(count) > PIECE).select(key, F.col(count).alias("deg"))
    found = rows.limit(LONG_BROADCAST + 1).count()
    if not found:
        return None
    return F.broadcast(rows) if found <= LONG_BROADCAST else rows


def _lists(rows: DataFrame, key: str, long: Optional[DataFrame]) -> DataFrame:
    """(key, piece, deg, friends, hashes): the friends of each key, those of `long` keys in
    pieces (which have one 0, if without friends). Rows are dealt by key and piece before
    they are gathered: lists of the few that one task reads would take more room."""
    if long is None:
        lists = rows.repartition(key).groupBy(key).agg(F.collect_list("friendid").alias("friends"))
        lists = lists.select(key, F.lit(0).alias("piece"), F.size("friends").cast("long").alias("deg"), "friends")
    else:
        none = F.lit(None).cast(rows.schema["friendid"].dataType)
        cut = rows.join(long, key, "left").unionByName(long.select(key, none.alias("friendid"), "deg"))
        piece = F.coalesce(_piece(F.hash("friendid"), _level(F.col("deg"))), F.lit(0))
        cut = cut.select(key, "deg", F.when(F.col("friendid").isNull(), 0).otherwise(piece).alias("piece"), "friendid")
        lists = cut.repartition(key, "piece").groupBy(key, "piece").agg(
            F.max("deg").alias("deg"), F.collect_list("friendid").alias("friends")
        )
        lists = lists.withColumn("deg", F.coalesce(F.col("deg"), F.size("friends").cast("long")))
    return lists.withColumn("hashes", F.transform("friends", lambda f: F.hash(f)))


def _probed(lists: DataFrame, key: str) -> DataFrame:
    return lists.select(key, "piece", "friends", F.col("hashes").alias("_hashes"), _marks("hashes").alias("_marks"))


def _on(key: str, long: Optional[DataFrame]) -> list[str]:
    """Where no list is cut, the key says where a list is."""
    return [key] if long is None else [key, "piece"]


def _both() -> Column:
    return F.array_intersect("marks", "_marks")


def _candidates() -> Column:
    """The listed friends whose marks are among those brought."""
    return F.filter("friends", lambda f: F.array_contains("marks", _mark(F.hash(f))))


def _level(degree: Column) -> Column:
    """A list of `degree` friends is cut into 2^level pieces."""
    cut = F.least(F.lit(MAX_LEVEL), F.ceil(F.log2(degree / PIECE)).cast("int"))
    return F.when(degree > PIECE, cut).otherwise(F.lit(0))


def _piece(hashed: Column, level: Column) -> Column:
    """The low bits of a friend's hash."""
    return F.pmod(hashed, F.pow(F.lit(2), level).cast("int"))


def _mark(hashed: Column) -> Column:
    """The high bits of a friend's hash."""
    return F.shiftright(hashed, 16).cast("short")


def _marks(hashes: str) -> Column:
    return F.transform(hashes, _mark)


def _by_piece(hashes: Column, level: Column) -> Column:
    """(piece, marks): the friends' marks by the piece of the other side's list that they fall into."""
    whole = F.array(F.struct(F.lit(0).alias("piece"), F.transform(hashes, _mark).alias("marks")))
    pieces = F.array_distinct(F.transform(hashes, lambda h: _piece(h, level)))
    return F.when(level == 0, whole).otherwise(F.transform(pieces, lambda p: F.struct(
        p.alias("piece"), F.transform(F.filter(hashes, lambda h: _piece(h, level) == p), _mark).alias("marks")
    )))


def has_edge(
    df: DataFrame,
    edge_n: DataFrame,
    src: str,
    dst: str,
    name: str,
) -> DataFrame:
    """Add `name` = 1 if the directed edge (df[src] -> df[dst]) exists, else 0.

    `edge_n` holds one row per edge (see `edge_multiplicity`), so the left join never
    multiplies rows.
    """
    # The counts are read too, so that the friend match and this share one shuffle of the edges.
    marks = edge_n.where(F.col("edge_n") >= 0).select(
        F.col("userid").alias("_edge_src"), F.col("friendid").alias("_edge_dst"),
        F.when(F.col("edge_n") >= 0, 1).alias("_edge"),
    )
    joined = df.join(
        marks,
        (df[src] == marks["_edge_src"]) & (df[dst] == marks["_edge_dst"]),
        "left",
    )
    return joined.withColumn(name, F.coalesce(F.col("_edge"), F.lit(0))).drop(
        "_edge_src", "_edge_dst", "_edge"
    )
