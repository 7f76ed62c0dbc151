"""

``entry(spark)`` runs the flagship query (the 37-column wide table) on sf0.001.
DataFrame; ``oracle_sql()`` gives the DuckDB statement for the same key over the base test
tables. Every query reads the whole test tables through the native-shape tables of
``affinity.sources.analog``, which Spark derives from them; of those that take a join, a query
has the ones it reads written once per session to the shared checkpoint folder
(``AFFINITY_ANALOG=views`` keeps them lazy).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity import oracle as O
from affinity.operators.checks import duplicate_keys
from affinity.operators.latest import latest_per_key
from affinity.operators.pivot import status_pivot
from affinity.operators.rank import popularity_rank
from affinity.plans import features as feat
from affinity.plans.batch import run_batch
from affinity.plans.scoring import fit_linear, load_model, model_input, save_model, score
from affinity.plans.wide import build_wide
from affinity.schemas import FRIEND_STATUS, USER_STATUS, WIDE_COLUMNS, Dims
from affinity.session import scratch_path, shuffles_dropped, write_scratch
from affinity.sinks import write_table
from affinity.sources import analog
from affinity.plans.refresh import (
    ATTENDANCE,
    EDGES,
    EVENT_COUNTS,
    FRIENDS,
    HISTORY,
    CountedDims,
    CountStore,
    DimChanges,
    bounds_of,
    merge_bounds,
)
from affinity.sources.dims import DEFAULT_TABLES, load_dims, load_dims_from_dir
from affinity.sources.fact import parse_payload, read_wide_csv, to_payload
from affinity.sinks.ledger import Files, FolderRows
from affinity.streaming import (
    BatchSinks,
    WindowSinks,
    payload_stream,
    read_latest,
    read_window_counts,
    run_latest,
    run_stream,
    run_window_counts,
)
from affinity.streaming.stream import MAX_BUCKETS, ROWS_PER_BUCKET

# The training-data operators and the corpus pipeline are optional: without their folders
# every other query still works.
try:
    import corpus_pipeline
    from affinity.llm import contract as llm
except ImportError:
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# The event types of the `events` test table, pivoted by the type pivot; the
# pivot's definition is these columns, so other types are not counted.
EVENT_TYPES = ("view", "click", "purchase", "signup", "error")
PLACE = {"lat_prec": "lat", "lng_prec": "lng"}  # scaled between their bounds
EVENT_TYPE_OUT = {f"{t}_count": t for t in EVENT_TYPES}


def _prepare(spark: SparkSession) -> None:
    # Calendar features are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _data(spark: SparkSession, sf_dir: str, *tables: str) -> analog.AnalogData:
    """The native-shape tables; of the joined ones only `tables` are written."""
    _prepare(spark)
    return analog.load(spark, sf_dir, tables)


def _fact(spark, sf_dir, *tables: str):
    d = _data(spark, sf_dir, "fact", *tables)
    return d, feat.dedup_fact(d.fact)


def _events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


# ---------------------------------------------------------------- queries


def q_latest_per_key(spark, sf_dir):
    return _fact(spark, sf_dir)[1]


def q_events_latest_by_type(spark, sf_dir):
    ev = _events_table(spark, sf_dir)
    return latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"])


def q_group_size(spark, sf_dir):
    d = _data(spark, sf_dir)
    return feat.group_size_features(d.dims.event_groups).join(d.dims.events.select("eventid"), "eventid")


def q_customer_features(spark, sf_dir):
    d = _data(spark, sf_dir)
    return feat.customer_features(d.dims.customers, as_of=O.AS_OF)


def q_invite_days(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "event_attendees", "user_friends")
    return feat.user_history_features(fact, d.dims).select("userid", "eventid", "invite_days")


def q_user_status_pivot(spark, sf_dir):
    return feat.attendance_history(_data(spark, sf_dir, "event_attendees").dims.event_attendees)


def q_event_status_pivot(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "event_attendees")
    return feat.event_attendance(feat.restrict_to_fact_events(d.dims.event_attendees, fact))


def q_friend_status_pivot(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "event_attendees", "user_friends")
    return feat.friends_on_event(fact, d.dims)


def q_events_type_pivot(spark, sf_dir):
    ev = _events_table(spark, sf_dir)
    return status_pivot(ev, ["user_id"], EVENT_TYPE_OUT, status_col="event_type", counted="event_id")


def q_friend_count(spark, sf_dir):
    return feat.friend_totals(_data(spark, sf_dir, "user_friends").dims.user_friends)


def q_friend_count_reference(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "user_friends")
    return feat.friend_ratio_denominator(fact, feat.friend_totals(d.dims.user_friends), "reference")


def q_user_history(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "event_attendees", "user_friends")
    return feat.user_history_features(fact, d.dims)


def q_friend_attendance(spark, sf_dir, mode="intended"):
    d, fact = _fact(spark, sf_dir, "event_attendees", "user_friends")
    return feat.friend_attendance_features(fact, d.dims, mode)


def q_fact_events_semi(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "event_attendees")
    return feat.restrict_to_fact_events(d.dims.event_attendees, feat.fact_events(fact))


def q_event_calendar(spark, sf_dir):
    d, fact = _fact(spark, sf_dir)
    events = feat.restrict_to_fact_events(d.dims.events, fact)
    return feat.event_calendar(events).join(events.select("eventid", "city", "country"), "eventid")


def q_popularity_rank(key, level, spark, sf_dir):
    return popularity_rank(_data(spark, sf_dir).dims.events, key, level)


def q_geo_scale(spark, sf_dir):
    d, fact = _fact(spark, sf_dir)
    return feat.geo_scale(d.dims.events, scope=feat.fact_events(fact))


def q_event_stats(spark, sf_dir, mode="intended"):
    d, fact = _fact(spark, sf_dir, "event_attendees")
    return feat.event_stat_features(fact, d.dims, mode)


def q_host_affinity(spark, sf_dir):
    d, fact = _fact(spark, sf_dir, "user_friends")
    return feat.host_affinity_features(fact, d.dims, "intended")


def q_host_is_friend(spark, sf_dir):
    return q_host_affinity(spark, sf_dir).select("userid", "eventid", "creator_is_friend")


def q_location_similar(spark, sf_dir):
    return q_host_affinity(spark, sf_dir).select("userid", "eventid", "location_similar")


def q_wide(spark, sf_dir, mode="intended"):
    d = _data(spark, sf_dir, *analog.JOINED)
    return build_wide(d.fact, d.dims, as_of=O.AS_OF, mode=mode, staged=True)


def q_model_input(spark, sf_dir, mode="intended"):
    return model_input(q_wide(spark, sf_dir, mode), mode)


def q_payload_parse(spark, sf_dir):
    d = _data(spark, sf_dir, "fact")
    good, _bad = parse_payload(to_payload(d.fact))
    return good


def q_payload_quarantine(spark, sf_dir):
    """Payloads that go to quarantine, with the reason, out of a feed where the order key
    decides whether a payload is short, long, has a bad or an empty key, or is good."""
    _prepare(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    user, event, tail = (F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_linenumber"))
    kind = F.col("l_orderkey") % 6
    value = (
        F.when(kind == 0, F.concat_ws(",", user, event))
        .when(kind == 1, F.concat_ws(",", user, event, tail, tail, tail))
        .when(kind == 2, F.concat_ws(",", F.concat(F.lit("u"), user), event, tail, tail))
        .when(kind == 3, F.concat_ws(",", user, F.concat(F.lit("e"), event), tail, tail))
        .when(kind == 4, F.concat_ws(",", F.lit(""), event, tail, tail))
        .otherwise(F.concat_ws(",", user, event, tail, tail))
    )
    keys = {"userid": T.LongType(), "eventid": T.LongType()}
    return parse_payload(items.select(value.alias("value")), types=keys)[1]


# Columns of the dimensions whose values are compared; those of locales are the nation table's.
DIM_TEXTS = {
    "customers": ("userid", "localename", "birthyear", "gender", "location", "timezone"),
    "event_attendees": ("eventid", "userid", "status"),
    "event_groups": ("eventid", "grouptype"),
    "events": ("eventid", "userid", "starttime", "city", "state", "country"),
    "user_friends": ("userid", "friendid"),
    "locales": ("n_nationkey", "n_name"),
}
DIM_NUMBERS = {"customers": ("joinedat",), "events": ("lat", "lng")}


def _table_contents(dims: Dims) -> DataFrame:
    """(name, n, rows_digest, total): of each dimension the rows, the sum of a digest of each
    row's texts and ids, and the sum of its numbers."""

    def of(name: str, df: DataFrame) -> DataFrame:
        cell = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *map(cell, DIM_TEXTS[name]))), 1, 8), 16, 10).cast("long")
        numbers = [F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)) for c in DIM_NUMBERS.get(name, ())]
        total = F.round(reduce(lambda a, b: a + b, numbers, F.lit(0.0)), 2)
        sums = df.agg(F.count("*").alias("n"), F.sum(digest).alias("rows_digest"), total.alias("total"))
        return sums.select(F.lit(name).alias("name"), "n", "rows_digest", "total")

    return reduce(DataFrame.unionByName, (of(k, df) for k, df in dims.frames().items()))


def _contents_sql(name: str, table: str) -> str:
    cells = " || '|' || ".join(f"coalesce('=' || CAST({c} AS VARCHAR), 'null')" for c in DIM_TEXTS[name])
    total = " + ".join(["0.0", *(f"coalesce(sum(CAST({c} AS DOUBLE)), 0)" for c in DIM_NUMBERS.get(name, ()))])
    digest = f"CAST(sum(CAST('0x' || substr(md5({cells}), 1, 8) AS BIGINT)) AS BIGINT)"
    return f"SELECT '{name}' AS name, count(*) AS n, {digest} AS rows_digest, CAST(round({total}, 2) AS DOUBLE) AS total FROM {table}"


def q_dims_from_dir(spark, sf_dir):
    """The dimensions written as a folder of tables and loaded from it."""
    base = scratch_path(spark, "dims")
    for name, df in _data(spark, sf_dir, *analog.JOINED).dims.frames().items():
        df.write.parquet(f"{base}/{name}")
    return _table_contents(load_dims_from_dir(spark, base))


def q_dims_from_catalog(spark, sf_dir):
    """The dimensions loaded by catalog name (temporary views)."""
    for name, df in _data(spark, sf_dir, *analog.JOINED).dims.frames().items():
        df.createOrReplaceTempView(f"dim_{name}")
    return _table_contents(load_dims(spark, tables={k: f"dim_{k}" for k in DEFAULT_TABLES}))


def _shares(rows: DataFrame, a: str, b: str) -> list[DataFrame]:
    """The rows dealt into three shares by two of their columns."""
    share = F.coalesce(F.pmod(F.col(a) + F.col(b), F.lit(3)), F.lit(0))
    return [rows.where(share == i) for i in range(3)]


def q_refreshed_counts(spark, sf_dir, table, counted, other):
    """A counted block built from a third of its table and two batches of changes. The first
    third also has rows twice, which the last batch takes out again."""
    rows = _data(spark, sf_dir, table).dims.frames()[table]
    first, second, third = _shares(rows, counted.keys[0], other)
    again = first.where(F.pmod(other, F.lit(7)) == 0)
    buckets = max(8, min(MAX_BUCKETS, rows.count() // ROWS_PER_BUCKET))
    store = CountStore(spark, scratch_path(spark, "refreshed"), counted, buckets)
    store.apply(first.unionByName(again), 0)
    store.apply(second, 1)
    tagged = third.withColumn("change", F.lit(1)).unionByName(again.withColumn("change", F.lit(-1)))
    store.apply(tagged, 2)
    store.vacuum()
    return store.read()


def q_refreshed_bounds(spark, sf_dir):
    """Bounds of the events' places from three shares; a removed row within them changes nothing."""
    events = _data(spark, sf_dir).dims.events
    first, *later = (bounds_of(x, PLACE) for x in _shares(events, "eventid", "userid"))
    for added in later:
        first = merge_bounds(first, added).drop("stale")
    return first


def q_duplicate_keys(spark, sf_dir):
    _prepare(spark)
    return duplicate_keys(spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet"), ["o_custkey"])


def q_batch_run(spark, sf_dir):
    """The batch runner from a fact CSV to the written wide table. A CSV's ids are text."""
    d = _data(spark, sf_dir, *analog.JOINED)
    fact_csv, out = scratch_path(spark, "fact-csv"), scratch_path(spark, "batch-wide")
    write_table(d.fact, fact_csv, fmt="csv", compression="gzip")
    run_batch(spark, d.dims, fact_csv=fact_csv, as_of=O.AS_OF, wide_out=out)
    ids = {c: F.col(c).cast("long") for c in ("user_id", "event_id")}
    return spark.read.parquet(out).withColumns(ids)


def _in_thirds(spark, dims):
    """The dimensions' counts from a third of both relation tables, and the changes that
    bring the other two: what `run_stream` takes as `counted` and `changes`."""
    attendees = _shares(dims.event_attendees, "eventid", "userid")
    friends = _shares(dims.user_friends, "userid", "friendid")
    rows = max(dims.event_attendees.count(), dims.user_friends.count())
    buckets = max(8, min(MAX_BUCKETS, rows // ROWS_PER_BUCKET))
    first = replace(dims, event_attendees=attendees[0], user_friends=friends[0])

    def changes(version):
        number = version + 1
        return DimChanges(number, attendees[number], friends[number]) if number < len(friends) else None

    return {"counted": CountedDims(spark, scratch_path(spark, "counted"), first, buckets), "changes": changes}


# A large micro-batch reaches most of the dimension rows and so joins whole blocks. Files that
# grow with the data, at a fixed number of them, keep that to a fixed number of passes. A file is
# compressed and so read by one task.
FEED_BATCHES, FILES_PER_BATCH = 4, 8


def q_stream_wide(spark, sf_dir, from_changes=False):
    """The fact feed replayed as text payloads through the streaming runner (file source,
    a fixed number of files per micro-batch, availableNow trigger); the union of the per-batch wide
    tables. The files' size follows the data's, and each (userid, eventid) key lives in one file,
    so per-micro-batch de-duplication sees every copy of a key. `from_changes`: attendance
    and friendships come as counts that two batches of changes have completed."""
    d = _data(spark, sf_dir, *analog.JOINED)
    feed = scratch_path(spark, "stream-feed")
    payload = to_payload(d.fact.repartition(FEED_BATCHES * FILES_PER_BATCH, "userid", "eventid"))
    with shuffles_dropped(spark):
        payload.write.mode("overwrite").text(feed, compression="gzip")
    out = scratch_path(spark, "stream-wide")
    query = run_stream(
        spark,
        payload_stream(spark, feed, max_files_per_trigger=FILES_PER_BATCH),
        d.dims,
        BatchSinks(wide_out=out, quarantine_out=scratch_path(spark, "stream-quarantine")),
        as_of=O.AS_OF,
        trigger={"availableNow": True},
        **(_in_thirds(spark, d.dims) if from_changes else {}),
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    # The per-batch folders (batch_id=N) also expose batch_id; keep the wide columns.
    return spark.read.parquet(out).select(*WIDE_COLUMNS)


# The replayed feeds arrive in slices of this many years of invitations, one run each.
SLICE_YEARS, SLICES = 2, 4
STRAGGLER = 7  # one in so many invitations arrives a slice late, in the feed that has late ones


def _sliced(fact: DataFrame, late: bool) -> DataFrame:
    """The raw feed with `slice`, the run in which a row arrives."""
    when = F.floor((F.year("times") - 1992) / SLICE_YEARS)
    if late:
        when = when + F.when((F.col("userid") + F.col("eventid")) % STRAGGLER == 0, 1).otherwise(0)
    return fact.withColumn("slice", F.least(F.greatest(when, F.lit(0)), F.lit(SLICES - 1)).cast("int"))


def _replayed(spark: SparkSession, fact: DataFrame, start: Callable, late: bool) -> None:
    """Append the feed's slices one after another and drain each with a new start of the
    stream, which goes on from its checkpoint."""
    feed = scratch_path(spark, "slices")
    for i in range(SLICES):
        to_payload(_sliced(fact, late).where(F.col("slice") == i)).write.mode("append").text(feed)
        query = start(payload_stream(spark, feed))
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"stream failed: {query.exception()}")


def q_stream_latest(spark, sf_dir):
    """The newest invitation per key of a feed whose keys come back in later micro-batches."""
    d = _data(spark, sf_dir, "fact")
    out, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "latest-checkpoint")
    _replayed(
        spark, d.fact,
        lambda source: run_latest(spark, source, out, checkpoint, delay="30 days", trigger={"availableNow": True}),
        late=False,
    )
    types = {c: F.col(c).cast(d.fact.schema[c].dataType) for c in d.fact.columns}
    return read_latest(spark, out).withColumns(types)


WINDOW_DAYS, DELAY_DAYS = 30, 90


def q_stream_windows(spark, sf_dir):
    """Invitations per 30 days of event time, counted and late, of a feed with stragglers."""
    d = _data(spark, sf_dir, "fact")
    sinks = WindowSinks(scratch_path(spark, "windows"), scratch_path(spark, "windows-late"))
    checkpoint = scratch_path(spark, "windows-checkpoint")
    _replayed(
        spark, d.fact,
        lambda source: run_window_counts(
            spark, source, sinks, checkpoint, width=f"{WINDOW_DAYS} days", delay=f"{DELAY_DAYS} days",
            trigger={"availableNow": True},
        ),
        late=True,
    )
    late = spark.read.parquet(sinks.quarantine_out).where("reason = 'late'")
    times = F.get(F.split("value", ","), 3).try_cast("timestamp").alias("times")
    late = late.select(times).groupBy(F.window("times", f"{WINDOW_DAYS} days")).agg(F.count("*").alias("late"))
    counts = read_window_counts(spark, sinks.counts_out)
    return counts.join(late.select("window.start", "late"), "start", "full").select(
        F.unix_date(F.col("start").cast("date")).cast("long").alias("first_day"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("late", F.lit(0)).alias("late"),
    )


class _StopsOnce(FolderRows):
    """Append-only rows whose first append stops after its rows are written."""

    def append(self, rows: DataFrame) -> None:
        super().append(rows)
        if len(Files(rows.sparkSession).names(self.path)) <= 2:  # one batch and _SUCCESS
            raise RuntimeError("stopped after the rows, before they are marked")


def q_stream_replayed_rows(spark, sf_dir):
    """Scored rows appended to one table by a stream that is stopped after the first append,
    before it is marked as done, and started again: every row is there once."""
    d = _data(spark, sf_dir, *analog.JOINED)
    feed, out = scratch_path(spark, "replay-feed"), scratch_path(spark, "replay-rows")
    wide_out = scratch_path(spark, "replay-wide")
    to_payload(d.fact).write.text(feed, compression="gzip")
    model = _fixture_model(spark)
    for rows in (_StopsOnce(out), FolderRows(out)):
        sinks = BatchSinks(wide_out=wide_out, rows=rows, quarantine_out=scratch_path(spark, "replay-quarantine"))
        query = run_stream(
            spark, payload_stream(spark, feed), d.dims, sinks, as_of=O.AS_OF, model=model, trigger={"availableNow": True}
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not isinstance(rows, _StopsOnce):
                raise
    return spark.read.parquet(out).select("user_id", "event_id", "prediction")


def q_csv_scored(spark, sf_dir):
    """The wide table read back from CSV, then scored."""
    return score(_fixture_model(spark), q_csv_round_trip(spark, sf_dir))


def q_csv_round_trip(spark, sf_dir):
    """The wide table written by the CSV sink and read back with its schema."""
    wide = q_wide(spark, sf_dir)
    path = scratch_path(spark, "wide-csv")
    write_table(wide, path, fmt="csv", compression="gzip")
    return read_wide_csv(spark, path, wide.schema)


# Test fixture only (no training exists in the scored application): a closed-form score over
# model-input columns, which SQL can compute too.
FIXTURE_SCORE = "0.01 * friend_count + 0.5 * event_hour + user_invited + 0.25 * event_month"


def _fixture_model(spark):
    """The fixture saved as a pipeline and loaded back the way a deployment loads its own."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    path = scratch_path(spark, "fixture-model")
    stage = SQLTransformer(statement=f"SELECT *, {FIXTURE_SCORE} AS prediction FROM __THIS__")
    PipelineModel(stages=[stage]).write().save(path)
    return load_model(path)


def q_score(spark, sf_dir, mode="intended"):
    return score(_fixture_model(spark), q_wide(spark, sf_dir, mode), mode)


# The fitted model: attendance of a user from the friend count and the lead time.
LABEL, FEATURES = "attended_count", ("friend_count", "invite_days")
DIGITS = 6  # predictions of a fitted model are compared to this many decimals


def q_score_fitted(spark, sf_dir):
    """A linear model fitted on the wide table, saved, loaded back and applied to it."""
    # Read twice, by the fit and by the score.
    wide = write_scratch(q_wide(spark, sf_dir), "fitted-wide")
    path = scratch_path(spark, "fitted-model")
    save_model(fit_linear(wide, LABEL, FEATURES), path)
    scored = score(load_model(path), wide)
    return scored.withColumn("prediction", F.round("prediction", DIGITS))


def entry(spark: SparkSession) -> DataFrame:
    return q_wide(spark, SMOKE_DIR)


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {} if llm is None else {**llm.queries(), "pipeline": corpus_pipeline.run}


def _llm_oracles() -> dict[str, str]:
    if llm is None:
        return {}
    pipeline = corpus_pipeline.ORACLE_SQL
    return {**llm.oracle_sql(), **({"pipeline": pipeline} if pipeline else {})}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "latest_per_key": q_latest_per_key,
        "events_latest_by_type": q_events_latest_by_type,
        "group_size": q_group_size,
        "customer_features": q_customer_features,
        "invite_days": q_invite_days,
        "user_status_pivot": q_user_status_pivot,
        "event_status_pivot": q_event_status_pivot,
        "friend_status_pivot": q_friend_status_pivot,
        "events_type_pivot": q_events_type_pivot,
        "friend_count": q_friend_count,
        "friend_count_reference": q_friend_count_reference,
        "user_history": q_user_history,
        "friend_attendance": q_friend_attendance,
        "fact_events_semi": q_fact_events_semi,
        "event_calendar": q_event_calendar,
        "popularity_rank_city": partial(q_popularity_rank, "city", "city_level"),
        "popularity_rank_country": partial(q_popularity_rank, "country", "country_level"),
        "geo_scale": q_geo_scale,
        "event_stats": q_event_stats,
        "host_is_friend": q_host_is_friend,
        "location_similar": q_location_similar,
        "host_affinity": q_host_affinity,
        "wide": q_wide,
        "wide_reference": partial(q_wide, mode="reference"),
        "model_input": q_model_input,
        "payload_parse": q_payload_parse,
        "stream_wide": q_stream_wide,
        "stream_counted": partial(q_stream_wide, from_changes=True),
        "csv_round_trip": q_csv_round_trip,
        "score": q_score,
        "score_reference": partial(q_score, mode="reference"),
        "model_input_reference": partial(q_model_input, mode="reference"),
        "friend_attendance_reference": partial(q_friend_attendance, mode="reference"),
        "event_stats_reference": partial(q_event_stats, mode="reference"),
        "payload_quarantine": q_payload_quarantine,
        "dims_from_dir": q_dims_from_dir,
        "dims_from_catalog": q_dims_from_catalog,
        "refreshed_user_status": partial(q_refreshed_counts, table="event_attendees", counted=HISTORY, other="eventid"),
        "refreshed_event_status": partial(
            q_refreshed_counts, table="event_attendees", counted=EVENT_COUNTS, other="userid"
        ),
        "refreshed_attendance": partial(q_refreshed_counts, table="event_attendees", counted=ATTENDANCE, other="userid"),
        "refreshed_friend_count": partial(q_refreshed_counts, table="user_friends", counted=FRIENDS, other="friendid"),
        "refreshed_edges": partial(q_refreshed_counts, table="user_friends", counted=EDGES, other="friendid"),
        "refreshed_bounds": q_refreshed_bounds,
        "duplicate_keys": q_duplicate_keys,
        "batch_run": q_batch_run,
        "stream_latest": q_stream_latest,
        "stream_windows": q_stream_windows,
        "stream_replayed_rows": q_stream_replayed_rows,
        "csv_scored": q_csv_scored,
        "score_fitted": q_score_fitted,
        **_llm_queries(),
    }


# ---------------------------------------------------------------- oracle SQL


def _fact_sql(select: str, *ctes: str) -> str:
    return O.with_analog(*ctes) + select


def oracle_sql() -> dict[str, str]:
    w = O.with_analog
    hist_cols = ", ".join(f"COALESCE(h.{c}, 0) AS {c}" for c in USER_STATUS)
    friend_cols = ", ".join(f"COALESCE(ufp.{c}, 0) AS {c}" for c in FRIEND_STATUS)
    ratio_cols = O.ratio_cols("COALESCE(fc.friend_count, 0)")
    fanned = "(COALESCE(fc.friend_count, 0) * frows.n_rows)"
    score_sql = f"SELECT user_id, event_id, {FIXTURE_SCORE} AS prediction FROM ({{}}) m"
    tables = {
        "customers": "a_customers", "event_attendees": "a_attendees", "event_groups": "a_groups",
        "events": "a_events", "user_friends": "a_friends", "locales": "nation",
    }
    # Least squares with two features, solved from the covariances.
    fitted_sql = f"""SELECT user_id, event_id, round(my + b1 * (x1 - m1) + b2 * (x2 - m2), {DIGITS}) AS prediction FROM (
  SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM (
    SELECT avg({LABEL}) AS my, avg({FEATURES[0]}) AS m1, avg({FEATURES[1]}) AS m2, var_pop({FEATURES[0]}) AS s11,
      var_pop({FEATURES[1]}) AS s22, covar_pop({FEATURES[0]}, {FEATURES[1]}) AS s12,
      covar_pop({FEATURES[0]}, {LABEL}) AS s1y, covar_pop({FEATURES[1]}, {LABEL}) AS s2y FROM m) c) b,
  (SELECT user_id, event_id, {FEATURES[0]} AS x1, {FEATURES[1]} AS x2 FROM m) r"""
    fitted_sql = f"WITH m AS ({O.model_input_sql()})\n{fitted_sql}"
    dims_sql = w() + " UNION ALL ".join(_contents_sql(k, v) for k, v in tables.items())
    event_cols = (
        "est.event_invited_count, est.event_attended_count, est.event_not_att_count, est.event_maybe_count"
    )
    host_affinity = (
        w(*O.event_profile_cte("intended"))
        + f"""SELECT f.userid, f.eventid,
  CASE WHEN EXISTS (SELECT 1 FROM a_friends x WHERE x.userid = ev.host AND x.friendid = f.userid)
       THEN 1 ELSE 0 END AS creator_is_friend,
  {O.same_place_sql('c.location', 'ev.city', 'ev.state', 'ev.country')} AS location_similar
FROM a_fact f JOIN a_customers c ON f.userid = c.userid LEFT JOIN ev ON f.eventid = ev.eventid"""
    )
    return {
        "latest_per_key": w() + "SELECT userid, eventid, invited, times FROM a_fact",
        "events_latest_by_type": """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) x WHERE rn = 1""",
        "group_size": w(O.GROUP_CTE) + "SELECT grp.eventid, grp.event_type, grp.event_count "
        "FROM grp JOIN a_events e ON grp.eventid = e.eventid",
        "customer_features": w(O.CUSTOMER_FEATURES_CTE) + "SELECT * FROM cust",
        "invite_days": w() + f"""SELECT f.userid, f.eventid, {O.invite_days_sql('e.starttime', 'f.times')} AS invite_days
FROM a_fact f LEFT JOIN a_events e ON f.eventid = e.eventid""",
        "user_status_pivot": w() + O.pivot_two_level("a_attendees", "userid", "eventid", O.USER_OUT),
        "event_status_pivot": w()
        + O.pivot_two_level(
            "a_attendees", "eventid", "userid", O.EVENT_OUT,
            where="WHERE eventid IN (SELECT eventid FROM a_fact)",
        ),
        "friend_status_pivot": w(O.FRIEND_PIVOT_CTE) + "SELECT * FROM ufp",
        "events_type_pivot": O.pivot_two_level(
            "events", "user_id", "event_id", EVENT_TYPE_OUT, status="event_type"
        ),
        "friend_count": w() + "SELECT userid, count(friendid) AS friend_count FROM a_friends GROUP BY userid",
        "friend_count_reference": w() + """SELECT f.userid, count(uf.friendid) AS fri_count
FROM a_fact f LEFT JOIN a_friends uf ON f.userid = uf.userid GROUP BY f.userid""",
        "user_history": w(O.HISTORY_CTE, O.FRIEND_COUNT_CTE)
        + f"""SELECT f.userid, f.eventid, {O.invite_days_sql('e.starttime', 'f.times')} AS invite_days,
  {hist_cols}, COALESCE(fc.friend_count, 0) AS friend_count
FROM a_fact f LEFT JOIN a_events e ON f.eventid = e.eventid
  LEFT JOIN hist h ON f.userid = h.userid LEFT JOIN fc ON f.userid = fc.userid""",
        "friend_attendance": w(O.FRIEND_PIVOT_CTE, O.FRIEND_COUNT_CTE)
        + f"""SELECT f.userid, f.eventid, {friend_cols},
  COALESCE(fc.friend_count, 0) AS fri_count,
  {ratio_cols}
FROM a_fact f LEFT JOIN ufp ON f.userid = ufp.userid AND f.eventid = ufp.eventid
  LEFT JOIN fc ON f.userid = fc.userid""",
        "fact_events_semi": w() + """SELECT ea.eventid, ea.userid, ea.status
FROM a_attendees ea LEFT JOIN (SELECT DISTINCT eventid FROM a_fact) t1 ON ea.eventid = t1.eventid
WHERE t1.eventid IS NOT NULL""",
        "event_calendar": w() + f"""SELECT eventid, {O.calendar_sql('starttime')}, city, country
FROM a_events WHERE eventid IN (SELECT eventid FROM a_fact)""",
        "popularity_rank_city": w(O.rank_cte("r", "city", "city_level", "intended")) + "SELECT * FROM r",
        "popularity_rank_country": w(O.rank_cte("r", "country", "country_level", "intended")) + "SELECT * FROM r",
        "geo_scale": w(*O.event_profile_cte("intended"))
        + "SELECT eventid, lat_prec, lng_prec FROM ev WHERE eventid IN (SELECT eventid FROM a_fact)",
        "event_stats": w(*O.event_profile_cte("intended"), O.EVENT_STATUS_CTE)
        + f"""SELECT f.eventid, f.userid, {event_cols},
  ev.event_month, ev.event_dayofweek, ev.event_hour, ev.city_level, ev.country_level, ev.lat_prec, ev.lng_prec
FROM a_fact f LEFT JOIN est ON f.eventid = est.eventid LEFT JOIN ev ON f.eventid = ev.eventid""",
        "host_is_friend": f"SELECT userid, eventid, creator_is_friend FROM ({host_affinity}) h",
        "location_similar": f"SELECT userid, eventid, location_similar FROM ({host_affinity}) h",
        "host_affinity": host_affinity,
        "wide": O.wide_sql("intended"),
        "wide_reference": O.wide_sql("reference"),
        "model_input": O.model_input_sql(),
        "stream_wide": O.wide_sql("intended"),
        "stream_counted": O.wide_sql("intended"),
        "csv_round_trip": O.wide_sql("intended"),
        "payload_parse": w() + """SELECT CAST(userid AS VARCHAR) AS userid, CAST(eventid AS VARCHAR) AS eventid,
  invited, CAST(times AS VARCHAR) AS times FROM a_fact0""",
        "score": score_sql.format(O.model_input_sql()),
        "score_reference": score_sql.format(O.model_input_sql("reference")),
        "model_input_reference": O.model_input_sql("reference"),
        "friend_attendance_reference": w(O.FRIEND_PIVOT_CTE, O.FRIEND_COUNT_CTE, O.FACT_ROWS_CTE)
        + f"""SELECT f.userid, f.eventid, {friend_cols},
  {fanned} AS fri_count,
  {O.ratio_cols(fanned)}
FROM a_fact f JOIN frows ON f.userid = frows.userid
  LEFT JOIN ufp ON f.userid = ufp.userid AND f.eventid = ufp.eventid
  LEFT JOIN fc ON f.userid = fc.userid""",
        "event_stats_reference": w(*O.event_profile_cte("reference"), O.EVENT_STATUS_CTE)
        + f"""SELECT f.eventid, f.userid, {event_cols},
  ev.event_month, ev.event_dayofweek, ev.event_hour, ev.city_level, ev.country_level, ev.lat_prec, ev.lng_prec
FROM a_fact f LEFT JOIN est ON f.eventid = est.eventid LEFT JOIN ev ON f.eventid = ev.eventid""",
        "payload_quarantine": """SELECT CASE l_orderkey % 6
    WHEN 0 THEN l_orderkey || ',' || l_partkey
    WHEN 2 THEN 'u' || l_orderkey || ',' || l_partkey || ',' || l_linenumber || ',' || l_linenumber
    ELSE l_orderkey || ',e' || l_partkey || ',' || l_linenumber || ',' || l_linenumber END AS value,
  CASE l_orderkey % 6 WHEN 0 THEN 2 ELSE 4 END AS n_fields,
  CASE l_orderkey % 6 WHEN 0 THEN 'fields' WHEN 2 THEN 'userid' ELSE 'eventid' END AS reason
FROM lineitem WHERE l_orderkey % 6 IN (0, 2, 3)""",
        "dims_from_dir": dims_sql,
        "dims_from_catalog": dims_sql,
        "refreshed_user_status": w() + O.pivot_two_level("a_attendees", "userid", "eventid", O.USER_OUT),
        "refreshed_event_status": w() + O.pivot_two_level("a_attendees", "eventid", "userid", O.EVENT_OUT),
        "refreshed_attendance": w() + "SELECT eventid, userid, " + ", ".join(
            f"count(*) FILTER (status = '{status}') AS {name}" for name, status in FRIEND_STATUS.items()
        ) + " FROM a_attendees GROUP BY eventid, userid",
        "refreshed_friend_count": w() + "SELECT userid, count(friendid) AS friend_count FROM a_friends GROUP BY userid",
        "refreshed_edges": w() + "SELECT userid, friendid, count(*) AS edge_n FROM a_friends GROUP BY userid, friendid",
        "refreshed_bounds": w() + " UNION ALL ".join(
            f"SELECT '{name}' AS name, min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi FROM a_events"
            for name, c in PLACE.items()
        ),
        "duplicate_keys": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1",
        "batch_run": O.wide_sql("intended"),
        "stream_latest": w() + "SELECT userid, eventid, invited, times FROM a_fact",
        "stream_windows": w(f"""s AS (
  SELECT times, greatest(0, least({SLICES - 1}, (year(times) - 1992) // {SLICE_YEARS}
    + CASE WHEN (userid + eventid) % {STRAGGLER} = 0 THEN 1 ELSE 0 END)) AS slice,
    CAST(floor(date_diff('day', DATE '1970-01-01', CAST(times AS DATE)) / {WINDOW_DAYS}) AS BIGINT) * {WINDOW_DAYS} AS first_day
  FROM a_fact0)""", f"""passed AS (
  SELECT a.slice, max(b.times) - INTERVAL {DELAY_DAYS} DAY AS watermark
  FROM (SELECT DISTINCT slice FROM s) a JOIN s b ON b.slice < a.slice GROUP BY a.slice)""")
        + f"""SELECT first_day, count(*) FILTER (NOT is_late) AS n, count(*) FILTER (is_late) AS late FROM (
  SELECT first_day, coalesce(CAST(DATE '1970-01-01' AS TIMESTAMP) + (first_day + {WINDOW_DAYS}) * INTERVAL 1 DAY <= watermark, false) AS is_late
  FROM s LEFT JOIN passed USING (slice)) x GROUP BY first_day""",
        "stream_replayed_rows": score_sql.format(O.model_input_sql()),
        "csv_scored": score_sql.format(O.model_input_sql()),
        "score_fitted": fitted_sql,
        **_llm_oracles(),
    }
