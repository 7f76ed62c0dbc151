"""Schemas, column contracts and the typed dimension bundle."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import Optional

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The fact feed is four text fields in this order.
FACT_COLUMNS = ("userid", "eventid", "invited", "times")

FACT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FACT_COLUMNS])

# Attendance statuses and the feature names they feed.
# (status value, user history column, friends-on-event column, whole-event column)
STATUS_COLUMNS = (
    ("invited", "invited_event_count", "uf_invited_count", "event_invited_count"),
    ("yes", "attended_count", "uf_attended_count", "event_attended_count"),
    ("no", "not_attended_count", "uf_not_attended_count", "event_not_att_count"),
    ("maybe", "maybe_attended_count", "uf_maybe_attended_count", "event_maybe_count"),
)

USER_STATUS = {user: status for status, user, _, _ in STATUS_COLUMNS}
FRIEND_STATUS = {friend: status for status, _, friend, _ in STATUS_COLUMNS}
EVENT_STATUS = {event: status for status, _, _, event in STATUS_COLUMNS}

# The 37 output columns of the wide table, in order. These names are the
# scoring model's input contract and must not change.
WIDE_COLUMNS = (
    "user_id", "event_id", "locale", "gender", "age", "timezone", "member_days",
    "invite_days", "event_count", "friend_count", "invited_event_count", "attended_count",
    "not_attended_count", "maybe_attended_count", "user_invited", "uf_invited_count",
    "uf_attended_count", "uf_not_attended_count", "uf_maybe_count", "uf_invited_prec",
    "uf_attended_prec", "uf_not_attended_prec", "uf_maybe_prec", "event_month",
    "event_dayofweek", "event_hour", "event_invited_count", "event_attended_count",
    "event_not_att_count", "event_maybe_count", "city_level", "country_level", "lat_prec",
    "lng_prec", "creator_is_friend", "location_similar", "event_type",
)

PREDICTION_COLUMNS = ("user_id", "event_id", "prediction")

MODES = ("intended", "reference")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


@dataclass(frozen=True)
class Dims:
    """The dimension tables the feature plan reads.

    customers(userid, localename, birthyear, gender, joinedat, location, timezone)
    event_attendees(eventid, userid, status)
    event_groups(eventid, grouptype)
    events(eventid, userid [= host], starttime, city, state, country, lat, lng)
    user_friends(userid, friendid)   -- directed edges
    locales                          -- loaded for completeness, not read by the plan
    """

    customers: DataFrame
    event_attendees: DataFrame
    event_groups: DataFrame
    events: DataFrame
    user_friends: DataFrame
    locales: Optional[DataFrame] = None

    def frames(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) is not None}

    def map(self, fn) -> "Dims":
        return replace(self, **{name: fn(df) for name, df in self.frames().items()})

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Dims":
        return self.map(lambda df: df.persist(level))

    def unpersist(self) -> None:
        for df in self.frames().values():
            df.unpersist()
