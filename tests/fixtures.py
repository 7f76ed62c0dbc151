"""Hand-built rows in the native schema (all-text fact, FIXTURES.md §1-2)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from affinity.schemas import Dims

FACT_DDL = "userid string, eventid string, invited string, times string"
CUSTOMERS_DDL = ("userid string, localename string, birthyear int, gender string, joinedat double, "
                 "location string, timezone int")
EVENTS_DDL = ("eventid string, userid string, starttime string, city string, state string, "
              "country string, lat string, lng string")
ATTENDEES_DDL = "eventid string, userid string, status string"
GROUPS_DDL = "eventid string, grouptype string"
FRIENDS_DDL = "userid string, friendid string"

FACT_ROWS = [
    # latest per key: the later invitation wins
    ("u1", "e1", "0", "2012-10-02 15:53:05.754000+00:00"),
    ("u1", "e1", "1", "2012-10-03 15:53:05.754000+00:00"),
    ("u1", "e2", "0", "2012-10-20 10:00:00.000000+00:00"),
    ("u2", "e1", "0", "2012-10-05 10:00:00.000000+00:00"),
    ("u3", "e2", "1", "2012-10-21 10:00:00.000000+00:00"),
    ("u4", "e3", "0", "2012-10-25 10:00:00.000000+00:00"),
    # NULL times alone in its key: kept
    ("u5", "e5", "0", None),
    # event without a group row: absent from wide
    ("u2", "e4", "0", "2012-10-06 10:00:00.000000+00:00"),
    # event not in events: invite_days 0 in the history block, absent from wide
    ("u3", "e9", "0", "2012-10-07 10:00:00.000000+00:00"),
]

CUSTOMER_ROWS = [
    ("u1", "en_US", 1980, "male", 0.0, "Paris, Ile-de-France, France", 1),
    ("u2", "fr_FR", 1990, "female", 10.0, None, 2),
    ("u3", "en_US", 1970, "other", 5.0, "Austin, Texas", 3),
    ("u4", "en_GB", 1985, None, None, "Lyon", 4),
    ("u5", "en_US", 2000, "male", 5.0, "Nowhere", 5),
]

EVENT_ROWS = [
    ("e1", "h1", "2012-10-31T23:30:00.001Z", "Paris", None, "France", "10", "20"),
    ("e2", "u1", "2012-11-01T10:00:00Z", "", "Texas", "USA", None, "30"),
    ("e3", "h2", "2012-11-02T08:15:30.123Z", "Lyon", "Rhone", "France", "30", "40"),
    ("e4", "h1", "2012-11-03T08:00:00.000Z", "Nice", None, "France", "20", "25"),
    ("e5", "h2", "2012-11-04T09:00:00.000Z", "Nice", None, None, "20", "25"),
]

ATTENDEE_ROWS = [
    ("e1", "u2", "yes"),
    ("e1", "u3", "no"),
    ("e1", "u1", "yes"),
    ("e2", "u1", "yes"),
    ("e2", "u1", None),
    (None, "u1", "yes"),
    ("e3", "u2", "maybe"),
    ("e3", "u3", "invited"),
]

GROUP_ROWS = [("e1", "g1"), ("e2", "g1"), ("e3", "g2"), ("e5", "g2")]

FRIEND_ROWS = [
    ("u1", "u2"),
    ("u1", "u3"),
    ("h1", "u1"),
    ("u4", "h2"),
]


def native(spark: SparkSession):
    fact = spark.createDataFrame(FACT_ROWS, FACT_DDL)
    dims = Dims(
        customers=spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS_DDL),
        event_attendees=spark.createDataFrame(ATTENDEE_ROWS, ATTENDEES_DDL),
        event_groups=spark.createDataFrame(GROUP_ROWS, GROUPS_DDL),
        events=spark.createDataFrame(EVENT_ROWS, EVENTS_DDL),
        user_friends=spark.createDataFrame(FRIEND_ROWS, FRIENDS_DDL),
    )
    return fact, dims
