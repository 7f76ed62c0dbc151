"""DuckDB oracle SQL for the contract queries.

Each statement reads only the base test tables (registered as views by the checker) and
rebuilds the native-shape tables as CTEs (FIXTURES.md §3). Where a feature has a
row-level "as written" form (two-level pivots, left join + NULL filter, fact ⋈ attendees
⋈ friends), the oracle uses that form, so it checks the rewritten Spark plan against
independent SQL.
"""

from __future__ import annotations

# Fixed value: the evaluation date used by every oracle (age = 2002 - birthyear).
AS_OF = "2002-01-01"
AS_OF_YEAR = 2002

ANALOG_CTES = """
a_fact0 AS (
  SELECT o_custkey AS userid, l_partkey AS eventid,
         CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS invited, l_shipdate AS times
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
a_attendees AS (
  SELECT l_partkey AS eventid, o_custkey AS userid,
         CASE WHEN l_returnflag = 'A' THEN 'yes' WHEN l_returnflag = 'N' THEN 'no'
              WHEN l_linestatus = 'O' THEN 'maybe' ELSE 'invited' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
a_friends AS (
  SELECT a.c_custkey AS userid, b.c_custkey AS friendid
  FROM customer a JOIN customer b
    ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment
   AND a.c_custkey <> b.c_custkey AND abs(a.c_custkey - b.c_custkey) <= 2000),
a_customers AS (
  SELECT c_custkey AS userid, c_nationkey AS localename,
         CAST(1950 + c_custkey % 50 AS INT) AS birthyear,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'male' WHEN 'MACHINERY' THEN 'female'
              WHEN 'AUTOMOBILE' THEN NULL ELSE 'unknown' END AS gender,
         c_acctbal AS joinedat,
         CASE WHEN c_custkey % 10 = 0 THEN NULL
              ELSE 'City of ' || lower(n_name) || ' ' || c_mktsegment END AS location,
         c_nationkey % 24 AS timezone
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
a_events AS (
  SELECT p_partkey AS eventid,
         (p_partkey * 7) % (SELECT count(*) FROM customer) AS userid,
         '1999-' || lpad(CAST(1 + p_partkey % 12 AS STRING), 2, '0') || '-'
                 || lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0') || 'T'
                 || lpad(CAST(p_partkey % 24 AS STRING), 2, '0') || ':30:00.001Z' AS starttime,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS city,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS state,
         'NATION_' || CAST(p_partkey % 25 AS STRING) AS country,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_retailprice END AS lat,
         CAST(p_size AS DOUBLE) AS lng
  FROM part),
a_groups AS (
  SELECT p_partkey AS eventid, p_type AS grouptype FROM part WHERE p_partkey % 23 <> 0),
a_fact AS (
  SELECT userid, eventid, invited, times FROM (
    SELECT userid, eventid, invited, times,
           row_number() OVER (PARTITION BY userid, eventid ORDER BY times DESC, invited DESC) AS rn
    FROM a_fact0) x
  WHERE rn = 1)"""


def with_analog(*ctes: str) -> str:
    """`WITH <analog views>, <extra ctes>` prefix."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {ANALOG_CTES}{extra}\n"


def minmax_sql(v: str, hi: str, lo: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL OR {hi} IS NULL OR {lo} IS NULL THEN NULL "
        f"WHEN {hi} = {lo} THEN CAST('NaN' AS DOUBLE) "
        f"ELSE ({v} - {lo}) / ({hi} - {lo}) END"
    )


def pivot_two_level(
    table: str, keys: str, counted: str, outputs: dict[str, str], where: str = "", status: str = "status"
) -> str:
    """The as-written pivot: count per (keys, status), then max(case) per keys."""
    cols = ",\n  ".join(
        f"max(CASE WHEN {status} = '{v}' THEN cnt ELSE 0 END) AS {name}" for name, v in outputs.items()
    )
    return (
        f"SELECT {keys},\n  {cols}\n"
        f"FROM (SELECT {keys}, {status}, count({counted}) AS cnt FROM {table} {where} "
        f"GROUP BY {keys}, {status}) p\nGROUP BY {keys}"
    )


def same_place_sql(addr: str, city: str, state: str, country: str) -> str:
    def hit(p: str) -> str:
        return f"({p} IS NOT NULL AND {p} <> '' AND contains(upper({addr}), upper({p})))"

    return (
        f"CASE WHEN {addr} IS NULL THEN 0 "
        f"WHEN {hit(city)} OR {hit(state)} OR {hit(country)} THEN 1 ELSE 0 END"
    )


CLOCK_SQL = r"regexp_extract({c}, '.*T([0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})\.[0-9]{{3}}Z', 1)"


def calendar_sql(c: str) -> str:
    # Every analog start time is a UTC instant ('...Z'), so its date is the text prefix.
    d = f"CAST(substr({c}, 1, 10) AS DATE)"
    return (
        f"CAST(month({d}) AS INTEGER) AS event_month, "
        f"CAST(isodow({d}) AS VARCHAR) AS event_dayofweek, "
        f"{CLOCK_SQL.format(c=c)} AS event_hour"
    )


def invite_days_sql(start: str, times: str) -> str:
    return (
        f"CAST(COALESCE(date_diff('day', CAST({times} AS DATE), CAST(substr({start}, 1, 10) AS DATE)), 0) "
        f"AS INTEGER)"
    )


USER_OUT = {
    "invited_event_count": "invited",
    "attended_count": "yes",
    "not_attended_count": "no",
    "maybe_attended_count": "maybe",
}
FRIEND_OUT = {
    "uf_invited_count": "invited",
    "uf_attended_count": "yes",
    "uf_not_attended_count": "no",
    "uf_maybe_attended_count": "maybe",
}
EVENT_OUT = {
    "event_invited_count": "invited",
    "event_attended_count": "yes",
    "event_not_att_count": "no",
    "event_maybe_count": "maybe",
}
RATIO_OUT = (
    ("uf_invited_count", "uf_invited_prec"),
    ("uf_attended_count", "uf_attended_prec"),
    ("uf_not_attended_count", "uf_not_attended_prec"),
    ("uf_maybe_attended_count", "uf_maybe_prec"),
)

CUSTOMER_FEATURES_CTE = f"""cust AS (
  SELECT userid, localename AS locale,
         CASE WHEN gender = 'male' THEN 0 WHEN gender = 'female' THEN 1 ELSE 2 END AS gender,
         CAST({AS_OF_YEAR} - birthyear AS INTEGER) AS age, timezone,
         {minmax_sql('joinedat', 'b.mx', 'b.mn')} AS member_days, location
  FROM a_customers, (SELECT max(joinedat) AS mx, min(joinedat) AS mn FROM a_customers) b)"""

HISTORY_CTE = "hist AS (" + pivot_two_level("a_attendees", "userid", "eventid", USER_OUT) + ")"
FRIEND_COUNT_CTE = "fc AS (SELECT userid, count(friendid) AS friend_count FROM a_friends GROUP BY userid)"
GROUP_CTE = """grp AS (
  SELECT g.eventid, g.grouptype AS event_type, s.event_count
  FROM a_groups g JOIN (SELECT grouptype, count(eventid) AS event_count FROM a_groups GROUP BY grouptype) s
    USING (grouptype))"""


def rank_cte(name: str, key: str, level: str, mode: str) -> str:
    if mode == "reference":
        return f"{name} AS (SELECT {key}, 1 AS {level} FROM a_events WHERE {key} IS NOT NULL GROUP BY {key})"
    return (
        f"{name} AS (SELECT {key}, event_cnt, CAST(row_number() OVER (ORDER BY event_cnt DESC, {key} ASC) AS INTEGER) "
        f"AS {level} FROM (SELECT {key}, count(eventid) AS event_cnt FROM a_events WHERE {key} IS NOT NULL "
        f"GROUP BY {key}) c)"
    )


def event_profile_cte(mode: str) -> list[str]:
    return [
        rank_cte("city_rank", "city", "city_level", mode),
        rank_cte("country_rank", "country", "country_level", mode),
        "geo AS (SELECT max(lat) AS mxa, min(lat) AS mna, max(lng) AS mxo, min(lng) AS mno FROM a_events)",
        f"""ev AS (
  SELECT e.eventid, e.userid AS host, e.starttime, e.city, e.state, e.country,
         {calendar_sql('e.starttime')},
         cr.city_level, kr.country_level,
         {minmax_sql('e.lat', 'geo.mxa', 'geo.mna')} AS lat_prec,
         {minmax_sql('e.lng', 'geo.mxo', 'geo.mno')} AS lng_prec
  FROM a_events e LEFT JOIN city_rank cr ON e.city = cr.city
       LEFT JOIN country_rank kr ON e.country = kr.country, geo)""",
    ]


EVENT_STATUS_CTE = "est AS (" + pivot_two_level("a_attendees", "eventid", "userid", EVENT_OUT) + ")"

# As written: fact ⋈ attendees on the event, then the friend edge on (user, attendee).
FRIEND_PIVOT_CTE = (
    "ufp AS (SELECT eventid, userid,\n  "
    + ",\n  ".join(f"max(CASE WHEN status = '{v}' THEN cnt ELSE 0 END) AS {n}" for n, v in FRIEND_OUT.items())
    + """
  FROM (SELECT f.eventid, f.userid, ea.status, count(uf.friendid) AS cnt
        FROM a_fact f JOIN a_attendees ea ON f.eventid = ea.eventid
        JOIN a_friends uf ON f.userid = uf.userid AND ea.userid = uf.friendid
        GROUP BY f.eventid, f.userid, ea.status) p
  GROUP BY eventid, userid)"""
)

FACT_ROWS_CTE = "frows AS (SELECT userid, count(*) AS n_rows FROM a_fact GROUP BY userid)"


def ratio_cols(denominator: str) -> str:
    return ",\n  ".join(
        f"CASE WHEN {denominator} = 0 THEN 0.0 ELSE COALESCE(ufp.{c}, 0) / {denominator} END AS {r}"
        for c, r in RATIO_OUT
    )


def wide_sql(mode: str = "intended") -> str:
    ctes = [CUSTOMER_FEATURES_CTE, HISTORY_CTE, FRIEND_COUNT_CTE, GROUP_CTE, *event_profile_cte(mode),
            EVENT_STATUS_CTE, FRIEND_PIVOT_CTE, FACT_ROWS_CTE]
    if mode == "reference":
        denominator = "(COALESCE(fc.friend_count, 0) * frows.n_rows)"
        creator = "1"
        location = "0"
    else:
        denominator = "COALESCE(fc.friend_count, 0)"
        creator = ("CASE WHEN EXISTS (SELECT 1 FROM a_friends x WHERE x.userid = ev.host AND x.friendid = f.userid) "
                   "THEN 1 ELSE 0 END")
        location = same_place_sql("c.location", "ev.city", "ev.state", "ev.country")
    return with_analog(*ctes) + f"""SELECT
  f.userid AS user_id, f.eventid AS event_id, c.locale, c.gender, c.age, c.timezone, c.member_days,
  {invite_days_sql('ev.starttime', 'f.times')} AS invite_days,
  grp.event_count, COALESCE(fc.friend_count, 0) AS friend_count,
  COALESCE(h.invited_event_count, 0) AS invited_event_count,
  COALESCE(h.attended_count, 0) AS attended_count,
  COALESCE(h.not_attended_count, 0) AS not_attended_count,
  COALESCE(h.maybe_attended_count, 0) AS maybe_attended_count,
  f.invited AS user_invited,
  COALESCE(ufp.uf_invited_count, 0) AS uf_invited_count,
  COALESCE(ufp.uf_attended_count, 0) AS uf_attended_count,
  COALESCE(ufp.uf_not_attended_count, 0) AS uf_not_attended_count,
  COALESCE(ufp.uf_maybe_attended_count, 0) AS uf_maybe_count,
  {ratio_cols(denominator)},
  ev.event_month, ev.event_dayofweek, ev.event_hour,
  est.event_invited_count, est.event_attended_count, est.event_not_att_count, est.event_maybe_count,
  ev.city_level, ev.country_level, ev.lat_prec, ev.lng_prec,
  {creator} AS creator_is_friend,
  {location} AS location_similar,
  grp.event_type
FROM a_fact f
  JOIN cust c ON f.userid = c.userid
  JOIN grp ON f.eventid = grp.eventid
  JOIN ev ON f.eventid = ev.eventid
  JOIN frows ON f.userid = frows.userid
  LEFT JOIN hist h ON f.userid = h.userid
  LEFT JOIN fc ON f.userid = fc.userid
  LEFT JOIN est ON f.eventid = est.eventid
  LEFT JOIN ufp ON f.userid = ufp.userid AND f.eventid = ufp.eventid"""


def model_input_sql(mode: str = "intended") -> str:
    from affinity.schemas import WIDE_COLUMNS

    cols = []
    for c in WIDE_COLUMNS:
        if mode == "intended" and c in ("user_id", "event_id"):
            cols.append(c)
        elif c == "event_hour":
            hour = "COALESCE(TRY_CAST(regexp_extract(event_hour, '^([0-9]{2}):', 1) AS DOUBLE), 0)"
            cols.append(f"{hour if mode == 'intended' else 'CAST(0 AS DOUBLE)'} AS {c}")
        else:
            cols.append(
                f"CASE WHEN isnan(COALESCE(TRY_CAST({c} AS DOUBLE), 0)) THEN 0 "
                f"ELSE COALESCE(TRY_CAST({c} AS DOUBLE), 0) END AS {c}"
            )
    return f"SELECT {', '.join(cols)} FROM (\n{wide_sql(mode)}\n) w"
