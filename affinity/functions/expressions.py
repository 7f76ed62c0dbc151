"""Column expressions used by the feature plan.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen and do not
block predicate pushdown. Casts use `try_cast`: under ANSI mode a plain cast of dirty text
raises, while the feature definitions want NULL.
"""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Union[Column, str]

# Gender text and its code; anything else (NULL included) is 2.
GENDER_CODES = (("male", 0), ("female", 1))
GENDER_OTHER = 2

# Fixed value: clock time of an ISO start time with exactly three millisecond digits and
# a Z suffix; no match gives the empty string.
CLOCK_PATTERN = r".*T([0-9]{2}:[0-9]{2}:[0-9]{2})\.[0-9]{3}Z"


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: ColumnLike) -> Column:
    return _col(c).try_cast("double")


def as_date(c: ColumnLike) -> Column:
    return _col(c).try_cast("date")


def min_max(value: ColumnLike, hi: ColumnLike, lo: ColumnLike) -> Column:
    """(value - lo) / (hi - lo) as double.

    NULL when any input is NULL; NaN when hi == lo (the 0/0 of IEEE doubles).
    """
    v, h, lo_ = as_double(value), as_double(hi), as_double(lo)
    return (
        F.when(v.isNull() | h.isNull() | lo_.isNull(), F.lit(None).cast("double"))
        .when(h == lo_, F.lit(float("nan")))
        .otherwise(F.try_divide(v - lo_, h - lo_))
    )


def gender_code(c: ColumnLike) -> Column:
    g = _col(c)
    expr = None
    for text, code in GENDER_CODES:
        expr = F.when(g == text, F.lit(code)) if expr is None else expr.when(g == text, F.lit(code))
    return expr.otherwise(F.lit(GENDER_OTHER))


def age_at(birthyear: ColumnLike, as_of: Column) -> Column:
    """Calendar year of `as_of` minus the birth year (int, NULL-propagating)."""
    return (F.year(as_of) - _col(birthyear).try_cast("int")).cast("int")


def days_between(end: ColumnLike, start: ColumnLike) -> Column:
    """Whole days from `start` to `end` (may be negative); both sides cast to date."""
    return F.datediff(as_date(end), as_date(start))


def event_month(start: ColumnLike) -> Column:
    return F.month(as_date(start))


def iso_day_of_week(start: ColumnLike) -> Column:
    """ISO day number as text, '1' = Monday … '7' = Sunday, in the session time zone."""
    ts = _col(start).try_cast("timestamp")
    return (F.weekday(ts) + 1).cast("string")


def clock_text(start: ColumnLike) -> Column:
    return F.regexp_extract(_col(start).cast("string"), CLOCK_PATTERN, 1)


def hour_number(clock: ColumnLike) -> Column:
    """Hour of an 'HH:mm:ss' text as double; NULL when the text is empty or malformed."""
    return F.regexp_extract(_col(clock), r"^([0-9]{2}):", 1).try_cast("double")


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """numerator / denominator as double, 0.0 when the denominator is 0."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(F.try_divide(n.cast("double"), d.cast("double")))


def _contains_place(addr_upper: Column, place: ColumnLike) -> Column:
    p = _col(place).cast("string")
    hit = p.isNotNull() & (p != "") & F.contains(addr_upper, F.upper(p))
    return F.coalesce(hit, F.lit(False))


def same_place(addr: ColumnLike, city: ColumnLike, state: ColumnLike, country: ColumnLike) -> Column:
    """1 if the address text contains the city, state or country name (case-insensitive).

    A NULL address gives 0; NULL or empty place names never match.
    """
    a = _col(addr).cast("string")
    up = F.upper(a)
    any_hit = _contains_place(up, city) | _contains_place(up, state) | _contains_place(up, country)
    return F.when(a.isNull(), F.lit(0)).when(any_hit, F.lit(1)).otherwise(F.lit(0))
