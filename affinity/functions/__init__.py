from affinity.functions.expressions import (  # noqa: F401
    age_at,
    as_date,
    as_double,
    clock_text,
    days_between,
    event_month,
    gender_code,
    hour_number,
    iso_day_of_week,
    min_max,
    safe_ratio,
    same_place,
)
