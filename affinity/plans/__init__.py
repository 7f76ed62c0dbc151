from affinity.plans.features import (  # noqa: F401
    DimFeatures,
    attendance_history,
    customer_features,
    dedup_fact,
    dim_features,
    event_attendance,
    event_calendar,
    event_profile,
    event_stat_features,
    fact_events,
    friend_attendance_features,
    friend_totals,
    geo_scale,
    group_size_features,
    host_affinity_features,
    restrict_to_fact_events,
    user_history_features,
)
from affinity.plans.scoring import fit_linear, load_model, model_input, save_model, score  # noqa: F401
from affinity.plans.wide import assemble_wide, build_wide  # noqa: F401
