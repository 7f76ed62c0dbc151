from affinity.operators.checks import check_unique, duplicate_keys  # noqa: F401
from affinity.operators.edges import (  # noqa: F401
    attendance_multiplicity,
    edge_multiplicity,
    friend_status_counts,
    has_edge,
)
from affinity.operators.latest import latest_per_key  # noqa: F401
from affinity.operators.pivot import status_pivot  # noqa: F401
from affinity.operators.rank import order_index, popularity_rank  # noqa: F401
from affinity.operators.scale import global_bounds, min_max_scale  # noqa: F401
