from affinity.streaming.event_time import (  # noqa: F401
    WindowSinks,
    compact_latest,
    read_latest,
    read_window_counts,
    run_latest,
    run_window_counts,
)
from affinity.streaming.stream import (  # noqa: F401
    DEFAULT_TRIGGER,
    BatchHandler,
    BatchMetrics,
    BatchSinks,
    payload_stream,
    prepare_dim_features,
    run_stream,
)
