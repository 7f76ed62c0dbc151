from affinity.sources import analog  # noqa: F401
from affinity.sources.dims import load_dims, load_dims_from_dir, read_dim  # noqa: F401
from affinity.sources.fact import (  # noqa: F401
    parse_payload,
    read_fact_csv,
    read_wide_csv,
    split_payload,
    to_payload,
)
