"""User–event interest features and scoring on PySpark.

Layout:
  sources/    fact / dimension / payload readers and the analog views over the test tables
  functions/  column expressions (scaling, place match, calendar parts, guarded ratios)
  operators/  reusable DataFrame operators (latest per key, status pivot, min-max scale,
              popularity rank, one-hop edge match, key checks)
  plans/      feature blocks, the 37-column wide table, batch runner, scoring
  sinks/      CSV / parquet / JDBC writers
  streaming/  Structured Streaming runner (file or Kafka source, foreachBatch)
"""

from affinity.schemas import Dims, FACT_COLUMNS, WIDE_COLUMNS  # noqa: F401
