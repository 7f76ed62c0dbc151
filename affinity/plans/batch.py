"""Batch run — fact file -> wide table (-> score -> sinks)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Optional

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from affinity.operators.checks import check_unique
from affinity.plans.scoring import score
from affinity.plans.wide import build_wide
from affinity.schemas import Dims
from affinity.sinks import write_jdbc, write_table
from affinity.sources.fact import read_fact_csv


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    properties: Mapping[str, str]
    mode: str = "overwrite"


def validate_dims(dims: Dims) -> None:
    """V1 on the keys the wide table's grain depends on."""
    check_unique(dims.customers, ["userid"], "customers")
    check_unique(dims.events, ["eventid"], "events")
    check_unique(dims.event_groups, ["eventid"], "event_groups")


def run_batch(
    spark: SparkSession,
    dims: Dims,
    fact: Optional[DataFrame] = None,
    fact_csv: Optional[str] = None,
    as_of=None,
    mode: str = "intended",
    wide_out: Optional[str] = None,
    wide_format: str = "parquet",
    model: Optional[PipelineModel] = None,
    predictions_out: Optional[str] = None,
    jdbc: Optional[JdbcTarget] = None,
    validate: bool = False,
) -> DataFrame:
    """Build the wide table and write it and its scores where asked.

    The wide table is built in steps (`build_wide`, staged). With several sinks it is
    persisted once, so the plan runs once. Sinks for
    predictions without a model raise.
    Returns the wide table (or the predictions when a model is given).
    """
    if model is None and (predictions_out is not None or jdbc is not None):
        raise ValueError("predictions_out and jdbc need a model")
    if fact is None:
        if fact_csv is None:
            raise ValueError("give a fact DataFrame or a fact CSV path")
        fact = read_fact_csv(spark, fact_csv)
    if validate:
        validate_dims(dims)
    wide = build_wide(fact, dims, as_of=as_of, mode=mode, staged=True)
    sinks = sum(x is not None for x in (wide_out, predictions_out, jdbc))
    if sinks > 1 or (model is not None and wide_out is not None):
        wide = wide.persist(StorageLevel.MEMORY_AND_DISK)
    if wide_out is not None:
        write_table(wide, wide_out, fmt=wide_format)
    if model is None:
        return wide
    preds = score(model, wide, mode)
    if predictions_out is not None:
        write_table(preds, predictions_out)
    if jdbc is not None:
        write_jdbc(preds, jdbc.url, jdbc.table, jdbc.properties, mode=jdbc.mode)
    return preds
