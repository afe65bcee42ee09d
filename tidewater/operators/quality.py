"""Data-quality metrics and the load gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Gate thresholds: at least one row, fewer than this many NULL keys.
MAX_NULL_KEYS = 10
ROUTE_LOAD = "load_target"
ROUTE_NOTIFY = "notify"


def dq_metric_columns(key: str) -> list[Column]:
    """count(*) and the conditional NULL-key sum (NULL on an empty input, like SUM)."""
    return [
        F.count(F.lit(1)).alias("total_count"),
        F.sum(F.when(F.col(key).isNull(), 1).otherwise(0)).alias("null_count"),
    ]


def dq_metrics(df: DataFrame, key: str, table_name: str | None = None) -> DataFrame:
    """One row: total_count, null_count (optionally labelled with table_name)."""
    out = df.agg(*dq_metric_columns(key))
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), "total_count", "null_count")
    return out


def gate_passes(total: Column, nulls: Column, max_null_keys: int = MAX_NULL_KEYS) -> Column:
    """total > 0 and nulls < the limit; an empty input never passes (its NULL sum is never compared)."""
    return (total > 0) & (F.coalesce(nulls, F.lit(0)) < max_null_keys)


def route(metrics: DataFrame, max_null_keys: int = MAX_NULL_KEYS) -> DataFrame:
    """Add the gate decision to a metrics frame."""
    ok = gate_passes(F.col("total_count"), F.col("null_count"), max_null_keys)
    return metrics.withColumn("route", F.when(ok, F.lit(ROUTE_LOAD)).otherwise(F.lit(ROUTE_NOTIFY)))

