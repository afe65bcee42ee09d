"""CSV ingest with data-quality metrics, ungated and gated (batch form).

A load's metrics are observed while its rows are written, and kept in a ledger beside the target, a row
for each load; they add up, so the target's metrics are the ledger's sum and no load reads the target.
The metrics are two numbers; they are the only values that reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import MAX_NULL_KEYS, ROUTE_LOAD, ROUTE_NOTIFY, dq_metric_columns, dq_metrics, route
from ..schemas import SAMPLE
from ..sources.csv_io import read_headered_csv
from ..sources.extract import source_exists, source_version
from ..sources.files import Files


@dataclass(frozen=True)
class GateResult:
    total_count: int
    null_count: int | None
    route: str


def measure(df: DataFrame, key: str, max_null_keys: int = MAX_NULL_KEYS) -> GateResult:
    row = route(dq_metrics(df, key), max_null_keys).first()
    return GateResult(row["total_count"], row["null_count"], row["route"])


def _ledger(target_path: str) -> str:
    return f"{target_path.rstrip('/')}_ledger"


def _append(df: DataFrame, target_path: str, load_id: str, key: str) -> None:
    """Append as the load's own partition, and its metrics to the ledger: the same load again replaces
    what it wrote before.  The rows are observed in the stage that writes them, where a task that is
    run again counts once."""
    seen = Observation(f"load {load_id}")
    df.observe(seen, *dq_metric_columns(key)).write.mode("overwrite").parquet(f"{target_path}/load_id={load_id}")
    _note(df.sparkSession, target_path, load_id, seen.get["total_count"], seen.get["null_count"])


def _note(spark: SparkSession, target_path: str, load_id: str, total: int, nulls: int | None) -> None:
    row = spark.createDataFrame([(total, nulls)], "total_count long, null_count long")
    row.write.mode("overwrite").parquet(f"{_ledger(target_path)}/load_id={load_id}")


def ledger(spark: SparkSession, target_path: str, key: str = "id") -> DataFrame:
    """(load_id, total_count, null_count) of each load of the target.

    A load that ended between its rows and its entry is measured now, by its own rows."""
    prefix = "load_id="
    names = lambda path: {n.removeprefix(prefix) for n in Files(spark, path).names("") if n.startswith(prefix)}
    loads, noted = names(target_path), names(_ledger(target_path))
    for load_id in sorted(loads - noted):
        row = dq_metrics(spark.read.parquet(f"{target_path}/{prefix}{load_id}"), key).first()
        _note(spark, target_path, load_id, row["total_count"], row["null_count"])
    schema = "total_count long, null_count long, load_id string"
    if not loads:
        return spark.createDataFrame([], schema).select("load_id", "total_count", "null_count")
    return spark.read.schema(schema).parquet(_ledger(target_path)).select("load_id", "total_count", "null_count")


def target_metrics(spark: SparkSession, target_path: str, key: str = "id", max_null_keys: int = MAX_NULL_KEYS) -> GateResult:
    """The metrics of the whole target, as the sum of its ledger."""
    total = ledger(spark, target_path, key).agg(F.coalesce(F.sum("total_count"), F.lit(0)).alias("total_count"), F.sum("null_count").alias("null_count"))
    row = route(total, max_null_keys).first()
    return GateResult(row["total_count"], row["null_count"], row["route"])


def gated_append(stage: DataFrame, target: DataFrame, key: str = "id", check: str = "stage") -> tuple[DataFrame, GateResult]:
    """Append ``stage`` to ``target`` when the gate passes; otherwise the target is unchanged.

    ``check='stage'`` measures what is about to be loaded.  ``check='target'`` reproduces the
    source system, which measured the target *before* the load (so the first load into an
    empty target is always refused).
    """
    gate = measure(stage if check == "stage" else target, key)
    result = target.unionByName(stage) if gate.route == ROUTE_LOAD else target
    return result, gate


def csv_ingest(
    spark: SparkSession, src_path: str, target_path: str, key: str = "id", schema=SAMPLE, load_id: str | None = None
) -> GateResult | None:
    """Exists-check -> append the headered CSV to the target -> metrics of the target.

    A missing source file is reported (None) and the run goes on.  The metrics cover the
    whole target after the append, as the source system reports them; they come from the ledger.  A load is named by its
    files' paths, times and lengths unless ``load_id`` names it: running it again, also after a
    half-finished run, leaves the target as one run does, and a file replaced in place is a
    load of its own.
    """
    if not source_exists(spark, src_path):
        return None
    _append(read_headered_csv(spark, src_path, schema), target_path, load_id or source_version(spark, src_path), key)
    return target_metrics(spark, target_path, key)


def gated_ingest(
    spark: SparkSession,
    src_path: str,
    stage_path: str,
    target_path: str,
    key: str = "id",
    schema=SAMPLE,
    check: str = "stage",
    load_id: str | None = None,
    max_null_keys: int = MAX_NULL_KEYS,
) -> GateResult | None:
    """Exists-check -> stage the CSV (truncate + load) -> gate -> append stage to target, or notify.

    Refused rows stay in the stage.  Loads are named as in ``csv_ingest``.
    """
    if not source_exists(spark, src_path):
        return None
    load_id = load_id or source_version(spark, src_path)
    read_headered_csv(spark, src_path, schema).write.mode("overwrite").parquet(stage_path)
    stage = spark.read.parquet(stage_path)
    if check == "stage":
        gate = measure(stage, key, max_null_keys)
    elif source_exists(spark, target_path):
        gate = target_metrics(spark, target_path, key, max_null_keys)
    else:
        gate = GateResult(0, None, ROUTE_NOTIFY)
    if gate.route == ROUTE_LOAD:
        _append(stage, target_path, load_id, key)
    return gate
