"""File-arrival ingest as a Structured Streaming query.

Each newly arrived CSV file under ``incoming_dir`` is read once (the file source tracks
processed paths in the checkpoint) and judged by itself: how files are lumped into
micro-batches changes nothing.  A file that passes the data-quality gate, and of which every
row can be parsed, is appended to the target; the rows of any other are kept in
``<target>_refused`` (with the text of rows that couldn't be parsed) for a later load.

A micro-batch is written to ``<target>_staging`` first, once; the gate and both outcomes read
that table.  Every batch overwrites its own ``batch_id=<n>`` partitions, so a batch replayed
after a failure replaces its earlier partial output instead of doubling it.  Decisions are
written the same way to ``<target>_gate``, a row for each file.

The checkpoint stands beside the target unless the caller names another durable place: a new
session goes on where the last one ended.

Contract: arrivals must use new file names; a file replaced in place under the same name
is not seen again (the file source tracks paths; ``plans.ingest`` loads such files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import MAX_NULL_KEYS, ROUTE_LOAD, ROUTE_NOTIFY, dq_metric_columns, gate_passes
from ..schemas import SAMPLE
from ..sources.csv_io import CSV_READ

#: The text of a row that couldn't be parsed, and the file a row came from.
BROKEN = "_corrupt_record"
SOURCE = "_source_file"


def gate_by_file(rows: DataFrame, key: str, max_null_keys: int = MAX_NULL_KEYS) -> DataFrame:
    """A decision for each source file of ``rows``: its counts, broken rows and route."""
    broken = F.sum(F.when(F.col(BROKEN).isNotNull(), 1).otherwise(0)).alias("broken_count")
    m = rows.groupBy(SOURCE).agg(*dq_metric_columns(key), broken)
    ok = gate_passes(F.col("total_count"), F.col("null_count"), max_null_keys) & (F.col("broken_count") == 0)
    return m.withColumn("route", F.when(ok, F.lit(ROUTE_LOAD)).otherwise(F.lit(ROUTE_NOTIFY)))


def start_file_ingest(
    spark: SparkSession,
    incoming_dir: str,
    target_path: str,
    checkpoint: str | None = None,
    schema=SAMPLE,
    key: str = "id",
    header: bool = True,
    available_now: bool = True,
    max_null_keys: int = MAX_NULL_KEYS,
):
    """Start the ingest query; returns the StreamingQuery (call ``awaitTermination``)."""
    target_path = target_path.rstrip("/")
    columns = schema.fieldNames()

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        part = f"batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{target_path}_staging/{part}")
        staged = session.read.parquet(f"{target_path}_staging/{part}")
        gate_path = f"{target_path}_gate/{part}"
        gate_by_file(staged, key, max_null_keys).write.mode("overwrite").parquet(gate_path)
        gate = session.read.parquet(gate_path)
        judged = staged.join(gate.select(SOURCE, "route"), SOURCE)
        loaded = judged.where(F.col("route") == ROUTE_LOAD).select(*columns)
        loaded.write.mode("overwrite").parquet(f"{target_path}/{part}")
        refused = judged.where(F.col("route") != ROUTE_LOAD).select(*columns, BROKEN, SOURCE)
        refused.write.mode("overwrite").parquet(f"{target_path}_refused/{part}")

    with_broken = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    stream = (
        spark.readStream.schema(with_broken)
        .options(**CSV_READ)
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .csv(incoming_dir)
        .select("*", F.col("_metadata.file_path").alias(SOURCE))
    )
    writer = stream.writeStream.foreachBatch(per_batch)
    writer = writer.option("checkpointLocation", checkpoint or f"{target_path}_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_file_ingest(spark: SparkSession, incoming_dir: str, target_path: str, **kw) -> None:
    """Process every file that has arrived since the last run, then return."""
    q = start_file_ingest(spark, incoming_dir, target_path, **kw)
    q.awaitTermination()
