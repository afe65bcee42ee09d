"""Helpers shared by the operators: tables, written intermediates, sizes, range buckets."""

from __future__ import annotations

import sys
import tempfile
import time
import types
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Files

FREE_SECONDS = 5
FREE_PAUSE = 0.5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where the session names none, a folder of our own is set, which only a local master may
    use (tests): on a cluster executors could not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewater-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of earlier steps.

    Spark removes a shuffle's files once its driver's garbage collector finds that nothing refers to it,
    which comes late on a driver that has little to do, while the executors' disks fill.  Asked for at most
    every ``FREE_SECONDS``, so that short jobs don't notice, and twice: at the first time, what the step just
    ended has left is still referred to."""
    kept = once(("freed",), lambda: [0.0])
    if time.monotonic() - kept[0] > FREE_SECONDS:
        spark.sparkContext._jvm.System.gc()
        time.sleep(FREE_PAUSE)
        spark.sparkContext._jvm.System.gc()
        kept[0] = time.monotonic()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and it is computed once."""
    free_shuffles(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/tidewater-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes a table that ``written`` made and that nothing reads any more."""
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    for folder in folders:
        if "/tidewater-llm/" not in folder:
            raise ValueError(f"not a table of ours: {folder}")
        Files(table.sparkSession, folder).remove("")


def lower_ascii(c: Column) -> Column:
    """``c`` with A-Z lower-cased and nothing else changed."""
    return F.translate(c, UPPER, UPPER.lower())


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only ``names`` of ``df``: whatever else it carries can't clash with an operator's own columns."""
    return df.select(*[df[n] for n in names])


def parts_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions for ``rows`` rows: by size, and at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def once(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, kept for ``key`` as long as this process lives.

    Functions reach the workers by value, and their globals with them, anew for each task; what a worker
    should keep over its tasks has its place in a module of the process instead.
    """
    kept = sys.modules.setdefault("_tidewater_llm_once", types.ModuleType("_tidewater_llm_once")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
