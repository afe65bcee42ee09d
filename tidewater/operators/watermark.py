"""Load-type resolution and high-water marks (incremental extraction bookkeeping)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class LoadConfigError(ValueError):
    pass


class MissingWatermarkError(ValueError):
    pass


@dataclass(frozen=True)
class LoadPlan:
    load_type: str  # "full" | "delta"

    @property
    def is_full(self) -> bool:
        return self.load_type == "full"

    def predicate(self, hwm, column: str = "updated_at", overlap: dt.timedelta | None = None) -> Column | None:
        """None for a full load, ``column > hwm`` (strict) for a delta load; with ``overlap``,
        ``column >= hwm - overlap``."""
        if self.is_full:
            return None
        if hwm is None or hwm == "":
            raise MissingWatermarkError(f"no stored mark of {column}: a delta load needs an earlier load")
        mark = F.lit(_ts_text(hwm)).cast("timestamp_ntz")
        if overlap is None:
            return F.col(column) > mark
        return F.col(column) >= mark - F.lit(overlap)


def _ts_text(v) -> str:
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def resolve_load(load_type: str | None, run_type: str = "manual") -> LoadPlan:
    """Validate the run configuration.  A scheduled run may not be a full load."""
    if run_type == "scheduled" and load_type == "full":
        raise LoadConfigError("a scheduled run may only be a delta load; start a full load by hand")
    if load_type not in ("full", "delta"):
        raise LoadConfigError(f"load type must be 'full' or 'delta', not {load_type!r}")
    return LoadPlan(load_type)


def high_water_mark(df: DataFrame, table_name: str, column: str = "updated_at") -> DataFrame:
    """One row (table_name, max_updated); max_updated is NULL for an empty input."""
    return df.agg(F.max(F.col(column)).alias("max_updated")).select(
        F.lit(table_name).alias("table_name"), F.col("max_updated").cast("timestamp_ntz").alias("max_updated")
    )


#: Stands for a missing time: a column chunk of nothing but NULL has no greatest value in its footer.
NO_MARK = -(1 << 63)


def mark_micros(column: str) -> Column:
    """A timestamp as microseconds since 1970 (``NO_MARK`` for NULL), a number that Parquet keeps the
    greatest of in its footers."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column))
    return F.coalesce(micros, F.lit(NO_MARK))


def greatest_in_footers(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row (``greatest``): the largest value of a Parquet table's column, from the files' footers alone
    where Spark can push the aggregate there (whole numbers and dates), else by a scan of the column.

    A session of its own reads through the source that pushes aggregates; the caller's settings stay."""
    session = spark.newSession()
    v1 = [s for s in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.max(column).alias("greatest"))


def footer_mark(spark: SparkSession, path: str, column: str) -> dt.datetime | None:
    """The high-water mark of a table that holds it as ``mark_micros`` in ``column``; no row is read."""
    micros = greatest_in_footers(spark, path, column).first()["greatest"]
    return None if micros in (None, NO_MARK) else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)


def upsert_watermarks(control: DataFrame, new_marks: DataFrame) -> DataFrame:
    """Merge new marks into the control table; a NULL new mark keeps the stored one.

    Both sides hold at most one row per table name.
    """
    old = control.select("table_name", F.col("max_updated").alias("_old"))
    new = new_marks.select("table_name", F.col("max_updated").alias("_new"))
    return old.join(new, "table_name", "full").select(
        "table_name", F.coalesce(F.col("_new"), F.col("_old")).alias("max_updated")
    )


def watermark_value(control: DataFrame, table_name: str):
    """The stored mark of one table as a Python value (a single scalar crosses to the driver)."""
    row = control.where(F.col("table_name") == table_name).agg(F.max("max_updated").alias("m")).first()
    return None if row is None else row["m"]
