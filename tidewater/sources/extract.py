"""Full and incremental extraction from a source table.

A source is any DataFrame factory: a Parquet path, a JDBC table (partitioned read), or a
catalog table.  The incremental predicate is a plain ``Column`` so Catalyst pushes it into
the scan (``PushedFilters`` on Parquet and JDBC).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.watermark import LoadPlan

# Column lists of the source queries (column-pruned extract).
SOURCE_COLUMNS = {
    "customer": ["id", "name", "created_at", "updated_at"],
    "customer_address": ["id", "cust_id", "address", "created_at", "updated_at"],
    "customer_payment": ["id", "cust_id", "payment_method", "created_at", "updated_at"],
    "deleted_entries": ["id", "table_name", "table_id", "created_at", "updated_at"],
}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: dict | None = None,
) -> DataFrame:
    """Parallel JDBC read: with a numeric ``partition_column`` the table is split into ranges.

    Ranges need their bounds and their number, which follows the table's size; without a
    partition column the table is read in one task.  Timestamps come without a zone, as the
    marks they are compared with.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("preferTimestampNTZ", "true")
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def balanced_ranges(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """Predicates that cut a table into at most ``parts`` ranges of about as many rows each.

    Ranges of equal width (``read_jdbc``'s bounds) are as uneven as the key is skewed.  These are drawn
    at quantiles of ``keys``, which may be the table or a sample of it (one aggregation of a sketch).  A key
    that fills a range or more has one to itself.  NULL keys go with the first; the predicates take
    every row once, whatever they were drawn from.  Use them as ``predicates`` of ``spark.read.jdbc``
    (``read_jdbc_ranges``)."""
    if parts < 1:
        raise ValueError("a table has one part at least")
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else F.array(F.lit(0.5))
    found = keys.agg(F.percentile_approx(F.col(column).cast("long"), shares, accuracy).alias("at")).first()["at"]
    if parts == 1 or not found:
        return ["1 = 1"]
    # A value that two quantiles share fills a range: it is cut out, from itself to the next number.
    twice = {a for a, b in zip(found, found[1:], strict=False) if a == b}
    cuts = sorted({*found, *(v + 1 for v in twice)})
    ranges = [f"{column} < {cuts[0]} OR {column} IS NULL"]
    ranges += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [*ranges, f"{column} >= {cuts[-1]}"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, ranges: Sequence[str], properties: dict | None = None) -> DataFrame:
    """Parallel JDBC read with a task for each of ``ranges``."""
    return spark.read.jdbc(url, table, predicates=list(ranges), properties={"preferTimestampNTZ": "true", **(properties or {})})


def select_source(df: DataFrame, columns: Sequence[str] | None, predicate: Column | None = None) -> DataFrame:
    """Project the source columns and apply the optional predicate."""
    out = df.select(*columns) if columns else df
    return out if predicate is None else out.where(predicate)


def extract(
    source: DataFrame,
    plan: LoadPlan,
    hwm=None,
    columns: Sequence[str] | None = None,
    column: str = "updated_at",
    overlap: dt.timedelta | None = None,
) -> DataFrame:
    """Full extract (every column, no predicate) or delta extract (``column > hwm``, pruned columns).

    A delta without a stored high-water mark raises ``MissingWatermarkError``.  ``overlap`` reads
    that much further back, rows at the border included, for rows that were committed late; some
    are then read twice, which the corrected merge takes (it compares with what is stored), the
    literal one doesn't.
    """
    if plan.is_full:
        return source
    return select_source(source, columns, plan.predicate(hwm, column, overlap))


def source_version(spark: SparkSession, path: str) -> str:
    """A name for what stands at ``path`` now: of its files' paths, times and lengths."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(at)
    files = [x for f in found for x in (fs.listStatus(f.getPath()) if f.isDirectory() else [f])]
    told = sorted(f"{f.getPath()} {f.getModificationTime()} {f.getLen()}" for f in files if not f.getPath().getName().startswith(("_", ".")))
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:32]


def source_exists(spark: SparkSession, path: str) -> bool:
    """Metadata check of a file source.  Missing path -> False; any other failure raises."""
    try:
        spark.read.format("text").load(path).schema  # fixed schema: resolves the file index only
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise
