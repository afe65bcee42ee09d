"""CSV landing and staging.

The landing format is comma CSV with ``"`` quoting and ``""`` escaping (what a database
``COPY … CSV`` writes).  Reads always use an explicit schema — no inference pass over the
data — and are split across tasks by file ranges.  Values with line breaks need ``multiLine``,
which makes each file one split; landing files are read so, as there is one for each task that
wrote them.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.watermark import mark_micros
from .files import Files

# One set of options for the writer, the batch readers and the stream reader.  NULL is an
# unquoted empty field and '' a quoted one (""), as a database COPY … CSV writes them.  With
# the default nullValue "" a reader would take both for NULL; a sentinel that never occurs as
# a field value keeps them apart.  Outer blanks belong to the value.
NULL_SENTINEL = "\u0001"
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ = CSV_OPTIONS | {"nullValue": NULL_SENTINEL, "emptyValue": ""}
# Microseconds are written out in full: a mark computed from what was staged must equal the
# source's, or the next delta loads the same rows again.
CSV_WRITE = CSV_OPTIONS | {
    "nullValue": "",
    "emptyValue": '""',
    "lineSep": "\n",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def _reader(spark: SparkSession, schema: T.StructType, header: bool, multiline: bool):
    reader = spark.read.schema(schema).options(**CSV_READ).option("header", str(header).lower())
    return reader.option("multiLine", str(multiline).lower()).option("mode", "FAILFAST")


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Header-less positional CSV (columns in schema order), as a bulk stage load reads it."""
    # The record end is given, not guessed: a guess of CR LF would change such breaks inside values.
    return _reader(spark, schema, header=False, multiline=multiline).option("lineSep", "\n").csv(path)


class HeaderError(ValueError):
    """A file's header doesn't name the columns that are to be loaded."""


def bound_headers(spark: SparkSession, path: str | list[str], schema: T.StructType) -> dict[tuple[str, ...], list[str]]:
    """The files at ``path`` (or a list of files) by the order in which their headers name the schema's columns.

    Only each file's first line is read.  A header that lacks a column, names one twice, or has one that
    the schema doesn't know, is refused with its file's name."""
    files = Files(spark, path if isinstance(path, str) else path[0])
    orders: dict[tuple[str, ...], list[str]] = {}
    wanted = schema.fieldNames()
    for file in files.matching(path) if isinstance(path, str) else path:
        line = files.first_line(file).removeprefix("\ufeff")
        names = next(csv.reader([line], delimiter=CSV_OPTIONS["sep"], quotechar=CSV_OPTIONS["quote"]), [])
        if not names:  # a file without rows, as a writer leaves it
            continue
        if sorted(names) != sorted(wanted):
            missing, unknown = sorted(set(wanted) - set(names)), sorted(set(names) - set(wanted))
            twice = sorted({n for n in names if names.count(n) > 1})
            raise HeaderError(f"{file}: missing columns {missing}, unknown {unknown}, named twice {twice}")
        orders.setdefault(tuple(names), []).append(file)
    return orders


def read_headered_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False, by_name: bool = True, version: str | None = None
) -> DataFrame:
    """CSV with one header line in each file, whose columns are taken by name, in any order, file by file.

    ``by_name=False`` takes them by the schema's order and skips the header unread, as a bulk load that is
    told to ignore it does.  ``version`` names a column to add: a digest of the path, time and length of
    the file that a row was read from."""
    told = F.concat_ws(" ", "_metadata.file_path", F.unix_micros("_metadata.file_modification_time"), "_metadata.file_size")
    columns = [*schema.fieldNames(), *([F.substring(F.sha2(told, 256), 1, 32).alias(version)] if version else [])]
    if not by_name:
        return _reader(spark, schema, header=True, multiline=multiline).csv(path).select(*columns)
    out = None
    for names, files in bound_headers(spark, path, schema).items():
        rows = _reader(spark, T.StructType([schema[n] for n in names]), header=True, multiline=multiline).csv(files).select(*columns)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        none = spark.createDataFrame([], schema)
        return none.withColumn(version, F.lit("")) if version else none
    return out


def write_landing(df: DataFrame, path: str, fmt: str = "parquet", header: bool = False) -> None:
    """Replace the landing object set of one table (parallel write, one file per task)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).option("header", str(header).lower()).csv(path)
    else:
        w.format(fmt).save(path)


#: The stage's own column: its rows' mark as a number.
STAGE_MARK = "_mark"


def write_stage(df: DataFrame, path: str, mark: str = "updated_at") -> None:
    """Truncate-and-load a stage table (overwrite of its Parquet directory), with the mark as a number
    beside its columns, so that the stage's high-water mark is read from its footers."""
    df.withColumn(STAGE_MARK, mark_micros(mark)).write.mode("overwrite").parquet(path)
