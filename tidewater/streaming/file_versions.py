"""Versions of files as a stream: a file that is replaced in place is seen again.

Spark's file source remembers paths, so a file that is written anew under its name goes unseen.
``FileVersions`` is a source of our own, by Spark's Python data source API.  Its offset is what the
watched folder holds: each file's path, time and length.  Between two offsets it yields a row for each
file that is new or changed.  The rows name files only; the files themselves are read by Spark, in
parallel, in ``run_replaced_files``.

A version's rows are written to a partition of its own, named by path, time and length: a batch that is
done again after a failure replaces what it wrote, and a restart finds nothing new.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schemas import SAMPLE
from ..sources.csv_io import read_headered_csv

VERSION = "path string, modified long, length long"


def folder_versions(folder: str) -> dict[str, list[int]]:
    """Each file of a folder with its time (nanoseconds) and length; hidden ones are left out."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    return {f"{folder.rstrip('/')}/{f.base_name}": [int(f.mtime_ns or 0), int(f.size or 0)] for f in files}


class Some(InputPartition):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


class FileVersionsReader(DataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": folder_versions(self.folder)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before = start["files"]
        return [Some(sorted((p, *v) for p, v in end["files"].items() if before.get(p) != v))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.rows


class FileVersions(DataSource):
    """``spark.readStream.format("file_versions").load(folder)``: path, modified, length."""

    @classmethod
    def name(cls) -> str:
        return "file_versions"

    def schema(self) -> str:
        return VERSION

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FileVersionsReader(self.options["path"])


def run_replaced_files(spark: SparkSession, incoming_dir: str, target_path: str, checkpoint: str | None = None, schema=SAMPLE) -> None:
    """Load every file version that has come since the last run: each is appended to the target once."""
    target_path = target_path.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.select("path").collect())  # names of new files, not their rows
        if files:
            rows = read_headered_csv(batch.sparkSession, files, schema, version="version")
            # only the partitions of the versions that are written now are replaced
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(target_path)

    spark.dataSource.register(FileVersions)
    stream = spark.readStream.format("file_versions").load(incoming_dir)
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint or f"{target_path}_checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
