"""Parquet store of a type-2 dimension in hash buckets, committed by manifests.

Plain Parquet (no table format with row-level operations is assumed)::

    <root>/rows/<write>/part=live|closed/bucket=<b>/   rows a write made; a file never changes
    <root>/manifests/<write>-<try>/                    the files of the state after a write
    <root>/pending/<write>/                            child rows that wait for their customer
    <root>/commits/<run>.json                          the commit of a run, published only if absent

A row's bucket is a hash of its id.  A delta run rewrites the current rows of the buckets its ids fall
in, and adds the rows it closed; its manifest refers to the other buckets' files as they are, so that what
a run reads and writes follows its delta.  A bucket's size is the store's rewrite unit: choose ``buckets``
for some 100 MB of current rows each (it is fixed by the first commit; a full load may change it).

A manifest has a row for each file, with the least and greatest start and end date of its rows.  ``as_of``
reads only files whose dates span the day: rows closed by one run end on one day, so files closed before it
aren't even listed.  Current files are all in the newest manifest; files of closed rows stand in the
manifest of the run that closed them (``closed_in``).

A commit is one small file that names the manifest, the marks and the rest, and makes a state visible at
once; a run that fails before leaves only files that no commit refers to.  Writers need no lock: who finds
the next run's commit taken looks at what was committed meanwhile.  If that touched none of its own buckets,
its manifest is put on top of the newer one; else ``CommitConflict`` tells the caller to merge again from
the new state (``plans.pipeline`` does).

The driver handles names of files and numbers of buckets, never rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.scd import CURRENT
from ..schemas import DIMENSION, DIMENSION_COLUMNS, PENDING, WATERMARK
from ..session import materialize
from .files import Files

LIVE, CLOSED = "live", "closed"
FILES = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("path", T.StringType()),  # below the root
        T.StructField("n_rows", T.LongType()),
        T.StructField("start_min", T.DateType()),
        T.StructField("start_max", T.DateType()),
        T.StructField("end_min", T.DateType()),
        T.StructField("end_max", T.DateType()),
    ]
)


#: Folders that ``vacuum`` looks through.
SWEPT = ("rows", "manifests", "pending", "_work")


class CommitConflict(RuntimeError):
    """Another writer committed rows of the same buckets since this one read the store."""


@dataclass(frozen=True)
class Commit:
    run: int
    write: str
    manifest: str
    closed_in: tuple[str, ...]  # manifests whose closed files are part of the state
    buckets: int
    touched: tuple[int, ...] | None  # None: all, a full load
    marks: dict[str, str]
    pending: str | None
    backup: int | None  # the run before a full load, whose state is kept


class DimensionStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)
        self.writer = uuid.uuid4().hex  # names this writer's scratch folder
        self._buckets = buckets
        self._last: Commit | None = None
        self._known = False

    # --- commits ----------------------------------------------------------------------------

    def refresh(self) -> None:
        """Look at the commits anew: other writers' too."""
        self._known = False

    def runs(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names("commits") if n.endswith(".json")]

    def commit(self, run: int) -> Commit:
        told = json.loads(self.files.read(_commit_name(run)))
        told["closed_in"] = tuple(told["closed_in"])
        told["touched"] = None if told["touched"] is None else tuple(told["touched"])
        return Commit(**told)

    def last_commit(self) -> Commit | None:
        if not self._known:
            runs = self.runs()
            self._last, self._known = (self.commit(runs[-1]) if runs else None), True
        return self._last

    @property
    def buckets(self) -> int:
        c = self.last_commit()
        return self._buckets if c is None else c.buckets

    def watermarks(self) -> DataFrame:
        """(table_name, max_updated) of the last commit; empty before the first."""
        c = self.last_commit()
        marks = {} if c is None else c.marks
        return self.spark.createDataFrame([(t, dt.datetime.fromisoformat(m)) for t, m in marks.items()], WATERMARK)

    # --- reading ----------------------------------------------------------------------------

    def bucket_of(self, id_: Column, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(id_.cast("long")), F.lit(buckets or self.buckets)).cast("int")

    def buckets_of(self, ids: DataFrame) -> list[int]:
        """The buckets of ``ids.id``: at most as many numbers as the store has buckets."""
        return sorted(r["b"] for r in ids.select(self.bucket_of(F.col("id")).alias("b")).distinct().collect())

    def manifest(self, commit: Commit | None = None) -> DataFrame:
        """The files of a state (the last one's, unless a commit is named)."""
        c = commit or self.last_commit()
        if c is None:
            return self.spark.createDataFrame([], FILES)
        read = self.spark.read.schema(FILES)
        live = read.parquet(f"{self.root}/{c.manifest}").where(F.col("part") == LIVE)
        if not c.closed_in:
            return live
        return live.unionByName(read.parquet(*[f"{self.root}/{m}" for m in c.closed_in]).where(F.col("part") == CLOSED))

    def _rows_of(self, files: DataFrame) -> DataFrame:
        paths = [f"{self.root}/{r['path']}" for r in files.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], DIMENSION)
        try:
            return self.spark.read.schema(DIMENSION).parquet(*paths)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                raise FileNotFoundError(f"files of a committed state are missing: {e}") from e
            raise

    def _part(self, part: str, buckets: Iterable[int] | None, commit: Commit | None) -> DataFrame:
        files = self.manifest(commit).where(F.col("part") == part)
        if buckets is not None:
            files = files.where(F.col("bucket").isin(list(buckets)))
        return self._rows_of(files)

    def current(self, buckets: Iterable[int] | None = None, commit: Commit | None = None) -> DataFrame:
        return self._part(LIVE, buckets, commit)

    def history(self, buckets: Iterable[int] | None = None, commit: Commit | None = None) -> DataFrame:
        return self._part(CLOSED, buckets, commit)

    def dimension(self, commit: Commit | None = None) -> DataFrame:
        return self._rows_of(self.manifest(commit))

    def as_of(self, day: dt.date | str) -> DataFrame:
        """Rows valid on ``day``, from the files whose dates span it."""
        d = F.lit(str(day)).cast("date")
        files = self.manifest().where((F.col("start_min") <= d) & (F.col("end_max") >= d))
        return self._rows_of(files).where((F.col("etl_start_date") <= d) & (F.col("etl_end_date") >= d))

    def backup(self, run: int) -> DataFrame:
        """The whole dimension as it was before the full load of ``run``: its files are kept, not copied."""
        before = self.commit(run).backup
        if before is None:
            raise LookupError(f"run {run} replaced nothing")
        return self.dimension(self.commit(before))

    def pending(self) -> DataFrame:
        """Child rows that arrived before their customer."""
        c = self.last_commit()
        if c is None or c.pending is None:
            return self.spark.createDataFrame([], PENDING)
        return self.spark.read.schema(PENDING).parquet(f"{self.root}/{c.pending}")

    # --- writing ----------------------------------------------------------------------------

    def _write_rows(self, write: str, rows: DataFrame, buckets: int) -> DataFrame:
        """Writes ``rows``, a file for each bucket and part, and returns their manifest rows."""
        part = F.when(F.col("etl_current_ind").eqNullSafe(CURRENT), LIVE).otherwise(CLOSED)
        dealt = rows.select(*DIMENSION_COLUMNS, part.alias("part"), self.bucket_of(F.col("id"), buckets).alias("bucket"))
        path = f"{self.root}/rows/{write}"
        dealt.repartition("bucket").write.partitionBy("part", "bucket").parquet(path)
        schema = T.StructType([*DIMENSION.fields, T.StructField("part", T.StringType()), T.StructField("bucket", T.IntegerType())])
        start, end = F.col("etl_start_date"), F.col("etl_end_date")
        # Only the two dates are read back, of what this run wrote.
        told = self.spark.read.schema(schema).parquet(path).groupBy("part", "bucket", F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(start).alias("start_min"), F.max(start).alias("start_max"), F.min(end).alias("end_min"), F.max(end).alias("end_max")
        )
        below = F.concat(F.lit("rows/"), F.lit(write), F.lit("/part="), "part", F.lit("/bucket="), "bucket", F.lit("/"), F.element_at(F.split("file", "/"), -1))
        return told.select("part", "bucket", below.alias("path"), *FILES.fieldNames()[3:])

    def _write_pending(self, write: str, pending: DataFrame | None, base: Commit | None) -> str | None:
        if pending is None:
            return base.pending if base else None
        name = f"pending/{write}"
        pending.select(*PENDING.fieldNames()).write.parquet(f"{self.root}/{name}")
        return None if self.spark.read.schema(PENDING).parquet(f"{self.root}/{name}").isEmpty() else name

    def commit_delta(self, rows: DataFrame, marks: DataFrame, touched: Iterable[int] | None = None, pending: DataFrame | None = None) -> Commit:
        """Commit a delta run: ``rows`` are the current rows of the touched buckets and the rows closed now.

        ``touched`` names the buckets that ``rows`` replaces (None: all of them).  ``pending`` replaces the
        pending child rows (None: they stay)."""
        base = self.last_commit()
        buckets = self.buckets
        touched = tuple(range(buckets)) if touched is None else tuple(sorted(set(touched)))
        write = uuid.uuid4().hex
        mine = self._write_rows(write, rows, buckets)
        waiting = self._write_pending(write, pending, base)
        told = _marks(marks)
        tip, attempt = base, 0
        while True:
            name = f"manifests/{write}-{attempt}"
            kept = self.manifest(tip).where((F.col("part") == LIVE) & ~F.col("bucket").isin(list(touched))) if tip else self.spark.createDataFrame([], FILES)
            kept.unionByName(mine).write.parquet(f"{self.root}/{name}")
            commit = Commit(
                run=tip.run + 1 if tip else 1,
                write=write,
                manifest=name,
                closed_in=(*(tip.closed_in if tip else ()), name),
                buckets=buckets,
                touched=touched,
                marks=told if tip is None else {t: max(told.get(t, ""), tip.marks.get(t, "")) for t in {*told, *tip.marks}},
                pending=waiting if pending is not None or tip is None else tip.pending,
                backup=None,
            )
            if self._publish(commit):
                return commit
            tip, attempt = self._rebased(base, tip, touched, waiting if pending is not None else None), attempt + 1

    def commit_full(self, rows: DataFrame, marks: DataFrame, pending: DataFrame | None = None, buckets: int | None = None) -> Commit:
        """Full load: the state is exactly ``rows``; the state before stays readable as its backup."""
        base = self.last_commit()
        buckets = buckets or self.buckets
        write = uuid.uuid4().hex
        name = f"manifests/{write}-0"
        self._write_rows(write, rows, buckets).write.parquet(f"{self.root}/{name}")
        commit = Commit(base.run + 1 if base else 1, write, name, (name,), buckets, None, _marks(marks), self._write_pending(write, pending, None), base.run if base else None)
        if not self._publish(commit):
            raise CommitConflict(f"run {commit.run} was committed while a full load was written")
        return commit

    def _publish(self, commit: Commit) -> bool:
        if not self.files.publish(_commit_name(commit.run), json.dumps(asdict(commit))):
            return False
        self._last, self._known = commit, True
        return True

    def _rebased(self, base: Commit | None, tip: Commit | None, touched: tuple[int, ...], waiting: str | None) -> Commit:
        """The newest commit, if all since ``tip`` go together with a write that touched ``touched``."""
        newer = [self.commit(r) for r in self.runs() if tip is None or r > tip.run]
        for c in newer:
            both = set(touched) if c.touched is None else set(touched) & set(c.touched)
            if both or c.touched is None:
                raise CommitConflict(f"run {c.run} changed {len(both)} of the buckets that this write replaces")
            if c.pending != (base.pending if base else None) and waiting != (base.pending if base else None):
                raise CommitConflict(f"run {c.run} changed the pending rows too")
        return newer[-1]

    # --- retention --------------------------------------------------------------------------

    def vacuum(self, keep: int = 1, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
        """Removes what no kept state refers to: returns the number of files and folders removed.

        Kept are the last ``keep`` commits and the states that they name as backups.  Files younger than
        ``older_than`` stay, as a run that isn't committed yet may have written them."""
        if keep < 1:
            raise ValueError("the last state can't be removed")
        runs = self.runs()
        kept: dict[int, Commit] = {}
        for run in runs[-keep:]:
            kept[run] = self.commit(run)
            while (before := kept[run].backup) is not None and before in runs and before not in kept:
                kept[before] = self.commit(before)
                run = before
        if not kept:
            return 0
        folders = {m for c in kept.values() for m in (c.manifest, *c.closed_in)} | {c.pending for c in kept.values() if c.pending}
        named = reduce(DataFrame.unionByName, [self.manifest(c).select("path") for c in kept.values()]).distinct()
        cutoff = F.lit(dt.datetime.now(dt.timezone.utc) - older_than)
        top = self.files.qualified() + "/"
        found = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{self.root}/{f}" for f in self.files.names("") if f in SWEPT])
            .select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "modificationTime")
            .select(F.replace("path", F.lit(_one_slash(top)), F.lit("")).alias("path"), (F.col("modificationTime") < cutoff).alias("old"))
        )
        kind = F.split("path", "/")[0]
        folder = F.concat_ws("/", F.slice(F.split("path", "/"), 1, 2))
        loose_rows = found.where((kind == "rows") & F.col("old")).join(named, "path", "left_anti").select("path")
        # a folder goes as a whole, if all its files are old
        whole = found.where(kind != "rows").groupBy(folder.alias("path")).agg(F.min("old").alias("old")).where("old").select("path")
        loose_folders = whole.where(~F.col("path").isin(sorted(folders)))
        # Listed and written down before anything goes.  Commits go first: no reader shall find one whose
        # files are gone.
        loose, removed = materialize(loose_rows.unionByName(loose_folders)), 0
        for run in runs:
            if run not in kept:
                self.files.remove(_commit_name(run))
                removed += 1
        for r in loose.toLocalIterator():
            self.files.remove(r["path"])
            removed += 1
        return removed


def _commit_name(run: int) -> str:
    return f"commits/{run:010d}.json"


def _marks(marks: DataFrame) -> dict[str, str]:
    """A mark for each source table, as text that sorts by time."""
    return {r["table_name"]: r["max_updated"].isoformat(timespec="microseconds") for r in marks.collect() if r["max_updated"] is not None}


def _one_slash(path: str) -> str:
    return "file:/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
