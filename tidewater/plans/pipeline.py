"""The customer sync end to end: extract -> land -> stage -> transform -> merge -> commit.

Per run:

1. resolve the load type (a scheduled run may not be a full load);
2. per source table, extract in full or above its stored high-water mark (the predicate is
   pushed into the source scan), land it (CSV like a database ``COPY``, or Parquet) and
   load the stage table from the landing files;
3. take the new marks from the stages' footers, without reading a row (NULL keeps the old mark);
4. full load: build the dimension from the stages and replace it (with a backup);
   delta load: merge the stages into the dimension (corrected or literal mode), reading and
   writing only the buckets that hold the delta's ids; a child row without a customer waits in
   the store and joins the stages of later runs (corrected mode);
5. commit data and marks at once (the marks never run ahead of the data); if another writer
   committed into the same buckets meanwhile, steps 4 and 5 are done again on its state.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.scd import RunContext
from ..operators import scd2, transform
from ..operators.watermark import LoadPlan, footer_mark, resolve_load, upsert_watermarks, watermark_value
from ..schemas import SOURCE_SCHEMAS, WATERMARK
from ..session import materialize
from ..sources.csv_io import STAGE_MARK, read_stage_csv, write_landing, write_stage
from ..sources.extract import SOURCE_COLUMNS, extract
from ..sources.table_store import Commit, CommitConflict, DimensionStore

TABLES = ("customer", "customer_address", "customer_payment")
#: How often a merge is tried when other writers commit into its buckets meanwhile.
ATTEMPTS = 5


@dataclass(frozen=True)
class RunResult:
    commit: Commit
    load_type: str


def _stage_schema(table: str, columns: list[str]):
    from pyspark.sql import types as T

    fields = {f.name: f for f in SOURCE_SCHEMAS.get(table, T.StructType()).fields}
    fields.setdefault("deleted_at", T.StructField("deleted_at", T.TimestampNTZType()))
    return T.StructType([fields[c] for c in columns])


def land_and_stage(
    spark: SparkSession, df: DataFrame, table: str, workdir: str, landing_format: str = "parquet"
) -> DataFrame:
    """Land an extract (replace), then truncate-and-load the stage table from the landing files."""
    landing = f"{workdir}/landing/{table}"
    stage = f"{workdir}/stage/{table}"
    write_landing(df, landing, fmt=landing_format)
    if landing_format == "csv":
        # Header-less positional CSV: columns in extract order, explicit schema.
        landed = read_stage_csv(spark, landing, _stage_schema(table, df.columns), multiline=True)
    else:
        landed = spark.read.parquet(landing)
    write_stage(landed, stage)
    return spark.read.parquet(stage).drop(STAGE_MARK)


def customer_pipeline(
    spark: SparkSession,
    store: DimensionStore,
    sources: Mapping[str, DataFrame],
    load_type: str,
    run: RunContext,
    run_type: str = "manual",
    mode: str = "corrected",
    workdir: str | None = None,
    landing_format: str = "parquet",
    deletes: str | None = None,
) -> RunResult:
    """One run of the customer sync.

    ``sources`` maps table name -> source DataFrame (JDBC, Parquet, …) for customer,
    customer_address, customer_payment and, for ``deletes='hard'``, deleted_entries.
    ``deletes``: None, 'soft' (customer.deleted_at) or 'hard' (deleted_entries log).
    """
    plan = resolve_load(load_type, run_type)
    workdir = workdir or f"{store.root}/_work/{store.writer}"
    marks = store.watermarks()
    tables = list(TABLES) + (["deleted_entries"] if deletes == "hard" else [])
    staged = {}
    for t in tables:
        cols = SOURCE_COLUMNS[t] + (["deleted_at"] if t == "customer" and deletes == "soft" else [])
        src = sources[t]
        df = extract(src.select(*cols), plan, None if plan.is_full else watermark_value(marks, t), cols)
        staged[t] = land_and_stage(spark, df, t, workdir, landing_format)

    read = [(t, footer_mark(spark, f"{workdir}/stage/{t}", STAGE_MARK)) for t in tables]
    merged_marks = upsert_watermarks(marks, spark.createDataFrame(read, WATERMARK))

    deleted_log = staged.get("deleted_entries")
    for attempt in range(1, ATTEMPTS + 1):
        try:
            commit = _merge(spark, store, plan, staged, deleted_log, merged_marks, run, mode, deletes)
            return RunResult(commit, plan.load_type)
        except CommitConflict:
            if attempt == ATTEMPTS:
                raise
            store.refresh()  # merge the same stages again, into what the other writer left


def _merge(
    spark: SparkSession,
    store: DimensionStore,
    plan: LoadPlan,
    staged: Mapping[str, DataFrame],
    deleted_log: DataFrame | None,
    marks: DataFrame,
    run: RunContext,
    mode: str,
    deletes: str | None,
) -> Commit:
    """Steps 4 and 5 from the store's last state: a delta reads and writes the buckets of its ids only."""
    c, a, p = (staged[t] for t in TABLES)
    if plan.is_full:
        if mode == "literal":
            return store.commit_full(transform.full_transform(c, a, p, run, skip_deleted=deletes == "soft"), marks)
        cls = materialize(transform.classify_full(c, a, p, run))
        return store.commit_full(cls.where("_insert").select("_new.*"), marks, transform.orphans(cls, a, p))
    if mode == "literal":
        deleted = scd2.hard_delete_ids_literal(deleted_log, c) if deletes == "hard" else None
    else:
        deleted = scd2.hard_delete_ids(deleted_log) if deletes == "hard" else None
        waiting = store.pending()
        a = transform.with_pending(a, "customer_address", "address", waiting)
        p = transform.with_pending(p, "customer_payment", "payment_method", waiting)
    ids = transform.staged_keys(c, a, p)
    buckets = store.buckets_of(ids if deleted is None else ids.unionByName(deleted.select("id")))
    current, history = store.current(buckets), store.history(buckets)
    if mode == "literal":
        target = history.unionByName(current)
        temp = materialize(transform.delta_transform_literal(c, a, p, target, run, skip_deleted=deletes == "soft"))
        extra = None
        if deletes == "soft":
            extra = scd2.soft_delete_close(c, run)
        elif deletes == "hard":
            extra = scd2.hard_delete_close(deleted, run)
        return store.commit_delta(scd2.merge_literal_rows(current, history, temp, run, extra), marks, buckets)
    # The classification is delta-sized and read several times: write it once (the "temp" table).
    cls = materialize(transform.classify_corrected(c, a, p, current, history, run, deleted))
    changed = cls.where("_close or _insert").select("id")
    touched = store.buckets_of(changed if deleted is None else changed.unionByName(deleted.select("id")))
    rows = scd2.apply_corrected(store.current(touched), cls, run, deleted)
    return store.commit_delta(rows, marks, touched, transform.orphans(cls, a, p))
