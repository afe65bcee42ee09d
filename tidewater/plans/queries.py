"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's test tables (or DataFrames Spark derives from them) in
full.  Dimension states of successive days are written under the checkpoint directory so
the lineage of day 3 does not re-plan days 1 and 2 several times over.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scd import RunContext
from ..operators import scd2, transform
from ..operators.history import as_of
from ..operators.latest import latest_per_key
from ..operators.quality import dq_metrics as _dq_metrics
from ..operators.quality import route
from ..operators.reporting import calendar_activity as _calendar_activity
from ..operators.reporting import invitations, order_totals
from ..operators.reporting import weekend_split as _weekend_split
from ..operators.watermark import LoadPlan, high_water_mark, upsert_watermarks, watermark_value
from ..session import checkpoint_dir, materialize
from ..sources.csv_io import read_stage_csv, write_landing
from ..sources.extract import SOURCE_COLUMNS, extract
from ..sources.files import Files
from ..sources.inline import day_activity
from ..sources.table_store import DimensionStore
from .fixtures import Scenario, day_ts, delete_log, early_children, run_of_day, two_children
from ..streaming.file_ingest import run_file_ingest
from ..streaming.file_versions import run_replaced_files
from .ingest import csv_ingest, gated_ingest
from .ingest import gated_append as _gated_append
from .pipeline import customer_pipeline

AS_OF_DAY = dt.date(2024, 1, 2)
EVENTS_PRIOR_CUTOFF = "2024-01-16 00:00:00"
ORDERS_PRIOR_CUTOFF = "2000-01-01 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Dimension:
    """Day-by-day states of the customer dimension for one mode.

    ``target(d)`` is lazy.  A state that feeds a later day is written once under the
    checkpoint directory from day 2 on (the merge reads it several times), as is the
    literal-mode candidate table, which its three statements read four times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, mode: str, deletes: bool = False):
        self.mode = mode
        self.sc = Scenario(spark, sf_dir, deletes=deletes)
        self._targets: dict[int, DataFrame] = {}
        self._inputs: dict[int, DataFrame] = {}
        self._temps: dict[int, DataFrame] = {}
        self._classified: dict[int, DataFrame] = {}

    def temp(self, d: int) -> DataFrame:
        """The candidate ("temp") table of day d."""
        if d not in self._temps:
            c, a, p = self.sc.stages(d)
            run = run_of_day(d)
            if d == 1:
                full = transform.full_transform if self.mode == "literal" else transform.full_transform_corrected
                out = full(c, a, p, run)
            elif self.mode == "literal":
                out = materialize(transform.delta_transform_literal(c, a, p, self.input(d - 1), run))
            else:
                out = self.classified(d).where("_insert").select("_new.*")
            self._temps[d] = out
        return self._temps[d]

    def target(self, d: int) -> DataFrame:
        """The dimension after day d's load (lazy)."""
        if d not in self._targets:
            run = run_of_day(d)
            if d == 1:
                out = scd2.full_refresh(self.temp(1))
            elif self.mode == "literal":
                out = scd2.merge_literal(self.input(d - 1), self.temp(d), run)
            else:
                current, history = scd2.split(self.input(d - 1))
                out = history.unionByName(scd2.apply_corrected(current, self.classified(d), run))
            self._targets[d] = out
        return self._targets[d]

    def classified(self, d: int) -> DataFrame:
        """Corrected mode: the delta-sized classification of day d, written once."""
        if d not in self._classified:
            c, a, p = self.sc.stages(d)
            current, history = scd2.split(self.input(d - 1))
            self._classified[d] = materialize(transform.classify_corrected(c, a, p, current, history, run_of_day(d)))
        return self._classified[d]

    def input(self, d: int) -> DataFrame:
        """Day d's dimension as the input of day d + 1: written once from day 2 on."""
        if d not in self._inputs:
            self._inputs[d] = self.target(d) if d == 1 else materialize(self.target(d))
        return self._inputs[d]


# --- extraction and watermarks -----------------------------------------------------------


def extract_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full extract of the customer source as of day 3 (every column, no predicate)."""
    sc = Scenario(spark, sf_dir)
    return extract(sc.oltp("customer", 3), LoadPlan("full"))


def extract_delta_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events above the mark left by a previous load that covered the first half of the month."""
    events = _t(spark, sf_dir, "events")
    prior = events.where(F.col("ts") < F.lit(EVENTS_PRIOR_CUTOFF).cast("timestamp_ntz"))
    hwm = high_water_mark(prior, "events", "ts").first()["max_updated"]
    return extract(events, LoadPlan("delta"), hwm, ["event_id", "ts", "user_id", "event_type", "value"], column="ts")


def extract_delta_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders above the mark of a previous load that ran before 2000; the orders dated on the
    mark itself (day-grain ties) were in that load and the strict predicate leaves them out."""
    orders = _t(spark, sf_dir, "orders")
    prior = orders.where(F.col("o_orderdate") < F.lit(ORDERS_PRIOR_CUTOFF).cast("timestamp_ntz"))
    hwm = high_water_mark(prior, "orders", "o_orderdate").first()["max_updated"]
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return extract(orders, LoadPlan("delta"), hwm, cols, column="o_orderdate")


def high_water_mark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        high_water_mark(_t(spark, sf_dir, "orders"), "orders", "o_orderdate")
        .unionByName(high_water_mark(_t(spark, sf_dir, "events"), "events", "ts"))
        .unionByName(high_water_mark(_t(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate"))
    )


def hwm_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control table after a second run over three whole tables: two marks advance, one delta is empty, and
    the stored marks of the events' types, which aren't in the run, stay."""
    columns = {"orders": "o_orderdate", "events": "ts", "lineitem": "l_shipdate"}
    tables = {t: _t(spark, sf_dir, t) for t in columns}
    cutoff = F.lit(ORDERS_PRIOR_CUTOFF).cast("timestamp_ntz")
    first = tables | {t: tables[t].where(F.col(columns[t]) < cutoff) for t in ("orders", "lineitem")}
    marks = [high_water_mark(first[t], t, c) for t, c in columns.items()]
    by_type = tables["events"].groupBy("event_type").agg(F.max("ts").alias("max_updated"))
    marks.append(by_type.select(F.concat(F.lit("events_"), "event_type").alias("table_name"), "max_updated"))
    prior = materialize(reduce(DataFrame.unionByName, marks))
    above = {t: extract(tables[t], LoadPlan("delta"), watermark_value(prior, t), column=c) for t, c in columns.items()}
    return upsert_watermarks(prior, reduce(DataFrame.unionByName, [high_water_mark(above[t], t, c) for t, c in columns.items()]))


def hwm_upsert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of whole tables: one from before a cutoff, raised by everything above it."""
    columns = {"orders": "o_orderdate", "events": "ts", "lineitem": "l_shipdate"}
    tables = {t: _t(spark, sf_dir, t) for t in columns}
    cutoffs = {"orders": ORDERS_PRIOR_CUTOFF, "events": EVENTS_PRIOR_CUTOFF, "lineitem": ORDERS_PRIOR_CUTOFF}
    below = lambda t: tables[t].where(F.col(columns[t]) < F.lit(cutoffs[t]).cast("timestamp_ntz"))
    prior = materialize(reduce(DataFrame.unionByName, [high_water_mark(below(t), t, c) for t, c in columns.items()]))
    above = {t: extract(tables[t], LoadPlan("delta"), watermark_value(prior, t), column=c) for t, c in columns.items()}
    return upsert_watermarks(prior, reduce(DataFrame.unionByName, [high_water_mark(above[t], t, c) for t, c in columns.items()]))


# --- transforms ---------------------------------------------------------------------------


def full_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full transform over day 3, when every customer is there."""
    sc = Scenario(spark, sf_dir)
    c, a, p = (extract(sc.oltp(t, 3), LoadPlan("full")) for t in Scenario.TABLES)
    return transform.full_transform(c, a, p, run_of_day(3))


def delta_transform_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Dimension(spark, sf_dir, "literal").temp(2)


def delta_transform_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Dimension(spark, sf_dir, "corrected").temp(2)


def latest_per_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order of each customer (ties on the day broken by the higher order key)."""
    return latest_per_key(_t(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


def children_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user: the child-row reduction used before enrichment."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return latest_per_key(ev, "user_id", ["ts", "event_id"])


# --- type-2 merge, literal statements -----------------------------------------------------


def _literal_day2(spark: SparkSession, sf_dir: str):
    dim = Dimension(spark, sf_dir, "literal")
    return dim.input(1), dim.temp(2), run_of_day(2)


def scd2_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    t0, temp, run = _literal_day2(spark, sf_dir)
    return scd2.close_changed(t0, temp, run)


def scd2_new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t0, temp, run = _literal_day2(spark, sf_dir)
    return scd2.new_versions(scd2.close_changed(t0, temp, run), temp, run)


def scd2_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t0, temp, run = _literal_day2(spark, sf_dir)
    return scd2.new_keys(t0, temp, run)


def scd2_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Dimension(spark, sf_dir, "literal").target(3)


def scd2_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Dimension(spark, sf_dir, "corrected").target(3)


def full_load_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full reload on day 3: backup of the day-2 dimension plus the rebuilt dimension."""
    dim = Dimension(spark, sf_dir, "corrected")
    backup = dim.input(2)
    sc = dim.sc
    c, a, p = (extract(sc.oltp(t, 3), LoadPlan("full")) for t in Scenario.TABLES)
    refreshed = scd2.full_refresh(transform.full_transform_corrected(c, a, p, run_of_day(3)))
    return refreshed.withColumn("generation", F.lit("current")).unionByName(
        backup.withColumn("generation", F.lit("backup"))
    )


# --- deletes ------------------------------------------------------------------------------


def _delete_day3(spark: SparkSession, sf_dir: str, mode: str, soft: bool):
    dim = Dimension(spark, sf_dir, mode)
    dsc = Scenario(spark, sf_dir, deletes=True)
    c, a, p = dsc.stages(3)
    if not soft:
        c = c.select(*SOURCE_COLUMNS["customer"])
    return dim.input(2), c, a, p, dsc.deleted_entries(), run_of_day(3)


def soft_delete_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    tgt, c, a, p, _, run = _delete_day3(spark, sf_dir, "literal", soft=True)
    temp = materialize(transform.delta_transform_literal(c, a, p, tgt, run, skip_deleted=True))
    return scd2.merge_literal(tgt, temp, run, extra_close=scd2.soft_delete_close(c, run))


def _corrected_day(tgt: DataFrame, c: DataFrame, a: DataFrame, p: DataFrame, run: RunContext, deleted=None) -> DataFrame:
    current, history = scd2.split(tgt)
    cls = materialize(transform.classify_corrected(c, a, p, current, history, run, deleted))
    return history.unionByName(scd2.apply_corrected(current, cls, run, deleted))


def soft_delete_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    tgt, c, a, p, _, run = _delete_day3(spark, sf_dir, "corrected", soft=True)
    return _corrected_day(tgt, c, a, p, run)


def hard_delete_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    tgt, c, a, p, de, run = _delete_day3(spark, sf_dir, "literal", soft=False)
    temp = materialize(transform.delta_transform_literal(c, a, p, tgt, run))
    ids = scd2.hard_delete_ids_literal(de, c)
    return scd2.merge_literal(tgt, temp, run, extra_close=scd2.hard_delete_close(ids, run))


def hard_delete_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    tgt, c, a, p, de, run = _delete_day3(spark, sf_dir, "corrected", soft=False)
    return _corrected_day(tgt, c, a, p, run, scd2.hard_delete_ids(de))


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = Dimension(spark, sf_dir, "corrected").target(3)
    return as_of(dim, AS_OF_DAY).select("id", "name", "address", "payment_method", "etl_start_date", "etl_end_date")


# --- the pipeline end to end ---------------------------------------------------------------


def _pipeline(spark: SparkSession, sf_dir: str, mode: str, landing: str) -> DimensionStore:
    """Three daily runs of the customer pipeline into a fresh store under the checkpoint
    directory.  Each run extracts above the stored marks."""
    store = DimensionStore(spark, _scratch(spark, "tidewater-store"))
    sc = Scenario(spark, sf_dir)
    for d in (1, 2, 3):
        sources = {t: sc.oltp(t, d) for t in Scenario.TABLES}
        customer_pipeline(spark, store, sources, "full" if d == 1 else "delta", run_of_day(d), mode=mode, landing_format=landing)
    return store


def pipeline_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pipeline(spark, sf_dir, "corrected", "parquet").dimension()


def pipeline_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pipeline(spark, sf_dir, "literal", "csv").dimension()


def as_of_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension on a past day, from the store's files that span it."""
    rows = _pipeline(spark, sf_dir, "corrected", "parquet").as_of(AS_OF_DAY)
    return rows.select("id", "name", "address", "payment_method", "etl_start_date", "etl_end_date")


def late_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's address and payment arrive on day 1, some customers only on day 2: their
    children wait in the store for them."""
    store = DimensionStore(spark, _scratch(spark, "tidewater-store"))
    sc = Scenario(spark, sf_dir)
    address, payment = early_children(sc.base)
    for d in (1, 2):
        sources = {"customer": sc.oltp("customer", d), "customer_address": address, "customer_payment": payment}
        customer_pipeline(spark, store, sources, "full" if d == 1 else "delta", run_of_day(d))
    return store.dimension().select("id", "name", "address", "payment_method", "etl_start_date", "etl_end_date", "etl_current_ind")


# --- several child rows a customer, deleted entries ---------------------------------------


def _customers(sc: Scenario) -> DataFrame:
    times = [day_ts(1).alias("created_at"), day_ts(1).alias("updated_at")]
    return sc.base.select(F.col("k").alias("id"), F.col("c_name").alias("name"), *times)


def children_fanout_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two addresses and two payments for every customer: the literal transform joins each with each."""
    sc = Scenario(spark, sf_dir)
    out = transform.full_transform(_customers(sc), *two_children(sc.base), run_of_day(1))
    return out.select("id", "name", "address", "payment_method")


def children_reduced_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stages in corrected mode: one version a customer, with the latest row of each child."""
    sc = Scenario(spark, sf_dir)
    out = transform.full_transform_corrected(_customers(sc), *two_children(sc.base), run_of_day(1))
    return out.select("id", "name", "address", "payment_method")


def deleted_entries_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted entries above the mark of an earlier load of the log."""
    log = delete_log(Scenario(spark, sf_dir).base)
    hwm = high_water_mark(log.where(F.col("updated_at") <= day_ts(2)), "deleted_entries").first()["max_updated"]
    return extract(log, LoadPlan("delta"), hwm, SOURCE_COLUMNS["deleted_entries"])


# --- data quality and ingest --------------------------------------------------------------


def orders_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a loader would stage them with a broken key on every thousandth order."""
    o = _t(spark, sf_dir, "orders")
    return o.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 1000 != 0, F.col("o_orderkey")))


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dq_metrics(orders_with_null_keys(spark, sf_dir), "o_orderkey", "orders")


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate decision per staged table; an incremental stage with nothing new is routed to notify."""
    orders = _t(spark, sf_dir, "orders")
    newest = high_water_mark(orders, "orders", "o_orderdate").first()["max_updated"]
    metrics = (
        _dq_metrics(orders_with_null_keys(spark, sf_dir), "o_orderkey", "orders")
        .unionByName(_dq_metrics(_t(spark, sf_dir, "lineitem"), "l_orderkey", "lineitem"))
        .unionByName(_dq_metrics(_t(spark, sf_dir, "supplier"), "s_suppkey", "supplier"))
        .unionByName(
            _dq_metrics(extract(orders, LoadPlan("delta"), newest, column="o_orderdate"), "o_orderkey", "orders_delta")
        )
    )
    return route(metrics)


def gated_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers staged by a later load are appended to the existing target when the stage passes."""
    sup = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    target = sup.where(F.col("s_nationkey") < 12)
    stage = sup.where(F.col("s_nationkey") >= 12)
    result, _ = _gated_append(stage, target, key="s_suppkey")
    return result


def file_arrival_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers arrive as two CSV files (nations < 12, then the rest); each arrival is picked
    up by its own availableNow run of the streaming ingest (same checkpoint), gated and
    appended.  Returns the loaded target."""
    root = _scratch(spark, "tidewater-stream")
    sup = _samples(spark, sf_dir)
    for part in (sup.where(F.col("s_nationkey") < 12), sup.where(F.col("s_nationkey") >= 12)):
        # an arrival = new files (new names) in the watched directory
        part.drop("s_nationkey").write.mode("append").option("header", "true").csv(f"{root}/incoming")
        run_file_ingest(spark, f"{root}/incoming", f"{root}/target", checkpoint=f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/target").select("id", "name", "amount")


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as CSV samples, with their nation."""
    sup = _t(spark, sf_dir, "supplier")
    id_ = F.col("s_suppkey").cast("int").alias("id")
    return sup.select(id_, F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount"), "s_nationkey")


def file_arrival_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival of suppliers as good files and bad ones (an amount that is no number): each file
    is judged by itself, the bad ones' rows are kept apart.  Returns both, with their route."""
    root = _scratch(spark, "tidewater-gated")
    sup = _samples(spark, sf_dir)
    good = F.col("s_nationkey") % 5 != 0
    for part in (sup.where(good), sup.where(~good).withColumn("amount", F.lit("zz"))):
        part.drop("s_nationkey").write.mode("append").option("header", "true").csv(f"{root}/incoming")
    run_file_ingest(spark, f"{root}/incoming", f"{root}/target")
    loaded = spark.read.parquet(f"{root}/target").select("id", "name", F.lit("load_target").alias("route"))
    refused = spark.read.parquet(f"{root}/target_refused").select("id", "name", F.lit("notify").alias("route"))
    return loaded.unionByName(refused)


def csv_ingest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as two CSV loads, the first of them run twice: the target holds each row once."""
    root = _scratch(spark, "tidewater-ingest")
    sup = _samples(spark, sf_dir)
    early = F.col("s_nationkey") < 12
    for name, part in (("a", sup.where(early)), ("b", sup.where(~early))):
        part.drop("s_nationkey").write.option("header", "true").csv(f"{root}/{name}")
    for name in ("a", "a", "b"):
        csv_ingest(spark, f"{root}/{name}", f"{root}/target")
    return spark.read.parquet(f"{root}/target").select("id", "name", "amount")


def csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as one CSV load of files whose headers name the columns in different orders."""
    root = _scratch(spark, "tidewater-reordered")
    sup = _samples(spark, sf_dir)
    early = F.col("s_nationkey") < 12
    for rows, columns in ((sup.where(early), ["id", "name", "amount"]), (sup.where(~early), ["amount", "id", "name"])):
        rows.select(*columns).write.mode("append").option("header", "true").csv(f"{root}/in")
    csv_ingest(spark, f"{root}/in", f"{root}/target")
    return spark.read.parquet(f"{root}/target").select("id", "name", "amount")


def dq_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's metrics after each of three loads of suppliers, the second of them run twice."""
    root = _scratch(spark, "tidewater-running")
    sup = _samples(spark, sf_dir).withColumn("id", F.when(F.col("id") % 7 != 0, F.col("id")))
    rows = []
    for load in (0, 1, 1, 2):
        sup.where(F.col("s_nationkey") % 3 == load).drop("s_nationkey").write.mode("overwrite").option("header", "true").csv(f"{root}/in{load}")
        now = csv_ingest(spark, f"{root}/in{load}", f"{root}/target", load_id=f"load{load}")
        rows.append((load, now.total_count, now.null_count, now.route))
    return spark.createDataFrame(rows, "load int, total_count long, null_count long, route string").distinct()


def file_replaced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as one CSV file that is replaced in place by the next lot; the stream is started four
    times, twice without anything new.  Returns all rows loaded."""
    root = _scratch(spark, "tidewater-replaced")
    sup = _samples(spark, sf_dir)
    files = Files(spark, root)
    for lot in (0, 1):
        sup.where(F.col("s_nationkey") % 2 == lot).drop("s_nationkey").coalesce(1).write.option("header", "true").csv(f"{root}/lot{lot}")
        files.replace(files.matching(f"{root}/lot{lot}/part-*")[0], "incoming/sample.csv")
        for _ in range(2):
            run_replaced_files(spark, files.qualified("incoming"), f"{root}/target")
    return spark.read.parquet(f"{root}/target").select("id", "name", "amount")


def gated_ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as two gated CSV loads; in the second every id is missing, so its rows stay staged."""
    root = _scratch(spark, "tidewater-gated-ingest")
    sup = _samples(spark, sf_dir)
    early = F.col("s_nationkey") < 12
    parts = {"a": sup.where(early), "b": sup.where(~early).withColumn("id", F.lit(None).cast("int"))}
    for name, part in parts.items():
        part.drop("s_nationkey").write.option("header", "true").csv(f"{root}/{name}")
        gated_ingest(spark, f"{root}/{name}", f"{root}/stage", f"{root}/target", max_null_keys=1)
    loaded = spark.read.parquet(f"{root}/target").select("id", "name", "amount", F.lit("target").alias("place"))
    return loaded.unionByName(spark.read.parquet(f"{root}/stage").select("id", "name", "amount", F.lit("stage").alias("place")))


def csv_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through a CSV landing: line breaks, outer blanks, quotes, empty and NULL values,
    microseconds.  What is staged equals what was extracted."""
    k = F.col("doc_id") % 6
    note = (
        F.when(k == 0, F.concat(F.lit("  "), F.col("text"), F.lit(" \t")))
        .when(k == 1, F.concat(F.lit('"'), F.col("text"), F.lit('", ""x""')))
        .when(k == 2, F.lit(""))
        .when(k == 3, F.lit(None).cast("string"))
        .when(k == 4, F.concat(F.col("text"), F.lit("\r\n, \r end\n")))
        .otherwise(F.col("text"))
    )
    ts = F.timestamp_micros(F.col("doc_id") * 7_919_000_001).cast("timestamp_ntz")
    rows = _t(spark, sf_dir, "documents").select("doc_id", note.alias("note"), ts.alias("updated_at"), F.col("lang"))
    path = _scratch(spark, "tidewater-landing")
    write_landing(rows, path, fmt="csv")
    return read_stage_csv(spark, path, rows.schema, multiline=True)


def extract_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events above the mark of a load of the month's first half, and a day further back."""
    events = _t(spark, sf_dir, "events")
    prior = events.where(F.col("ts") < F.lit(EVENTS_PRIOR_CUTOFF).cast("timestamp_ntz"))
    hwm = high_water_mark(prior, "events", "ts").first()["max_updated"]
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return extract(events, LoadPlan("delta"), hwm, columns, column="ts", overlap=dt.timedelta(days=1))


# --- small transforms ---------------------------------------------------------------------


def order_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_totals(_t(spark, sf_dir, "events"), "props", ["event_type"])


def calendar_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar_activity(_t(spark, sf_dir, "orders"), day_activity(spark))


def weekend_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekend_split(_t(spark, sf_dir, "orders"))


def invitation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invitations(_t(spark, sf_dir, "nation"), ["n_nationkey", "n_name"])


QUERIES = {
    "extract_full": extract_full,
    "extract_delta_events": extract_delta_events,
    "extract_delta_ties": extract_delta_ties,
    "high_water_mark": high_water_mark_q,
    "hwm_upsert": hwm_upsert,
    "hwm_upsert_all": hwm_upsert_all,
    "full_transform": full_transform,
    "full_transform_all": full_transform,
    "delta_transform_literal": delta_transform_literal,
    "delta_transform_corrected": delta_transform_corrected,
    "latest_per_key": latest_per_key_q,
    "children_latest": children_latest,
    "scd2_close": scd2_close,
    "scd2_new_versions": scd2_new_versions,
    "scd2_new_keys": scd2_new_keys,
    "scd2_literal": scd2_literal,
    "scd2_corrected": scd2_corrected,
    "full_load_refresh": full_load_refresh,
    "soft_delete_literal": soft_delete_literal,
    "soft_delete_corrected": soft_delete_corrected,
    "hard_delete_literal": hard_delete_literal,
    "hard_delete_corrected": hard_delete_corrected,
    "scd2_as_of": scd2_as_of,
    "pipeline_corrected": pipeline_corrected,
    "pipeline_literal": pipeline_literal,
    "dq_metrics": dq_metrics,
    "dq_gate": dq_gate,
    "gated_append": gated_append,
    "file_arrival_ingest": file_arrival_ingest,
    "order_total": order_total,
    "calendar_activity": calendar_activity,
    "invitation_text": invitation_text,
    "file_arrival_gated": file_arrival_gated,
    "csv_ingest_rows": csv_ingest_rows,
    "gated_ingest_files": gated_ingest_files,
    "csv_landing_roundtrip": csv_landing_roundtrip,
    "extract_overlap": extract_overlap,
    "weekend_split": weekend_split,
    "as_of_pruned": as_of_pruned,
    "late_parent": late_parent,
    "children_fanout_literal": children_fanout_literal,
    "children_reduced_corrected": children_reduced_corrected,
    "deleted_entries_delta": deleted_entries_delta,
    "csv_reordered": csv_reordered,
    "dq_running": dq_running,
    "file_replaced_stream": file_replaced_stream,
}
