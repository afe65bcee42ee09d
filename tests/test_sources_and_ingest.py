"""Extraction, watermarks, CSV ingest with the gate, file-arrival streaming, small transforms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators.quality import dq_metrics, route
from tidewater.operators.reporting import order_totals
from tidewater.operators.watermark import (
    LoadConfigError,
    LoadPlan,
    MissingWatermarkError,
    high_water_mark,
    resolve_load,
    upsert_watermarks,
)
from tidewater.plans.fixtures import run_of_day
from tidewater.plans.ingest import csv_ingest, gated_append, gated_ingest
from tidewater.plans.pipeline import customer_pipeline
from tidewater.schemas import SAMPLE, SOURCE_SCHEMAS, WATERMARK
from tidewater.sources.csv_io import read_stage_csv, write_landing
from tidewater.sources.extract import extract, read_jdbc, source_exists
from tidewater.sources.table_store import DimensionStore
from tidewater.sources.inline import SAMPLE_ORDERS_JSON, json_documents
from tidewater.functions.text import map_value_sum, money_text
from tidewater.streaming.file_ingest import run_file_ingest


def test_resolve_load():
    assert resolve_load("full").is_full
    assert not resolve_load("delta", "scheduled").is_full
    with pytest.raises(LoadConfigError):
        resolve_load("full", "scheduled")
    with pytest.raises(LoadConfigError):
        resolve_load("weekly")
    with pytest.raises(LoadConfigError):
        resolve_load(None)


def test_delta_extract_is_strict_and_pushed_down(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hwm = orders.agg(F.max("o_orderdate")).first()[0]
    delta = extract(orders, LoadPlan("delta"), hwm, ["o_orderkey", "o_orderdate"], column="o_orderdate")
    assert delta.count() == 0  # rows equal to the mark are not re-read
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    with pytest.raises(MissingWatermarkError):
        extract(orders, LoadPlan("delta"), None)
    assert extract(orders, LoadPlan("full")).count() == orders.count()


def test_watermark_upsert_keeps_old_mark_on_empty_delta(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    old = spark.createDataFrame([("a", t0), ("b", t0)], WATERMARK)
    empty = spark.createDataFrame([], "updated_at timestamp_ntz")
    new = high_water_mark(spark.createDataFrame([(t1,)], "updated_at timestamp_ntz"), "a").unionByName(
        high_water_mark(empty, "b")
    ).unionByName(high_water_mark(spark.createDataFrame([(t1,)], "updated_at timestamp_ntz"), "c"))
    got = {r.table_name: r.max_updated for r in upsert_watermarks(old, new).collect()}
    assert got == {"a": t1, "b": t0, "c": t1}


def test_source_exists(spark, tmp_path):
    assert not source_exists(spark, str(tmp_path / "missing.csv"))
    p = tmp_path / "x.csv"
    p.write_text("id,name,amount\n1,a,1.0\n")
    assert source_exists(spark, str(p))


def _sample_csv(path, rows):
    path.write_text("id,name,amount\n" + "".join(f"{'' if i is None else i},{n},{a}\n" for i, n, a in rows))


def test_csv_ingest_and_metrics(spark, tmp_path):
    src = tmp_path / "sample.csv"
    _sample_csv(src, [(1, "a", 1.5), (None, "b", 2.0), (3, "c", 2.5)])
    target = str(tmp_path / "sample")
    g = csv_ingest(spark, str(src), target)
    assert (g.total_count, g.null_count, g.route) == (3, 1, "load_target")
    g = csv_ingest(spark, str(src), target)  # the same load again leaves the target as it is
    assert g.total_count == 3
    _sample_csv(src, [(4, "d", 1.5), (5, "a longer name", 2.0)])  # replaced in place: a load of its own
    assert csv_ingest(spark, str(src), target).total_count == 5
    assert csv_ingest(spark, str(src), target, load_id="named").total_count == 7
    assert csv_ingest(spark, str(tmp_path / "nope.csv"), target) is None


def test_gated_ingest_routes(spark, tmp_path):
    src = tmp_path / "sample.csv"
    _sample_csv(src, [(None, f"n{i}", 1.0) for i in range(10)] + [(1, "a", 1.0)])
    target = str(tmp_path / "sample")
    g = gated_ingest(spark, str(src), str(tmp_path / "stage"), target)
    assert g.route == "notify" and not source_exists(spark, target)
    _sample_csv(src, [(1, "a", 1.0), (2, "b", 2.0)])
    # literal check: the source system measured the (still empty) target before loading
    assert gated_ingest(spark, str(src), str(tmp_path / "stage"), target, check="target").route == "notify"
    g = gated_ingest(spark, str(src), str(tmp_path / "stage"), target)
    assert g.route == "load_target" and spark.read.parquet(target).count() == 2


def test_gate_metrics_on_empty_input(spark):
    empty = spark.createDataFrame([], SAMPLE)
    m = route(dq_metrics(empty, "id", "t")).first()
    assert (m.total_count, m.null_count, m.route) == (0, None, "notify")
    sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    out, gate = gated_append(sup.where("s_nationkey >= 12"), sup.where("s_nationkey < 12"), key="s_suppkey")
    assert gate.route == "load_target" and out.count() == sup.where("s_nationkey is not null").count()


def test_file_arrival_stream_is_incremental_and_idempotent(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    target, ckpt = str(tmp_path / "sample"), str(tmp_path / "ckpt")
    _sample_csv(incoming / "sample-1.csv", [(1, "a", 1.0), (2, "b", 2.0)])
    run_file_ingest(spark, str(incoming), target, checkpoint=ckpt)
    assert spark.read.parquet(target).count() == 2
    run_file_ingest(spark, str(incoming), target, checkpoint=ckpt)  # nothing new: no batch
    assert spark.read.parquet(target).count() == 2
    _sample_csv(incoming / "sample-2.csv", [(3, "c", 3.0)])
    _sample_csv(incoming / "sample-3.csv", [(None, f"x{i}", 0.0) for i in range(12)])
    (incoming / "sample-4.csv").write_text('id,name,amount\n4,"",4.0\n5,e,zz\n')
    run_file_ingest(spark, str(incoming), target, checkpoint=ckpt)
    # the files came together; each is judged by itself, and what is refused is kept
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    refused = spark.read.parquet(target + "_refused")
    assert refused.count() == 14 and refused.where("_corrupt_record is not null").count() == 1
    gates = {r._source_file[-12:]: r.route for r in spark.read.parquet(target + "_gate").collect()}
    assert gates == {"sample-1.csv": "load_target", "sample-2.csv": "load_target", "sample-3.csv": "notify", "sample-4.csv": "notify"}


def test_file_arrival_stream_goes_on_in_another_session(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    target = str(tmp_path / "sample")
    _sample_csv(incoming / "one.csv", [(1, "a", 1.0), (2, "", 2.0)])
    run_file_ingest(spark, str(incoming), target)
    _sample_csv(incoming / "two.csv", [(3, "c", 3.0)])
    run_file_ingest(spark.newSession(), str(incoming), target)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_landings_keep_every_value(spark, tmp_path):
    rows = [(1, "  bob ", dt.datetime(2024, 1, 1, 1, 2, 3, 123456)), (2, "", None), (3, None, dt.datetime(2024, 1, 1)), (4, 'a "b", \r\n c\n', dt.datetime(1999, 12, 31, 23, 59, 59, 1))]
    df = spark.createDataFrame(rows, "id int, name string, updated_at timestamp_ntz")
    write_landing(df, str(tmp_path / "x"), fmt="csv")
    got = read_stage_csv(spark, str(tmp_path / "x"), df.schema, multiline=True)
    assert sorted(map(tuple, got.collect())) == rows


@pytest.mark.parametrize("mode", ["literal", "corrected"])
@pytest.mark.parametrize("landing", ["csv", "parquet"])
def test_a_day_without_changes_stages_and_adds_nothing(spark, tmp_path, mode, landing):
    t = lambda h: dt.datetime(2024, 1, 1, h, 2, 3, 123456)
    base = {
        "customer": spark.createDataFrame([(1, " ann ", t(1), t(1)), (2, "bob", t(1), t(2))], SOURCE_SCHEMAS["customer"]),
        "customer_address": spark.createDataFrame([(10, 1, "a\nst", t(1), t(1)), (11, 2, "b", t(1), t(1))], SOURCE_SCHEMAS["customer_address"]),
        "customer_payment": spark.createDataFrame([(20, 1, "x", t(1), t(1)), (21, 2, None, t(1), t(1))], SOURCE_SCHEMAS["customer_payment"]),
    }
    store = DimensionStore(spark, str(tmp_path / "store"))
    work = str(tmp_path / "work")
    customer_pipeline(spark, store, base, "full", run_of_day(1), mode=mode, workdir=work, landing_format=landing)
    before = sorted(map(str, store.dimension().collect()))
    for day in (2, 3):
        customer_pipeline(spark, store, base, "delta", run_of_day(day), mode=mode, workdir=work, landing_format=landing)
        assert [spark.read.parquet(f"{work}/stage/{t}").count() for t in base] == [0, 0, 0]
        assert sorted(map(str, store.dimension().collect())) == before


def test_overlap_reads_further_back(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hwm = orders.agg(F.max("o_orderdate")).first()[0]
    some = extract(orders, LoadPlan("delta"), hwm, column="o_orderdate", overlap=dt.timedelta(days=30))
    assert some.count() == orders.where(F.col("o_orderdate") >= F.lit(hwm - dt.timedelta(days=30))).count() > 0
    assert "GreaterThanOrEqual(o_orderdate" in some._jdf.queryExecution().executedPlan().toString()


def test_jdbc_ranges_need_their_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", "t", partition_column="id", lower_bound=0)


def test_order_total_of_reference_document(spark):
    df = json_documents(spark, [SAMPLE_ORDERS_JSON])
    r = df.select(map_value_sum(F.col("m")).alias("t")).select(money_text("Total order value is: ", F.col("t")).alias("msg")).first()
    assert r.msg == "Total order value is: 1236.70"


def test_order_totals_per_group(spark):
    ev = spark.createDataFrame([("a", '{"k": 1, "j": 2}'), ("a", '{"k": 3}'), ("b", "{}")], "event_type string, props string")
    got = {r.event_type: (r.n_documents, r.total_order_value) for r in order_totals(ev, "props", ["event_type"]).collect()}
    assert got == {"a": (2, 6.0), "b": (1, 0.0)}
