"""High-water marks from footers: the same as by a scan, and no row is read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators.watermark import footer_mark, greatest_in_footers, high_water_mark
from tidewater.sources.csv_io import STAGE_MARK, write_stage


@pytest.mark.parametrize("table, column", [("orders", "o_orderdate"), ("events", "ts"), ("lineitem", "l_shipdate")])
def test_both_ways_agree(spark, tmp_path, table, column):
    rows = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").repartition(3)
    write_stage(rows, str(tmp_path / "s"), mark=column)
    assert footer_mark(spark, str(tmp_path / "s"), STAGE_MARK) == high_water_mark(rows, table, column).first()["max_updated"]


def test_the_aggregate_is_pushed_to_the_footers(spark, tmp_path):
    write_stage(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), str(tmp_path / "s"), mark="o_orderdate")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    plan = greatest_in_footers(spark, str(tmp_path / "s"), STAGE_MARK)._jdf.queryExecution().executedPlan().toString()
    assert f"PushedAggregation: [MAX({STAGE_MARK})]" in plan and f"ReadSchema: struct<max({STAGE_MARK}):bigint>" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    # what footers can't tell is scanned
    scanned = greatest_in_footers(spark, str(tmp_path / "s"), "o_orderdate")
    assert "PushedAggregation: []" in scanned._jdf.queryExecution().executedPlan().toString()
    assert scanned.first()["greatest"] == spark.read.parquet(f"{SF_SMALL}/orders.parquet").agg(F.max("o_orderdate")).first()[0]


def test_empty_stages_nulls_and_microseconds(spark, tmp_path):
    times = [None, dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2023, 5, 5)]
    rows = spark.createDataFrame([(t,) for t in times], "updated_at timestamp_ntz")
    for name, some, want in (("all", rows, times[2]), ("old", rows.where("updated_at < '1970-01-01'"), times[1]), ("null", rows.where("updated_at is null"), None), ("none", rows.where("false"), None)):
        write_stage(some, str(tmp_path / name))
        assert footer_mark(spark, str(tmp_path / name), STAGE_MARK) == want, name
