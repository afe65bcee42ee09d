"""Plan shape and skew: the properties the design relies on at scale, checked on small data."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.functions.scd import RunContext
from tidewater.operators import scd2, transform
from tidewater.operators.latest import latest_per_key
from tidewater.schemas import DIMENSION

RUN = RunContext.at(dt.datetime(2024, 6, 2, 6))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_shuffle(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = _plan(latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_customer_with_a_third_of_child_rows(spark):
    """One customer owns a third of all staged address rows: the result is still one version,
    and the staged reduction aggregates partially before its shuffle."""
    n_hot, n_other = 30_000, 60_000
    upd = F.lit("2024-06-02 01:00:00").cast("timestamp_ntz")
    addr = (
        spark.range(n_hot + n_other)
        .select(
            (F.col("id") + 1_000_000).alias("id"),
            F.when(F.col("id") < n_hot, F.lit(0)).otherwise(F.col("id") - n_hot + 1).cast("long").alias("cust_id"),
            F.concat(F.lit("addr-"), F.col("id").cast("string")).alias("address"),
            upd.alias("created_at"),
            (upd + F.expr("make_dt_interval(0, 0, 0, id)")).alias("updated_at"),
        )
    )
    customers = spark.range(n_other + 1).select(
        F.col("id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"), upd.alias("created_at"), upd.alias("updated_at")
    )
    payment = addr.limit(0).select("id", "cust_id", F.col("address").alias("payment_method"), "created_at", "updated_at")
    empty = spark.createDataFrame([], DIMENSION)
    out = scd2.merge_corrected(empty, customers, addr, payment, RUN)
    assert out.count() == n_other + 1
    hot = out.where("id = 0").collect()
    assert len(hot) == 1 and hot[0].address == f"addr-{n_hot - 1}"  # the latest of its 30k rows
    plan = _plan(transform.reduce_staged(customers, addr, payment))
    assert "partial_max_by" in plan
