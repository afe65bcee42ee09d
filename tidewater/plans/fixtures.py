"""Deterministic operational-source snapshots derived from the driver's test tables.

The customer sync needs three source tables (customer, customer_address, customer_payment)
that change from day to day.  They are derived from ``customer`` and ``nation`` by fixed
rules on the customer key ``k`` (every customer takes part; the rules decide *what*
changes, never which rows are read):

* day 1 — customers with k % 20 != 0; address = nation name; payment = market segment,
  missing for k % 17 = 0.
* day 2 — customers with k % 20 = 0 arrive in all three tables.  Among the others:
  name + ' II' for k % 23 = 0; address + '_v2' for k % 7 = 0 and a no-op touch for
  k % 13 = 0; payment 'CASH' for k % 11 = 0 (k % 187 = 0 thereby gains its first payment);
  k % 29 = 0 changes all three (' III', '_v9', 'CARD').
* day 3 — address + '_v3' for k % 62 = 0, no-op touch of k % 7 = 0 addresses; payment 'WIRE'
  for existing payment rows with k % 41 = 0.  With deletes: customers k % 31 = 0 are
  soft-deleted (deleted_at set), and the delete log lists customers k % 37 = 0 plus
  payment rows of k % 43 = 0.

Rows changed on day d carry ``updated_at = 2024-01-0d 00:00:00``; the load of day d runs at
06:00 that day.  Stages are real incremental extracts: ``updated_at`` above the previous
day's high-water mark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scd import RunContext
from ..operators.watermark import LoadPlan, high_water_mark
from ..sources.extract import SOURCE_COLUMNS, extract

ADDRESS_ID_OFFSET = 1_000_000
PAYMENT_ID_OFFSET = 2_000_000
DELETE_LOG_ID_OFFSET = 3_000_000


def day_ts(d: int) -> Column:
    return F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp_ntz")


def run_of_day(d: int) -> RunContext:
    return RunContext.at(dt.datetime(2024, 1, d, 6, 0, 0))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("k"), "c_name", "n_name", "c_mktsegment"
    )


def _k(m: int) -> Column:
    return F.col("k") % m == 0


def oltp_customer(b: DataFrame, d: int, soft_delete: bool = False) -> DataFrame:
    new2 = _k(20)
    if d == 1:
        out = b.where(~new2).select(
            F.col("k").alias("id"), F.col("c_name").alias("name"), day_ts(1).alias("created_at"), day_ts(1).alias("updated_at")
        )
    else:
        name = (
            F.when(~new2 & _k(29), F.concat("c_name", F.lit(" III")))
            .when(~new2 & _k(23), F.concat("c_name", F.lit(" II")))
            .otherwise(F.col("c_name"))
        )
        upd = F.when(new2 | _k(29) | _k(23), day_ts(2)).otherwise(day_ts(1))
        out = b.select(
            F.col("k").alias("id"),
            name.alias("name"),
            F.when(new2, day_ts(2)).otherwise(day_ts(1)).alias("created_at"),
            upd.alias("updated_at"),
        )
    if soft_delete:
        gone = F.lit(d >= 3) & (F.col("id") % 31 == 0)
        out = out.withColumn("updated_at", F.when(gone, day_ts(3)).otherwise(F.col("updated_at"))).withColumn(
            "deleted_at", F.when(gone, day_ts(3))
        )
    return out


def oltp_address(b: DataFrame, d: int) -> DataFrame:
    new2 = _k(20)
    nm = F.col("n_name")
    addr2 = (
        F.when(new2, nm)
        .when(_k(29), F.concat(nm, F.lit("_v9")))
        .when(_k(7), F.concat(nm, F.lit("_v2")))
        .otherwise(nm)
    )
    upd2 = F.when(new2 | _k(29) | _k(7) | _k(13), day_ts(2)).otherwise(day_ts(1))
    if d == 1:
        rows, addr, upd = b.where(~new2), nm, day_ts(1)
    elif d == 2:
        rows, addr, upd = b, addr2, upd2
    else:
        rows = b
        addr = F.when(_k(62), F.concat(nm, F.lit("_v3"))).otherwise(addr2)
        upd = F.when(_k(62) | _k(7), day_ts(3)).otherwise(upd2)
    return rows.select(
        (F.col("k") + ADDRESS_ID_OFFSET).alias("id"),
        F.col("k").alias("cust_id"),
        addr.alias("address"),
        F.when(new2, day_ts(2)).otherwise(day_ts(1)).alias("created_at"),
        upd.alias("updated_at"),
    )


def oltp_payment(b: DataFrame, d: int) -> DataFrame:
    new2 = _k(20)
    seg = F.col("c_mktsegment")
    pm2 = F.when(new2, seg).when(_k(29), F.lit("CARD")).when(_k(11), F.lit("CASH")).otherwise(seg)
    upd2 = F.when(new2 | _k(29) | _k(11), day_ts(2)).otherwise(day_ts(1))
    if d == 1:
        rows, pm, upd = b.where(~new2 & ~_k(17)), seg, day_ts(1)
    else:
        rows = b.where(new2 | ~_k(17) | _k(11) | _k(29))
        if d == 2:
            pm, upd = pm2, upd2
        else:
            pm = F.when(_k(41), F.lit("WIRE")).otherwise(pm2)
            upd = F.when(_k(41), day_ts(3)).otherwise(upd2)
    return rows.select(
        (F.col("k") + PAYMENT_ID_OFFSET).alias("id"),
        F.col("k").alias("cust_id"),
        pm.alias("payment_method"),
        F.when(new2 | _k(17), day_ts(2)).otherwise(day_ts(1)).alias("created_at"),
        upd.alias("updated_at"),
    )


def deleted_entries(b: DataFrame) -> DataFrame:
    """The delete log on day 3: customers k % 37 = 0 and payment rows of k % 43 = 0."""
    cust = b.where(_k(37)).select(
        (F.col("k") + DELETE_LOG_ID_OFFSET).alias("id"),
        F.lit("customer").alias("table_name"),
        F.col("k").alias("table_id"),
    )
    pay = b.where(_k(43)).select(
        (F.col("k") + 2 * DELETE_LOG_ID_OFFSET).alias("id"),
        F.lit("customer_payment").alias("table_name"),
        (F.col("k") + PAYMENT_ID_OFFSET).alias("table_id"),
    )
    return cust.unionByName(pay).select("*", day_ts(3).alias("created_at"), day_ts(3).alias("updated_at"))


def delete_log(b: DataFrame) -> DataFrame:
    """``deleted_entries`` with an older entry for each customer of an earlier day."""
    log = b.select(F.col("k").alias("id"), F.lit("orders").alias("table_name"), F.col("k").alias("table_id"))
    older = log.select("*", day_ts(2).alias("created_at"), day_ts(2).alias("updated_at"))
    return older.unionByName(deleted_entries(b))


def early_children(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An address and a payment for every customer on day 1, also for those who come on day 2."""
    times = [day_ts(1).alias("created_at"), day_ts(1).alias("updated_at")]
    owner = F.col("k").alias("cust_id")
    address = b.select((F.col("k") + ADDRESS_ID_OFFSET).alias("id"), owner, F.col("n_name").alias("address"), *times)
    payment = b.select((F.col("k") + PAYMENT_ID_OFFSET).alias("id"), owner, F.col("c_mktsegment").alias("payment_method"), *times)
    return address, payment


def two_children(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two addresses and two payments for every customer: the first at k % 3 (k % 2) o'clock, the second at
    one (midnight), so that some tie and the row id decides."""
    k = F.col("k")

    def rows(value: str, *children: tuple[Column, Column]) -> DataFrame:
        out = None
        for i, (said, hour) in enumerate(children):
            at = day_ts(1) + F.make_dt_interval(F.lit(0), hour.cast("int"))
            one = b.select((2 * k + i).alias("id"), k.alias("cust_id"), said.alias(value), at.alias("created_at"), at.alias("updated_at"))
            out = one if out is None else out.unionByName(one)
        return out

    address = rows("address", (F.col("n_name"), k % 3), (F.concat("n_name", F.lit(" annex")), F.lit(1)))
    return address, rows("payment_method", (F.col("c_mktsegment"), k % 2), (F.lit("CASH"), F.lit(0)))


class Scenario:
    """Day-by-day stages of the customer sync over one test-data directory.

    Day 1 is a full extract, later days are delta extracts above the previous stage's
    high-water mark (kept when a delta is empty).
    """

    TABLES = ("customer", "customer_address", "customer_payment")

    def __init__(self, spark: SparkSession, sf_dir: str, deletes: bool = False):
        self.spark = spark
        self.base = base(spark, sf_dir)
        self.deletes = deletes
        self._stages: dict = {}
        self._marks: dict = {}

    def oltp(self, table: str, d: int) -> DataFrame:
        if table == "customer":
            return oltp_customer(self.base, d, soft_delete=self.deletes)
        if table == "customer_address":
            return oltp_address(self.base, d)
        return oltp_payment(self.base, d)

    def marks(self, d: int) -> dict:
        """High-water marks of all three tables after day d's stage, in one job.

        A table whose delta was empty keeps its previous mark.
        """
        if d not in self._marks:
            hwm = None
            for t in self.TABLES:
                m = high_water_mark(self.stage(t, d), t)
                hwm = m if hwm is None else hwm.unionByName(m)
            got = {r["table_name"]: r["max_updated"] for r in hwm.collect()}  # three scalars
            prev = self.marks(d - 1) if d > 1 else {}
            self._marks[d] = {t: got.get(t) if got.get(t) is not None else prev.get(t) for t in self.TABLES}
        return self._marks[d]

    def mark(self, table: str, d: int):
        return self.marks(d)[table]

    def stage(self, table: str, d: int) -> DataFrame:
        """Day d's stage of one table: a full extract on day 1, else a delta above the last mark.

        Stages stay lazy views over the (derived) source: each is a scan with a literal
        predicate that pushes into the Parquet reader.
        """
        key = (table, d)
        if key not in self._stages:
            src = self.oltp(table, d)
            if d == 1:
                st = extract(src, LoadPlan("full"))
            else:
                cols = SOURCE_COLUMNS[table] + (["deleted_at"] if table == "customer" and self.deletes else [])
                st = extract(src, LoadPlan("delta"), self.mark(table, d - 1), cols)
            self._stages[key] = st
        return self._stages[key]

    def stages(self, d: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        return tuple(self.stage(t, d) for t in self.TABLES)

    def deleted_entries(self) -> DataFrame:
        return deleted_entries(self.base)
