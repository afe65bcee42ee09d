"""Staged source tables -> candidate versions of the customer dimension ("temp").

Two modes:

* literal: exactly the source system's statements, including their fan-out and
  duplicate rows (kept for result parity; see README "literal vs corrected").
* corrected: one candidate per customer id, children reduced to their latest row,
  attributes coalesced over the latest stored version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scd import CURRENT, RunContext, any_distinct, new_version_columns
from ..schemas import DIMENSION, DIMENSION_COLUMNS
from ..session import materialize


def _enrich(customer: DataFrame, address: DataFrame, payment: DataFrame) -> DataFrame:
    c, ca, cp = customer.alias("c"), address.alias("ca"), payment.alias("cp")
    return c.join(ca, F.col("c.id") == F.col("ca.cust_id"), "left").join(
        cp, F.col("c.id") == F.col("cp.cust_id"), "left"
    )


def full_transform(
    customer: DataFrame, address: DataFrame, payment: DataFrame, run: RunContext, skip_deleted: bool = False
) -> DataFrame:
    """Staged customer left-joined to its address and payment rows; one new version per joined row.

    ``skip_deleted`` drops customer rows whose ``deleted_at`` is set (soft-delete recipe).
    """
    j = _enrich(customer, address, payment)
    if skip_deleted:
        j = j.where(F.col("c.deleted_at").isNull())
    return j.select(
        *new_version_columns(F.col("c.id"), F.col("c.name"), F.col("ca.address"), F.col("cp.payment_method"), run)
    )


def staged_keys(customer: DataFrame, address: DataFrame, payment: DataFrame) -> DataFrame:
    """Every id touched by the delta (bag; callers use it as a semi-join side)."""
    return (
        customer.select(F.col("id"))
        .unionByName(address.select(F.col("cust_id").alias("id")))
        .unionByName(payment.select(F.col("cust_id").alias("id")))
    )


def changed_current_literal(
    customer: DataFrame, address: DataFrame, payment: DataFrame, target: DataFrame, run: RunContext
) -> DataFrame:
    """Branch (b) of the delta transform: current rows with any staged change, coalesced, distinct.

    The target is first restricted to ids present in the delta (semi-join).  This is exact:
    a current row whose id is in no staged table has all three staged values NULL and
    fails the OR filter anyway; it just never reaches the three outer joins.
    """
    keys = staged_keys(customer, address, payment)
    tgt = target.where(F.col("etl_current_ind") == CURRENT).join(keys, "id", "left_semi").alias("tgt")
    c, ca, cp = customer.alias("c"), address.alias("ca"), payment.alias("cp")
    j = (
        tgt.join(c, F.col("tgt.id") == F.col("c.id"), "left")
        .join(ca, F.col("tgt.id") == F.col("ca.cust_id"), "left")
        .join(cp, F.col("tgt.id") == F.col("cp.cust_id"), "left")
        .where(F.col("ca.address").isNotNull() | F.col("cp.payment_method").isNotNull() | F.col("c.name").isNotNull())
    )
    # etl_key hashes tgt.id; id is coalesce(c.id, tgt.id) which equals tgt.id after the join.
    cols = new_version_columns(
        F.col("tgt.id"),
        F.coalesce(F.col("c.name"), F.col("tgt.name")),
        F.coalesce(F.col("ca.address"), F.col("tgt.address")),
        F.coalesce(F.col("cp.payment_method"), F.col("tgt.payment_method")),
        run,
    )
    cols[1] = F.coalesce(F.col("c.id"), F.col("tgt.id")).alias("id")
    return j.select(*cols).dropDuplicates()


def delta_transform_literal(
    customer: DataFrame,
    address: DataFrame,
    payment: DataFrame,
    target: DataFrame,
    run: RunContext,
    skip_deleted: bool = False,
) -> DataFrame:
    """Bag union of (a) every staged customer enriched by staged children and (b) changed current rows."""
    new_rows = full_transform(customer, address, payment, run, skip_deleted=skip_deleted)
    return new_rows.unionByName(changed_current_literal(customer, address, payment, target, run))


# ----------------------------------------------------------------------------------------------
# corrected mode


def reduce_staged(customer: DataFrame, address: DataFrame, payment: DataFrame) -> DataFrame:
    """One row per customer id holding the latest staged value of each source.

    All three deltas are unioned and aggregated in a single shuffle.  The per-source "latest
    row" is ``max_by`` over (updated_at, row id); the aggregate runs partially on the map side,
    so a customer with millions of child rows still ships one row per map task.

    Columns: id, in_customer, name, deleted, in_child, address, payment_method.
    """
    has_deleted = "deleted_at" in customer.columns
    no_ts = F.lit(None).cast("timestamp_ntz")
    # Order of "latest": updated_at, then (customer) deleted_at and name, (children) row id.
    c = customer.select(
        F.col("id"),
        F.lit("c").alias("src"),
        F.struct(
            F.col("updated_at"),
            (F.col("deleted_at") if has_deleted else no_ts).alias("deleted_at"),
            F.col("name"),
            F.lit(None).cast("long").alias("row_id"),
        ).alias("ord"),
        F.col("name").alias("v"),
        (F.col("deleted_at").isNotNull() if has_deleted else F.lit(False)).alias("del"),
    )

    def child(df: DataFrame, value: str) -> DataFrame:
        return df.select(
            F.col("cust_id").alias("id"),
            F.lit(value[0]).alias("src"),
            F.struct(
                F.col("updated_at"),
                no_ts.alias("deleted_at"),
                F.lit(None).cast("string").alias("name"),
                F.col("id").cast("long").alias("row_id"),
            ).alias("ord"),
            F.col(value).alias("v"),
            F.lit(False).alias("del"),
        )

    a = child(address, "address")
    p = child(payment, "payment_method")
    u = c.unionByName(a).unionByName(p)

    def pick(src: str, col: str):
        return F.max_by(F.col(col), F.when(F.col("src") == src, F.col("ord")))

    return u.groupBy("id").agg(
        F.max(F.col("src") == "c").alias("in_customer"),
        pick("c", "v").alias("name"),
        F.coalesce(pick("c", "del"), F.lit(False)).alias("deleted"),
        F.max(F.col("src") != "c").alias("in_child"),
        pick("a", "v").alias("address"),
        pick("p", "v").alias("payment_method"),
    )


def latest_closed(history: DataFrame, ids: DataFrame) -> DataFrame:
    """Latest closed version of each id in ``ids`` (for re-opened ids): id, _old struct.

    History is semi-joined to the (delta-sized) ids first and reduced with ``max_by``,
    which aggregates partially before its shuffle.
    """
    attrs = F.struct("name", "address", "payment_method")
    order = F.struct(F.col("etl_timestamp"), F.col("etl_start_date"), F.col("etl_key"))
    return history.join(ids, "id", "left_semi").groupBy("id").agg(F.max_by(attrs, order).alias("_old"))


def classify_corrected(
    customer: DataFrame,
    address: DataFrame,
    payment: DataFrame,
    current: DataFrame,
    history: DataFrame,
    run: RunContext,
    deleted_ids: DataFrame | None = None,
) -> DataFrame:
    """The corrected decision for every staged id (a delta-sized table, the corrected "temp").

    The dimension is only touched through semi-joins with the staged ids: their current row
    (at most one per id, the invariant corrected mode maintains) and, for ids without one,
    their latest closed row.

    * candidates: staged customer ids, and staged child ids that have a current row; ids
      soft-deleted in the stage or listed in ``deleted_ids`` are not candidates;
    * new attributes: ``coalesce(staged, latest stored version)``;
    * ``_insert``: candidate that is new, re-opened, or differs from its current row
      (IS DISTINCT FROM, column by column);
    * ``_close``: the id has a current row and is inserted or deleted;
    * ``_orphan``: the id has staged children, but is neither staged, current nor deleted: its
      children have nothing to go to yet (``orphans``).

    Columns: id, ``_new`` (the would-be new version as a struct), ``_insert``, ``_close``, ``_orphan``.
    """
    # One row a touched id, read three times: written once, or each stage is read as often.
    staged = materialize(reduce_staged(customer, address, payment))
    ids = staged.select("id")
    cur = current.join(ids, "id", "left_semi").select("id", F.struct(*DIMENSION_COLUMNS).alias("_row"))
    old = latest_closed(history, ids)
    j = staged.join(cur, "id", "left").join(old, "id", "left")
    gone = F.coalesce(F.col("deleted"), F.lit(False))
    if deleted_ids is not None:
        j = j.join(deleted_ids.select("id").distinct().withColumn("_gone", F.lit(True)), "id", "left")
        gone = gone | F.coalesce(F.col("_gone"), F.lit(False))
    has_cur = F.col("_row").isNotNull()
    staged_key = F.col("in_customer") | (F.col("in_child") & has_cur)
    prev = F.when(has_cur, F.struct(F.col("_row.name"), F.col("_row.address"), F.col("_row.payment_method"))).otherwise(
        F.col("_old")
    )
    name = F.coalesce(F.col("name"), prev.getField("name"))
    address_ = F.coalesce(F.col("address"), prev.getField("address"))
    payment_ = F.coalesce(F.col("payment_method"), prev.getField("payment_method"))
    stored = [F.col("_row.name"), F.col("_row.address"), F.col("_row.payment_method")]
    changed = ~has_cur | any_distinct(list(zip((name, address_, payment_), stored, strict=True)))
    insert = staged_key & ~gone & changed
    return j.select(
        "id",
        F.struct(*new_version_columns(F.col("id"), name, address_, payment_, run)).alias("_new"),
        insert.alias("_insert"),
        (has_cur & (insert | gone)).alias("_close"),
        (~staged_key & ~gone).alias("_orphan"),
    )


def orphans(classified: DataFrame, address: DataFrame, payment: DataFrame) -> DataFrame:
    """The latest staged row of each child table for every id without a customer (``PENDING``).

    A later run adds them to its stage (``with_pending``); one row for each id and table is kept,
    so that they grow with the missing customers only."""
    ids = classified.where("_orphan").select(F.col("id").alias("cust_id"))
    both = [
        child.select(F.lit(name).alias("table_name"), "id", "cust_id", F.col(value).alias("value"), "created_at", "updated_at")
        for name, child, value in (("customer_address", address, "address"), ("customer_payment", payment, "payment_method"))
    ]
    waiting = both[0].unionByName(both[1]).join(ids, "cust_id", "left_semi")
    row = F.struct("updated_at", "id", "created_at", "value")
    return waiting.groupBy("table_name", "cust_id").agg(F.max(row).alias("r")).select("table_name", "r.id", "cust_id", "r.value", "r.created_at", "r.updated_at")


def with_pending(child: DataFrame, table: str, value: str, pending: DataFrame) -> DataFrame:
    """A child table's stage with the rows that wait for their customer; the latest row still wins."""
    waiting = pending.where(F.col("table_name") == table).select("id", "cust_id", F.col("value").alias(value), "created_at", "updated_at")
    return child.select("id", "cust_id", value, "created_at", "updated_at").unionByName(waiting)


def delta_transform_corrected(
    customer: DataFrame,
    address: DataFrame,
    payment: DataFrame,
    target: DataFrame,
    run: RunContext,
    deleted_ids: DataFrame | None = None,
) -> DataFrame:
    """The corrected "temp": one new version per id that is new, re-opened or changed."""
    is_cur = F.col("etl_current_ind").eqNullSafe(CURRENT)
    cls = classify_corrected(customer, address, payment, target.where(is_cur), target.where(~is_cur), run, deleted_ids)
    return cls.where("_insert").select("_new.*")


def classify_full(customer: DataFrame, address: DataFrame, payment: DataFrame, run: RunContext) -> DataFrame:
    """``classify_corrected`` against an empty dimension."""
    empty = customer.sparkSession.createDataFrame([], DIMENSION)
    return classify_corrected(customer, address, payment, empty, empty, run)


def full_transform_corrected(
    customer: DataFrame, address: DataFrame, payment: DataFrame, run: RunContext
) -> DataFrame:
    """Corrected full load: one version per staged customer, children reduced to their latest row."""
    return classify_full(customer, address, payment, run).where("_insert").select("_new.*")
