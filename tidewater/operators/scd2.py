"""Type-2 merge of candidate versions ("temp") into the dimension.

Literal mode reproduces the source system's three sequential statements
(close changed -> insert new versions -> insert new keys), each seeing the previous one's
effect, as successive DataFrames T0 -> T1 -> T2 -> T3.  ``UPDATE … FROM`` becomes a
projection over a left join with a per-id aggregate of the source (no fan-out, duplicates of
the target kept as they are).

Corrected mode classifies each staged id once (a delta-sized table); current rows then pass
through one left join with the ids to close, and closed history passes through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scd import CLOSED, CURRENT, RunContext, attribute_hash, close_when
from ..schemas import DIMENSION_COLUMNS
from ..session import materialize
from .latest import latest_per_key
from .transform import classify_corrected


def _hash(prefix: str = ""):
    return attribute_hash(F.col(prefix + "name"), F.col(prefix + "address"), F.col(prefix + "payment_method"))


def close_changed(target: DataFrame, temp: DataFrame, run: RunContext) -> DataFrame:
    """Statement 1: close current rows whose attribute hash differs from some temp row of the same id.

    A target row is hit iff its hash is non-NULL and the set of non-NULL temp hashes of its id
    contains a value different from it, i.e. min or max of that set differs.  NULL hashes never
    compare unequal (the source's NULL semantics, kept on purpose).
    """
    stats = temp.groupBy("id").agg(F.min(_hash()).alias("_hmin"), F.max(_hash()).alias("_hmax"))
    h = _hash()
    j = target.join(stats, "id", "left")
    hit = (F.col("etl_current_ind") == CURRENT) & h.isNotNull() & ((F.col("_hmin") != h) | (F.col("_hmax") != h))
    return j.select(*close_when(hit, run))


def close_ids(target: DataFrame, ids: DataFrame, run: RunContext) -> DataFrame:
    """Close every current row whose id is in ``ids`` (UPDATE … FROM ids WHERE tgt.id = src.id)."""
    flagged = ids.select("id").distinct().withColumn("_hit", F.lit(True))
    j = target.join(flagged, "id", "left")
    return j.select(*close_when((F.col("etl_current_ind") == CURRENT) & F.col("_hit"), run))


def new_versions(t1: DataFrame, temp: DataFrame, run: RunContext) -> DataFrame:
    """Statement 2: temp rows whose hash differs from the latest closed row of their id in ``t1``."""
    last_closed = latest_per_key(
        t1.where(F.col("etl_current_ind") == CLOSED).join(temp.select("id"), "id", "left_semi"),
        "id",
        ["etl_timestamp", "etl_start_date", "etl_key"],
    ).select("id", _hash().alias("_tgt_hash"))
    j = temp.join(last_closed, "id", "inner").where(_hash() != F.col("_tgt_hash"))
    return j.select(*[F.col(c) for c in DIMENSION_COLUMNS if c != "etl_timestamp"], run.ts().alias("etl_timestamp"))


def new_keys(target: DataFrame, temp: DataFrame, run: RunContext) -> DataFrame:
    """Statement 3: temp rows whose id does not occur in the target at all.

    Stored ids are first cut to the temp's: against a delta small enough to broadcast, the
    dimension's ids are scanned and never shuffled, and the anti join has two delta-sized sides.
    """
    known = target.select("id").join(temp.select("id").distinct(), "id", "left_semi").distinct()
    j = temp.join(known, "id", "left_anti")
    return j.select(*[F.col(c) for c in DIMENSION_COLUMNS if c != "etl_timestamp"], run.ts().alias("etl_timestamp"))


def split(target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current rows, closed history) of a dimension."""
    is_cur = F.col("etl_current_ind").eqNullSafe(CURRENT)
    return target.where(is_cur), target.where(~is_cur)


def merge_literal_rows(
    current: DataFrame, history: DataFrame, temp: DataFrame, run: RunContext, extra_close=None
) -> DataFrame:
    """The three statements on a split dimension.

    Returns the rows a run writes: every current row (closed where statement 1 closed it)
    plus the rows statements 2 and 3 insert.  History is only read:

    * statement 1 closes current rows (one pass over them, joined with per-id temp statistics);
      ``extra_close(t)`` (delete recipes) runs right after it;
    * statement 2 needs the latest closed row of each temp id: history and the rows closed
      now, both restricted to temp ids first (closing is row-local given the statistics);
    * statement 3 needs the ids present after statement 2, which are the ids already stored
      (closing keeps ids, new versions reuse existing ids): a key-only anti-join.
    """

    def close(t: DataFrame) -> DataFrame:
        t1 = close_changed(t, temp, run)
        return extra_close(t1) if extra_close is not None else t1

    ids = temp.select("id")
    closed_slice = history.join(ids, "id", "left_semi").unionByName(close(current.join(ids, "id", "left_semi")))
    stored_ids = current.select("id").unionByName(history.select("id"))
    return (
        close(current)
        .unionByName(new_versions(closed_slice, temp, run))
        .unionByName(new_keys(stored_ids, temp, run))
    )


def merge_literal(target: DataFrame, temp: DataFrame, run: RunContext, extra_close=None) -> DataFrame:
    """The three statements in order over a whole dimension (see ``merge_literal_rows``).

    Target and temp are read several times each: write both (``session.materialize``) where they
    come from an earlier merge, or the plan grows by that factor with each one."""
    current, history = split(target)
    return history.unionByName(merge_literal_rows(current, history, temp, run, extra_close))


def soft_delete_close(customer_stage: DataFrame, run: RunContext):
    """Close-step of the soft-delete recipe: close current rows of staged rows with deleted_at set."""
    deleted = customer_stage.where(F.col("deleted_at").isNotNull()).select("id")
    return lambda t: close_ids(t, deleted, run)


def hard_delete_ids_literal(deleted_entries: DataFrame, customer_stage: DataFrame) -> DataFrame:
    """Ids the hard-delete recipe closes as written: deleted customers that are also in the delta stage."""
    de = deleted_entries.where(F.col("table_name") == "customer").select(F.col("table_id"))
    return de.join(customer_stage.select("id"), de.table_id == customer_stage.id, "inner").select(customer_stage.id)


def hard_delete_ids(deleted_entries: DataFrame) -> DataFrame:
    """Corrected hard-delete ids: every ``table_id`` logged for the customer table."""
    return deleted_entries.where(F.col("table_name") == "customer").select(F.col("table_id").alias("id"))


def hard_delete_close(ids: DataFrame, run: RunContext):
    return lambda t: close_ids(t, ids, run)


def apply_corrected(current: DataFrame, classified: DataFrame, run: RunContext, deleted_ids: DataFrame | None = None) -> DataFrame:
    """The rows a run writes from a corrected classification (``classify_corrected``).

    Every current row passes once through a left join with the de-duplicated ids to close
    (delta-sized: AQE broadcasts it when it is small, so the current rows are not shuffled);
    the new versions come from the classification itself.
    """
    to_close = classified.where("_close").select("id")
    if deleted_ids is not None:
        to_close = to_close.unionByName(deleted_ids.select("id"))
    return close_ids(current, to_close, run).unionByName(classified.where("_insert").select("_new.*"))


def merge_corrected_rows(
    current: DataFrame,
    history: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    payment: DataFrame,
    run: RunContext,
    deleted_ids: DataFrame | None = None,
) -> DataFrame:
    """Corrected type-2 merge: every current row (closed where its id changed or was deleted)
    plus the new versions.

    The classification (delta-sized) is read twice, so it is written first.  That also ends its
    lineage: a merge of a merge plans the earlier one's joins only once, and its union never
    lines up sides whose partition numbers differ."""
    cls = materialize(classify_corrected(customer, address, payment, current, history, run, deleted_ids))
    return apply_corrected(current, cls, run, deleted_ids)


def merge_corrected(
    target: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    payment: DataFrame,
    run: RunContext,
    deleted_ids: DataFrame | None = None,
) -> DataFrame:
    """Corrected type-2 merge over a whole dimension (see ``merge_corrected_rows``)."""
    current, history = split(target)
    return history.unionByName(merge_corrected_rows(current, history, customer, address, payment, run, deleted_ids))


def full_refresh(temp: DataFrame) -> DataFrame:
    """Full load: the new target is exactly temp (history is replaced by design)."""
    return temp.select(*DIMENSION_COLUMNS)
