"""The pipeline's delete paths equal the registered delete queries (which the oracle checks)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.plans import queries as Q
from tidewater.plans.fixtures import Scenario, day_ts, run_of_day
from tidewater.plans.pipeline import customer_pipeline
from tidewater.schemas import DIMENSION_COLUMNS
from tidewater.sources.table_store import DimensionStore


def _delete_log(sc, d):
    """The delete log as the source holds it on day d: one unrelated entry from day 1, the
    customer / payment deletions from day 3."""
    first = sc.base.limit(1).select(
        F.lit(0).cast("long").alias("id"), F.lit("orders").alias("table_name"), F.lit(0).cast("long").alias("table_id"),
        day_ts(1).alias("created_at"), day_ts(1).alias("updated_at"),
    )
    return first if d < 3 else first.unionByName(sc.deleted_entries())


@pytest.mark.parametrize("mode", ["corrected", "literal"])
@pytest.mark.parametrize("deletes", ["soft", "hard"])
def test_pipeline_delete_paths(spark, tmp_path, mode, deletes):
    sc = Scenario(spark, SF_SMALL, deletes=True)
    store = DimensionStore(spark, str(tmp_path / "dim"))
    for d in (1, 2, 3):
        sources = {t: sc.oltp(t, d) for t in Scenario.TABLES}
        if deletes == "hard":
            sources["deleted_entries"] = _delete_log(sc, d)
        # Soft deletes only need the customer table; the delete log is synced from day 1 so
        # that its delta extract has a stored mark (a delta without one is refused).
        customer_pipeline(
            spark, store, sources, "full" if d == 1 else "delta", run_of_day(d), mode=mode,
            deletes=deletes if (d == 3 or deletes == "hard") else None,
        )
    got = sorted(store.dimension().select(*DIMENSION_COLUMNS).collect())
    want = sorted(getattr(Q, f"{deletes}_delete_{mode}")(spark, SF_SMALL).select(*DIMENSION_COLUMNS).collect())
    assert got == want
