"""The four-day customer scenario through the whole pipeline, both modes (FIXTURES.md §4)."""

import datetime as dt

import pytest

from tidewater.functions.scd import RunContext
from tidewater.plans.pipeline import customer_pipeline
from tidewater.schemas import CUSTOMER, CUSTOMER_ADDRESS, CUSTOMER_PAYMENT
from tidewater.sources.table_store import DimensionStore

D = {d: dt.datetime(2024, 3, d, 10, 0, 0) for d in range(1, 5)}  # change times
RUN = {d: RunContext.at(dt.datetime(2024, 3, d, 23, 0, 0)) for d in range(1, 5)}
DAY = {d: dt.date(2024, 3, d) for d in range(1, 5)}
OPEN = dt.date(9999, 12, 31)


def oltp_state(day):
    """Rows of the three source tables at the end of ``day`` (id -> row)."""
    cust = {111: ("Manmeet", 1, 1), 112: ("Jaideep", 1, 1)}
    addr = {123: (111, "my_address_1", 1, 1), 124: (112, "his_address_1", 1, 1)}
    pay = {321: (111, "visa", 1, 1), 322: (112, "amex", 1, 1)}
    if day >= 2:
        cust[113] = ("Jasmeher", 2, 2)
        addr[125] = (113, "her_address_1", 2, 2)
        pay[323] = (113, "mastercard", 2, 2)
        addr[123] = (111, "my_address_2", 1, 2)
    if day >= 3:
        addr[124] = (112, "his_address_1", 1, 3)
        pay[321] = (111, "mastercard", 1, 3)
    if day >= 4:
        addr[125] = (113, "her_address_2", 2, 4)
        cust[114] = ("Nivi", 4, 4)
        addr[126] = (114, "her_address", 4, 4)
        pay[324] = (114, "one", 4, 4)
    return (
        [(k, n, D[c], D[u]) for k, (n, c, u) in cust.items()],
        [(k, cid, a, D[c], D[u]) for k, (cid, a, c, u) in addr.items()],
        [(k, cid, p, D[c], D[u]) for k, (cid, p, c, u) in pay.items()],
    )


GOLDEN = {
    (111, "Manmeet", "my_address_1", "visa", DAY[1], DAY[1], "N", DAY[2]),
    (111, "Manmeet", "my_address_2", "visa", DAY[2], DAY[2], "N", DAY[3]),
    (111, "Manmeet", "my_address_2", "mastercard", DAY[3], OPEN, "Y", DAY[3]),
    (112, "Jaideep", "his_address_1", "amex", DAY[1], OPEN, "Y", DAY[1]),
    (113, "Jasmeher", "her_address_1", "mastercard", DAY[2], DAY[3], "N", DAY[4]),
    (113, "Jasmeher", "her_address_2", "mastercard", DAY[4], OPEN, "Y", DAY[4]),
    (114, "Nivi", "her_address", "one", DAY[4], OPEN, "Y", DAY[4]),
}


def _rows(df):
    return {
        (r.id, r.name, r.address, r.payment_method, r.etl_start_date, r.etl_end_date, r.etl_current_ind, r.etl_timestamp.date())
        for r in df.collect()
    }


@pytest.mark.parametrize("mode", ["literal", "corrected"])
@pytest.mark.parametrize("landing", ["csv", "parquet"])
def test_four_day_scenario(spark, tmp_path, mode, landing):
    store = DimensionStore(spark, str(tmp_path / "dim"))
    for day in range(1, 5):
        c, a, p = oltp_state(day)
        sources = {
            "customer": spark.createDataFrame(c, CUSTOMER),
            "customer_address": spark.createDataFrame(a, CUSTOMER_ADDRESS),
            "customer_payment": spark.createDataFrame(p, CUSTOMER_PAYMENT),
        }
        res = customer_pipeline(
            spark, store, sources, "full" if day == 1 else "delta", RUN[day], mode=mode, landing_format=landing
        )
        assert res.commit.run == day
    dim = store.dimension()
    assert dim.count() == 7
    assert _rows(dim) == GOLDEN
    marks = {r.table_name: r.max_updated for r in store.watermarks().collect()}
    assert marks == {"customer": D[4], "customer_address": D[4], "customer_payment": D[4]}


def test_failed_run_does_not_advance_watermark(spark, tmp_path):
    """Data and marks commit together: a run that fails before its commit leaves the store as it was."""
    store = DimensionStore(spark, str(tmp_path / "dim"))
    c, a, p = oltp_state(1)
    src = {
        "customer": spark.createDataFrame(c, CUSTOMER),
        "customer_address": spark.createDataFrame(a, CUSTOMER_ADDRESS),
        "customer_payment": spark.createDataFrame(p, CUSTOMER_PAYMENT),
    }
    customer_pipeline(spark, store, src, "full", RUN[1])
    before = {r.table_name: r.max_updated for r in store.watermarks().collect()}
    c, a, p = oltp_state(2)
    broken = {
        "customer": spark.createDataFrame(c, CUSTOMER),
        "customer_address": spark.createDataFrame(a, CUSTOMER_ADDRESS),
        # payment source missing -> the run fails after staging the first tables
    }
    with pytest.raises(KeyError):
        customer_pipeline(spark, store, broken, "delta", RUN[2])
    assert {r.table_name: r.max_updated for r in store.watermarks().collect()} == before
    assert store.last_commit().run == 1
    # the retry succeeds and advances everything
    ok = dict(broken, customer_payment=spark.createDataFrame(p, CUSTOMER_PAYMENT))
    customer_pipeline(spark, store, ok, "delta", RUN[2])
    assert store.last_commit().run == 2


def test_full_reload_keeps_backup(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "dim"))
    for day in (1, 2):
        c, a, p = oltp_state(day)
        src = {
            "customer": spark.createDataFrame(c, CUSTOMER),
            "customer_address": spark.createDataFrame(a, CUSTOMER_ADDRESS),
            "customer_payment": spark.createDataFrame(p, CUSTOMER_PAYMENT),
        }
        customer_pipeline(spark, store, src, "full" if day == 1 else "delta", RUN[day])
    before = _rows(store.dimension())
    c, a, p = oltp_state(3)
    src = {
        "customer": spark.createDataFrame(c, CUSTOMER),
        "customer_address": spark.createDataFrame(a, CUSTOMER_ADDRESS),
        "customer_payment": spark.createDataFrame(p, CUSTOMER_PAYMENT),
    }
    res = customer_pipeline(spark, store, src, "full", RUN[3])
    assert _rows(store.backup(res.commit.run)) == before
    after = store.dimension()
    assert after.count() == 3  # history replaced by design: one current row per customer
    assert {r.etl_current_ind for r in after.collect()} == {"Y"}
