
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions.scd import RunContext
from tidewater.operators import scd2, transform
from tidewater.schemas import CUSTOMER, CUSTOMER_ADDRESS, CUSTOMER_PAYMENT, CUSTOMER_SOFT_DELETE, DELETED_ENTRIES, DIMENSION
from tidewater.session import materialize
from tidewater.sources.csv_io import read_stage_csv, write_landing
from tidewater.schemas import SAMPLE

D1, D2 = dt.date(2024, 5, 1), dt.date(2024, 5, 2)
T1, T2 = dt.datetime(2024, 5, 1, 6), dt.datetime(2024, 5, 2, 6)
UPD = dt.datetime(2024, 5, 2, 1)
OPEN = dt.date(9999, 12, 31)
RUN2 = RunContext.at(T2)


def dim(spark, rows):
    """rows: (id, name, address, payment, start, end, ind, ts)."""
    return spark.createDataFrame([(f"k{i}{r[0]}", *r) for i, r in enumerate(rows)], DIMENSION)


def stage(spark, customers=(), addresses=(), payments=(), soft=False):
    if soft:
        c = spark.createDataFrame([(i, n, UPD, UPD, d) for i, n, d in customers], CUSTOMER_SOFT_DELETE)
    else:
        c = spark.createDataFrame([(i, n, UPD, UPD) for i, n in customers], CUSTOMER)
    a = spark.createDataFrame([(rid, cid, v, UPD, u or UPD) for rid, cid, v, *rest in addresses for u in [rest[0] if rest else None]], CUSTOMER_ADDRESS)
    p = spark.createDataFrame([(rid, cid, v, UPD, UPD) for rid, cid, v in payments], CUSTOMER_PAYMENT)
    return c, a, p


def literal(spark, target, c, a, p, extra=None, skip_deleted=False):
    temp = transform.delta_transform_literal(c, a, p, target, RUN2, skip_deleted=skip_deleted)
    return scd2.merge_literal(target, temp, RUN2, extra_close=extra(c) if extra else None)


def corrected(target, c, a, p, deleted=None):
    return scd2.merge_corrected(target, c, a, p, RUN2, deleted)


def current(df):
    return sorted((r.id, r.name, r.address, r.payment_method) for r in df.where("etl_current_ind = 'Y'").collect())


def test_n1_null_attribute_can_be_filled(spark):
    t = dim(spark, [(1, "A", None, "visa", D1, OPEN, "Y", T1)])
    c, a, p = stage(spark, addresses=[(11, 1, "addr1")])
    lit = literal(spark, t, c, a, p)
    assert lit.count() == 1 and current(lit) == [(1, "A", None, "visa")]  # hash NULL: never "changed"
    cor = corrected(t, c, a, p)
    assert cor.count() == 2 and current(cor) == [(1, "A", "addr1", "visa")]


def test_n3_noop_touch_after_history(spark):
    t = dim(
        spark,
        [(111, "M", "addr1", "visa", D1, D1, "N", T2), (111, "M", "addr2", "visa", D2, OPEN, "Y", T2)],
    )
    run3 = RunContext.at(dt.datetime(2024, 5, 3, 6))
    c, a, p = stage(spark, addresses=[(123, 111, "addr2")])
    temp = transform.delta_transform_literal(c, a, p, t, run3)
    lit = scd2.merge_literal(t, temp, run3)
    assert len(current(lit)) == 2  # a second current row
    cor = scd2.merge_corrected(t, c, a, p, run3)
    assert cor.count() == 2 and current(cor) == [(111, "M", "addr2", "visa")]


def test_n4_all_three_change_in_one_delta(spark):
    t = dim(spark, [(112, "J", "his1", "amex", D1, OPEN, "Y", T1)])
    c, a, p = stage(spark, customers=[(112, "Jay")], addresses=[(124, 112, "his2")], payments=[(322, 112, "visa")])
    lit = literal(spark, t, c, a, p)
    assert lit.where("etl_current_ind = 'N'").count() == 1
    assert current(lit) == [(112, "Jay", "his2", "visa")] * 2  # two identical current rows
    cor = corrected(t, c, a, p)
    assert cor.where("etl_current_ind = 'N'").count() == 1 and current(cor) == [(112, "Jay", "his2", "visa")]


def test_n5_two_child_rows(spark):
    empty = spark.createDataFrame([], DIMENSION)
    c, a, p = stage(
        spark,
        customers=[(5, "E")],
        addresses=[(51, 5, "old", dt.datetime(2024, 5, 2, 1)), (52, 5, "new", dt.datetime(2024, 5, 2, 2))],
        payments=[(501, 5, "visa")],
    )
    assert transform.full_transform(c, a, p, RUN2).count() == 2  # fan-out as written
    cor = transform.delta_transform_corrected(c, a, p, empty, RUN2)
    assert [(r.id, r.address) for r in cor.collect()] == [(5, "new")]


def test_n8_hard_delete_of_row_absent_from_delta(spark):
    t = dim(spark, [(112, "J", "his1", "amex", D1, OPEN, "Y", T1)])
    c, a, p = stage(spark)
    de = spark.createDataFrame([(1, "customer", 112, UPD, UPD)], DELETED_ENTRIES)
    lit = literal(spark, t, c, a, p, extra=lambda cs: scd2.hard_delete_close(scd2.hard_delete_ids_literal(de, cs), RUN2))
    assert current(lit) == [(112, "J", "his1", "amex")]  # stays open
    cor = corrected(t, c, a, p, scd2.hard_delete_ids(de))
    assert current(cor) == [] and cor.where("etl_end_date = date'2024-05-01'").count() == 1


def test_n8_other_tables_in_delete_log_are_ignored(spark):
    t = dim(spark, [(112, "J", "his1", "amex", D1, OPEN, "Y", T1)])
    c, a, p = stage(spark)
    de = spark.createDataFrame([(1, "customer_payment", 112, UPD, UPD)], DELETED_ENTRIES)
    assert current(corrected(t, c, a, p, scd2.hard_delete_ids(de))) == [(112, "J", "his1", "amex")]


def test_n10_soft_delete_with_other_change(spark):
    t = dim(spark, [(112, "J", "his1", "amex", D1, OPEN, "Y", T1)])
    c, a, p = stage(spark, customers=[(112, "J", UPD)], addresses=[(124, 112, "his2")], soft=True)
    lit = literal(spark, t, c, a, p, extra=lambda cs: scd2.soft_delete_close(cs, RUN2), skip_deleted=True)
    assert current(lit) == [(112, "J", "his2", "amex")]  # re-opened
    cor = corrected(t, c, a, p)
    assert current(cor) == [] and cor.count() == 1


def test_n11_reactivation(spark):
    t = dim(spark, [(7, "G", "a7", "visa", D1, D1, "N", T2)])
    run3 = RunContext.at(dt.datetime(2024, 5, 3, 6))
    c, a, p = stage(spark, customers=[(7, "G")], addresses=[(71, 7, "a7")], payments=[(701, 7, "visa")])
    temp = transform.delta_transform_literal(c, a, p, t, run3)
    assert current(scd2.merge_literal(t, temp, run3)) == []  # identical: stays closed
    assert current(scd2.merge_corrected(t, c, a, p, run3)) == [(7, "G", "a7", "visa")]
    c2, _, _ = stage(spark, customers=[(7, "G2")])
    assert current(scd2.merge_corrected(t, c2, a.limit(0), p.limit(0), run3)) == [(7, "G2", "a7", "visa")]


def test_corrected_rerun_is_noop(spark):
    t = dim(spark, [(112, "J", "his1", "amex", D1, OPEN, "Y", T1)])
    c, a, p = stage(spark, customers=[(112, "Jay")], addresses=[(124, 112, "his2")])
    once = corrected(t, c, a, p)
    twice = scd2.merge_corrected(once, c, a, p, RunContext.at(dt.datetime(2024, 5, 2, 7)))
    cols = ["id", "name", "address", "payment_method", "etl_current_ind", "etl_start_date", "etl_end_date"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


@pytest.mark.parametrize("unions_zip", ["true", "false"])
def test_merges_chain(spark, unions_zip):
    """A merge of a merge of a merge, whether or not unions may keep their sides' partitioning."""
    spark.conf.set("spark.sql.unionOutputPartitioning", unions_zip)
    try:
        t = dim(spark, [(112, "J", "his1", "amex", D1, OPEN, "Y", T1), (113, "K", "x", "visa", D1, OPEN, "Y", T1)])
        lit = cor = t
        for hour, name in ((6, "Jay"), (7, "Jo"), (8, "Jo"), (9, "Ja")):
            run = RunContext.at(dt.datetime(2024, 5, 2, hour))
            c, a, p = stage(spark, customers=[(112, name)], addresses=[(124, 112, "his2")])
            cor = scd2.merge_corrected(cor, c, a, p, run)
            temp = materialize(transform.delta_transform_literal(c, a, p, lit, run))
            lit = materialize(scd2.merge_literal(lit, temp, run))
        assert current(cor) == [(112, "Ja", "his2", "amex"), (113, "K", "x", "visa")]
        assert cor.count() == 5
        assert (113, "K", "x", "visa") in current(lit)
    finally:
        spark.conf.unset("spark.sql.unionOutputPartitioning")


def test_n15_csv_round_trip_keeps_quotes_empty_and_null(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", x', 1.0), (2, "", 2.0), (3, None, 3.0)], SAMPLE)
    write_landing(df, str(tmp_path / "l"), fmt="csv")
    back = read_stage_csv(spark, str(tmp_path / "l"), SAMPLE).orderBy("id").collect()
    assert [r.name for r in back] == ['say "hi", x', "", None]
    pg = tmp_path / "pg.csv"
    pg.write_text('1,"say ""hi"", x",1.0\n2,"",2.0\n3,,3.0\n')
    assert [r.name for r in read_stage_csv(spark, str(pg), SAMPLE).orderBy("id").collect()] == ['say "hi", x', "", None]


def test_literal_close_keeps_duplicates_and_history(spark):
    """UPDATE … FROM as a projection: duplicate target rows survive, history is untouched."""
    t = dim(
        spark,
        [(9, "A", "x", "v", D1, OPEN, "Y", T1), (9, "A", "x", "v", D1, OPEN, "Y", T1), (9, "Z", "z", "v", D1, D1, "N", T1)],
    )
    temp = spark.createDataFrame([("kk", 9, "B", "x", "v", D2, OPEN, "Y", T2)], DIMENSION)
    t1 = scd2.close_changed(t, temp, RUN2)
    assert t1.count() == 3
    assert t1.where(F.col("etl_current_ind") == "N").count() == 3
