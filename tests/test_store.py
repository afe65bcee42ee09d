"""The bucketed store: what a delta rewrites, several writers, as-of pruning, pending children, retention."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.functions.scd import RunContext
from tidewater.plans.pipeline import customer_pipeline
from tidewater.schemas import DIMENSION, SOURCE_SCHEMAS, WATERMARK
from tidewater.sources.table_store import CommitConflict, DimensionStore

OPEN = dt.date(9999, 12, 31)


def at(day, hour=6):
    return dt.datetime(2024, 3, day, hour)


def sources(spark, customers, addresses=(), payments=()):
    """Rows (id, value, day) as source tables; a child's row id is its customer's."""
    child = lambda rows, t: spark.createDataFrame([(i, i, v, at(d, 1), at(d, 1)) for i, v, d in rows], SOURCE_SCHEMAS[t])
    return {
        "customer": spark.createDataFrame([(i, v, at(d, 1), at(d, 1)) for i, v, d in customers], SOURCE_SCHEMAS["customer"]),
        "customer_address": child(addresses, "customer_address"),
        "customer_payment": child(payments, "customer_payment"),
    }


def load(spark, store, day, customers, addresses=(), payments=()):
    if day == 1 and customers:  # a table needs a row for a delta to have a mark
        addresses, payments = addresses or [(customers[0][0], None, 1)], payments or [(customers[0][0], None, 1)]
    return customer_pipeline(spark, store, sources(spark, customers, addresses, payments), "full" if day == 1 else "delta", RunContext.at(at(day)))


def current(store):
    return sorted((r.id, r.name, r.address, r.payment_method) for r in store.current().collect())


def files_of(store):
    return {(r.part, r.path): r.bucket for r in store.manifest().collect()}


def bytes_in(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


MANY = [(k, f"name {k} " + "x" * 50, 1) for k in range(4000)]


def base_store(spark, path, buckets=8):
    store = DimensionStore(spark, str(path), buckets=buckets)
    load(spark, store, 1, MANY, [(1, "street", 1)], [(1, "visa", 1)])
    return store


def test_a_delta_rewrites_its_buckets_only(spark, tmp_path):
    store = base_store(spark, tmp_path / "s")
    before = files_of(store)
    assert len(before) == 8 and sum(r.n_rows for r in store.manifest().collect()) == 4000
    load(spark, store, 2, [(7, "seven", 2)])
    touched = store.last_commit().touched
    assert touched == tuple(store.buckets_of(spark.createDataFrame([(7,)], "id long")))
    after = files_of(store)
    live = {p: b for (part, p), b in after.items() if part == "live"}
    assert {p for (_, p), b in before.items() if b not in touched} == {p for p, b in live.items() if b not in touched}
    assert not {p for (_, p), b in before.items() if b in touched} & set(live)
    assert [part for part, _ in after].count("closed") == 1
    write = store.last_commit().write
    assert bytes_in(f"{store.root}/rows/{write}") < bytes_in(f"{store.root}/rows/{store.commit(1).write}") / 4
    rows = {r.id: r.name for r in store.current().collect()}
    assert len(rows) == 4000 and rows[7] == "seven"
    assert [(r.id, r.etl_end_date) for r in store.history().collect()] == [(7, dt.date(2024, 3, 1))]


def test_a_delta_reads_its_buckets_only(spark, tmp_path, monkeypatch):
    store = base_store(spark, tmp_path / "s")
    read = []
    monkeypatch.setattr(store, "_rows_of", lambda files, real=store._rows_of: read.extend(r.bucket for r in files.collect()) or real(files))
    load(spark, store, 2, [(7, "seven", 2)])
    assert set(read) == set(store.last_commit().touched) and len(set(read)) == 1


def test_a_run_without_changes_writes_no_rows(spark, tmp_path):
    store = base_store(spark, tmp_path / "s")
    before = files_of(store)
    load(spark, store, 2, [(k, n, 2) for k, n, _ in MANY[:50]])
    assert files_of(store) == before and store.last_commit().run == 2 and store.last_commit().touched == ()
    assert {r.table_name: r.max_updated for r in store.watermarks().collect()}["customer"] == at(2, 1)


def test_as_of_leaves_out_files_closed_before_the_day(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "s"), buckets=4)
    load(spark, store, 1, [(k, "v1", 1) for k in range(40)])
    for day in (4, 7, 10):
        load(spark, store, day, [(k, f"v{day}", day) for k in range(40)])
    for day, name in ((1, "v1"), (3, "v1"), (4, "v4"), (8, "v7"), (11, "v10")):
        rows = store.as_of(dt.date(2024, 3, day))
        assert {r.name for r in rows.collect()} == {name} and rows.count() == 40
        files = {f.split("/s/")[1] for f in rows.inputFiles()}
        spans = {r.path: (r.start_min, r.end_max) for r in store.manifest().collect()}
        assert files == {p for p, (a, z) in spans.items() if a <= dt.date(2024, 3, day) <= z} and len(files) <= 4 < len(spans)
    assert store.as_of("2024-02-01").count() == 0


def test_two_writers_of_other_buckets_both_commit(spark, tmp_path):
    one = base_store(spark, tmp_path / "s")
    two = DimensionStore(spark, one.root)
    ids = [(k, store_bucket) for k in range(100) for store_bucket in one.buckets_of(spark.createDataFrame([(k,)], "id long"))][:30]
    a = ids[0][0]
    b = next(k for k, bucket in ids if bucket != ids[0][1])
    assert two.last_commit().run == 1  # both have read run 1
    load(spark, one, 2, [(a, "by one", 2)])
    load(spark, two, 2, [(b, "by two", 2)])
    fresh = DimensionStore(spark, one.root)
    assert fresh.runs() == [1, 2, 3] and two.last_commit().run == 3
    rows = {r.id: r.name for r in fresh.current().collect()}
    assert len(rows) == 4000 and rows[a] == "by one" and rows[b] == "by two" and fresh.history().count() == 2


def test_a_writer_whose_buckets_were_changed_merges_again(spark, tmp_path):
    one = base_store(spark, tmp_path / "s")
    two = DimensionStore(spark, one.root)
    two.last_commit()
    load(spark, one, 2, [(7, "by one", 2)], [(7, "street 7", 2)])
    load(spark, two, 3, [(7, "by two", 3)])  # read run 1, has to merge into run 2
    fresh = DimensionStore(spark, one.root)
    assert [r for r in current(fresh) if r[0] == 7] == [(7, "by two", "street 7", None)]
    assert fresh.current().count() == 4000 and fresh.runs() == [1, 2, 3]
    assert [(r.name, r.etl_end_date.day) for r in fresh.history().orderBy("etl_end_date").collect()][1:] == [("by one", 2)]


def test_a_conflict_is_told(spark, tmp_path):
    one = base_store(spark, tmp_path / "s")
    two = DimensionStore(spark, one.root)
    marks = spark.createDataFrame([("customer", at(2))], WATERMARK)
    rows = two.current([0])
    one.commit_delta(one.current([0]), marks, [0])
    with pytest.raises(CommitConflict):
        two.commit_delta(rows, marks, [0])
    with pytest.raises(CommitConflict):
        two.commit_full(rows, marks)
    assert DimensionStore(spark, one.root).current().count() == 4000
    assert not one.files.publish("commits/0000000002.json", "x")


def test_children_wait_for_their_customer(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "s"), buckets=4)
    load(spark, store, 1, [(1, "one", 1)], [(1, "a1", 1), (2, "early", 1), (9, "never", 1)], [(2, "cash", 1)])
    assert current(store) == [(1, "one", "a1", None)]
    load(spark, store, 2, [], [(2, "later", 2)])
    assert sorted((r.table_name, r.cust_id, r.value) for r in store.pending().collect()) == [
        ("customer_address", 2, "later"), ("customer_address", 9, "never"), ("customer_payment", 2, "cash")
    ]
    load(spark, DimensionStore(spark, store.root), 3, [(2, "two", 3)])
    store.refresh()
    assert current(store) == [(1, "one", "a1", None), (2, "two", "later", "cash")]
    assert [r.cust_id for r in store.pending().collect()] == [9]
    load(spark, store, 4, [(9, "nine", 4)])
    assert (9, "nine", "never", None) in current(store) and store.last_commit().pending is None


def test_vacuum_keeps_readable_states_and_removes_the_rest(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "s"), buckets=4)
    load(spark, store, 1, [(k, "v1", 1) for k in range(20)], [(99, "waits", 1)])
    for day in (2, 3):
        load(spark, store, day, [(k, f"v{day}", day) for k in range(0, 20, 3)])
    before = {run: sorted(map(str, store.dimension(store.commit(run)).collect())) for run in (1, 2, 3)}
    waiting = store.pending().collect()
    # a run that failed: files that no commit names
    store._write_rows("lost", store.current(), 4)
    assert store.vacuum(keep=3) == 0  # all files are young
    now = dt.timedelta(seconds=-5)
    assert store.vacuum(keep=2, older_than=now) > 0
    assert not [f for d, _, fs in os.walk(f"{store.root}/rows/lost") for f in fs if f.endswith(".parquet")]
    fresh = DimensionStore(spark, store.root)
    assert fresh.runs() == [2, 3]
    assert {run: sorted(map(str, fresh.dimension(fresh.commit(run)).collect())) for run in (2, 3)} == {2: before[2], 3: before[3]}
    assert fresh.pending().collect() == waiting
    size = bytes_in(store.root)
    assert fresh.vacuum(keep=1, older_than=now) > 0 and bytes_in(store.root) < size
    assert sorted(map(str, fresh.dimension().collect())) == before[3]
    load(spark, fresh, 4, [(99, "found", 4)])
    assert (99, "found", "waits", None) in current(fresh)


def test_the_backup_of_a_full_load_is_kept_not_copied(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "s"), buckets=4)
    load(spark, store, 1, [(1, "one", 1)])
    load(spark, store, 2, [(1, "uno", 2)])
    before = sorted(map(str, store.dimension().collect()))
    marks = spark.createDataFrame([("customer", at(3))], WATERMARK)
    store.commit_full(spark.createDataFrame([("k", 5, "five", None, None, dt.date(2024, 3, 3), OPEN, "Y", at(3))], DIMENSION), marks, buckets=2)
    assert store.last_commit().backup == 2 and store.buckets == 2
    assert sorted(map(str, store.backup(3).collect())) == before
    store.vacuum(keep=1, older_than=dt.timedelta(seconds=-5))
    assert sorted(map(str, store.backup(3).collect())) == before and current(store) == [(5, "five", None, None)]
    with pytest.raises(FileNotFoundError):
        os.rename(f"{store.root}/rows/{store.last_commit().write}", f"{tmp_path}/lost")
        store.current().count()


def test_an_empty_store_and_an_empty_load(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "s"))
    assert store.dimension().count() == store.pending().count() == store.watermarks().count() == store.as_of("2024-01-01").count() == 0
    load(spark, store, 1, [])
    assert DimensionStore(spark, store.root).current().count() == 0
    marks = spark.createDataFrame([("customer", at(2))], WATERMARK)
    store.commit_delta(spark.createDataFrame([("k", 5, "five", None, None, dt.date(2024, 3, 2), OPEN, "Y", at(2))], DIMENSION), marks)
    assert current(store) == [(5, "five", None, None)]
