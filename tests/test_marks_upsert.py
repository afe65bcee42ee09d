"""The second run's control table: whole tables, every stored mark kept or raised."""

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import SF_SMALL

import __spark_entry__ as E


def test_second_run_raises_whole_tables_and_keeps_the_rest(spark, tmp_path):
    for t in ("orders", "events", "lineitem"):
        rows = pq.read_table(f"{SF_SMALL}/{t}.parquet").slice(0, 2)
        column = {"orders": "o_orderdate", "events": "ts", "lineitem": "l_shipdate"}[t]
        times = pa.array([946_684_799_000_000, 1_705_500_000_000_000], pa.timestamp("us"))  # before 2000, and in 2024
        rows = rows.set_column(rows.column_names.index(column), column, times)
        if t == "events":
            rows = rows.set_column(rows.column_names.index("event_type"), "event_type", pa.array(["purchase", "view"]))
        pq.write_table(rows, tmp_path / f"{t}.parquet")
    got = {r.table_name: str(r.max_updated) for r in E.queries()["hwm_upsert"](spark, str(tmp_path)).collect()}
    new, old = "2024-01-17 14:00:00", "1999-12-31 23:59:59"
    assert got == {"orders": new, "events": new, "lineitem": new, "events_purchase": old, "events_view": new}
