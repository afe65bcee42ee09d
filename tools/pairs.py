"""

Usage: python tools/pairs.py [sf_dir]
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidewater.functions.scd import CURRENT, new_version_columns  # noqa: E402
from tidewater.operators import transform  # noqa: E402
from tidewater.plans.fixtures import run_of_day  # noqa: E402
from tidewater.plans.queries import QUERIES, Dimension  # noqa: E402
from tidewater.session import build_session, materialize  # noqa: E402


def without_semi_join(c: DataFrame, a: DataFrame, p: DataFrame, target: DataFrame, run) -> DataFrame:
    """The delta transform's second branch over every current row."""
    t = target.where(F.col("etl_current_ind") == CURRENT).alias("t")
    j = t.join(c.alias("c"), F.col("t.id") == F.col("c.id"), "left").join(a.alias("a"), F.col("t.id") == F.col("a.cust_id"), "left")
    j = j.join(p.alias("p"), F.col("t.id") == F.col("p.cust_id"), "left")
    j = j.where(F.coalesce("a.address", "p.payment_method", "c.name").isNotNull())
    new = [F.coalesce(x, y) for x, y in (("c.name", "t.name"), ("a.address", "t.address"), ("p.payment_method", "t.payment_method"))]
    return j.select(*new_version_columns(F.col("t.id"), *new, run)).dropDuplicates()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    dim = Dimension(spark, sf_dir, "literal")
    target = materialize(dim.input(1))
    stages = [materialize(s) for s in dim.sc.stages(2)]
    run = run_of_day(2)
    work = {
        "merge, literal (scd2_literal)": lambda: QUERIES["scd2_literal"](spark, sf_dir),
        "merge, corrected (scd2_corrected)": lambda: QUERIES["scd2_corrected"](spark, sf_dir),
        "delta transform with the key semi-join": lambda: transform.changed_current_literal(*stages, target, run),
        "delta transform without it": lambda: without_semi_join(*stages, target, run),
    }
    for name, make in work.items():
        times = []
        for _ in range(4):
            t = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        print(f"| {name} | {statistics.median(times[1:]):.2f} |")
    spark.stop()


if __name__ == "__main__":
    main()
