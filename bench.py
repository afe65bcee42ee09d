"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (all rows produced, nothing
collected to the driver): one warm pass, then the median of $BENCH_REPEATS (default 3)
timed runs per query, as far as $BENCH_SECONDS (default 420, with the warm pass) allow: beyond them
a query is timed once.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidewater.plans.queries import QUERIES  # noqa: E402


def _session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tidewater-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidewater-bench")
        .config("spark.sql.shuffle.partitions", str(max(2, int(cpus) * 2)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _run(spark: SparkSession, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    until = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "420"))  # from before the warm pass
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = _session(cpus)
    # Warm pass: class loading and first-use costs are paid once, outside the timings.
    for name in names:
        _run(spark, QUERIES[name], sf_dir)
    times = {}
    for name in names:
        runs = [_run(spark, QUERIES[name], sf_dir)]
        while len(runs) < repeats and time.perf_counter() < until:
            runs.append(_run(spark, QUERIES[name], sf_dir))
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
