"""Session helpers: building a session for tests/bench and cutting lineage safely.

On a cluster the session is handed in by the caller and already names a shared
``spark.checkpoint.dir``; we only read it.  A directory of our own is set only when
none is configured (local runs, tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .sources.files import Files


# Starting points for a large cluster (100 TB-class inputs); AQE then coalesces shuffle
# partitions to the advisory size and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidewater", conf: dict | None = None
) -> SparkSession:
    """Session for tests, benchmarks and local runs; ``conf`` (e.g. ``CLUSTER_CONF``) overrides."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint directory, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Only a local master, whose executors are this process, may use a folder of this machine.
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_of(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tidewater/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove what this application has materialized.  Only for its end, or between runs: DataFrames
    that still read such a table can't be computed afterwards."""
    Files(spark, _scratch_of(spark)).remove("")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint directory.

    One job (``Dataset.checkpoint`` would compute an uncached plan twice), the result is
    reliable storage that survives executor loss (never ``localCheckpoint``), and the
    re-read carries file statistics the optimizer can use for join planning.  ``release`` removes
    an application's tables.
    """
    spark = df.sparkSession
    path = f"{_scratch_of(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
