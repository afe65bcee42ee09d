"""Small inline reference data and inline JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_number_map
from ..schemas import DAY_ACTIVITY

# The day -> (is_weekday, activity) reference table, Monday first.
DAY_ACTIVITIES = [
    ("monday", True, "guitar lessons"),
    ("tuesday", True, "studying"),
    ("wednesday", True, "soccer practice"),
    ("thursday", True, "contributing to Airflow"),
    ("friday", True, "family dinner"),
    ("saturday", False, "going to the beach"),
    ("sunday", False, "sleeping in"),
]

# The beach-day invitation.
INVITATION_SUBJECT = "Beach day!"
INVITATION_BODY = "It's Saturday and I'm heading to the beach.<br>Come join me!"

# Fixed value: the sample order document and its message prefix.
SAMPLE_ORDERS_JSON = '{"1001": 301.27, "1002": 433.21, "1003": 502.22}'
ORDER_TOTAL_PREFIX = "Total order value is: "


def day_activity(spark: SparkSession) -> DataFrame:
    """The seven-row day dimension (a bounded constant: safe to broadcast).

    Built as an inline table on the JVM side (no Python worker round trip).
    """
    rows = [
        F.struct(F.lit(d).alias("day"), F.lit(w).alias("is_weekday"), F.lit(a).alias("activity"))
        for d, w, a in DAY_ACTIVITIES
    ]
    out = spark.range(1).select(F.inline(F.array(*rows)))
    return F.broadcast(out.select([F.col(f.name).cast(f.dataType) for f in DAY_ACTIVITY.fields]))


def json_documents(spark: SparkSession, docs: list[str]) -> DataFrame:
    """Inline JSON object documents parsed to map<string,double> (column ``m``)."""
    return spark.createDataFrame([(d,) for d in docs], "doc string").select(parse_number_map(F.col("doc")).alias("m"))
