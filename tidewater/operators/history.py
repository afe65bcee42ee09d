"""Reading a type-2 dimension back: the version valid on a given date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of(dimension: DataFrame, day: dt.date | str) -> DataFrame:
    """Rows whose validity interval [etl_start_date, etl_end_date] contains ``day``.

    A plain range predicate on two columns, pushed into the scan.  It spares row groups only where
    files are clustered by these dates; ``DimensionStore.as_of`` leaves out whole files by them.
    """
    d = F.lit(str(day)).cast("date")
    return dimension.where((F.col("etl_start_date") <= d) & (F.col("etl_end_date") >= d))
