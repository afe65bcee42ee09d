"""Column expressions for type-2 dimensions.

``current_date``/``current_timestamp`` are explicit run parameters (``RunContext``) so a
re-run of a day is deterministic and every statement of one run shares one clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the dimension's bookkeeping columns.
OPEN_END_DATE = "9999-12-31"
CURRENT = "Y"
CLOSED = "N"


@dataclass(frozen=True)
class RunContext:
    """The clock of one load run: ``run_date`` (current_date) and ``run_ts`` (current_timestamp)."""

    run_date: dt.date
    run_ts: dt.datetime

    @classmethod
    def at(cls, ts: dt.datetime) -> "RunContext":
        return cls(ts.date(), ts)

    @property
    def ts_text(self) -> str:
        text = self.run_ts.strftime("%Y-%m-%d %H:%M:%S")
        if self.run_ts.microsecond:
            text += f".{self.run_ts.microsecond:06d}".rstrip("0")
        return text

    def ts(self) -> Column:
        return F.lit(self.ts_text).cast("timestamp_ntz")

    def date(self) -> Column:
        return F.lit(self.run_date.isoformat()).cast("date")

    def close_date(self) -> Column:
        """End date written when a version is closed: the day before the run."""
        return F.date_sub(self.date(), 1)


def open_end_date() -> Column:
    return F.lit(OPEN_END_DATE).cast("date")


def surrogate_key(id_col: Column, run: RunContext) -> Column:
    """md5 of the business key followed by the run timestamp text."""
    return F.md5(F.concat(id_col.cast("string"), F.lit(run.ts_text)))


def attribute_hash(name: Column, address: Column, payment_method: Column) -> Column:
    """md5 over the plain concatenation; NULL if any part is NULL (no separator, as in the source)."""
    return F.md5(F.concat(name, address, payment_method))


def any_distinct(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs, treating NULL = NULL as equal (IS DISTINCT FROM)."""
    return reduce(lambda acc, p: acc | ~p[0].eqNullSafe(p[1]), pairs[1:], ~pairs[0][0].eqNullSafe(pairs[0][1]))


def new_version_columns(id_col: Column, name: Column, address: Column, payment: Column, run: RunContext) -> list[Column]:
    """The nine dimension columns of a freshly opened version."""
    return [
        surrogate_key(id_col, run).alias("etl_key"),
        id_col.cast("long").alias("id"),
        name.alias("name"),
        address.alias("address"),
        payment.alias("payment_method"),
        run.date().alias("etl_start_date"),
        open_end_date().alias("etl_end_date"),
        F.lit(CURRENT).alias("etl_current_ind"),
        run.ts().alias("etl_timestamp"),
    ]


def close_when(flag: Column, run: RunContext) -> list[Column]:
    """Project dimension rows, closing those where ``flag`` is true (UPDATE … SET as a projection)."""
    hit = F.coalesce(flag, F.lit(False))
    return [
        F.col("etl_key"),
        F.col("id"),
        F.col("name"),
        F.col("address"),
        F.col("payment_method"),
        F.col("etl_start_date"),
        F.when(hit, run.close_date()).otherwise(F.col("etl_end_date")).alias("etl_end_date"),
        F.when(hit, F.lit(CLOSED)).otherwise(F.col("etl_current_ind")).alias("etl_current_ind"),
        F.when(hit, run.ts()).otherwise(F.col("etl_timestamp")).alias("etl_timestamp"),
    ]
