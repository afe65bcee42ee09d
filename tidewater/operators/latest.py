"""Latest row per key (row_number() = 1 over a key, newest first).

Spark plans ``row_number() = 1`` as a *partial* ``WindowGroupLimit`` before the shuffle
and a final one after it, so every map task ships at most one row per key: a key that
holds a third of all rows still reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc() if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (strings mean descending).

    Give tie-breakers in ``order`` (a unique column last) for a deterministic pick.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
