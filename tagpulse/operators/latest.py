"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: int, rank: str) -> DataFrame:
    """The first ``keep`` rows of each key, numbered from 1 in ``rank``.

    Spark cuts every key to ``keep`` rows in each map task before the shuffle
    (WindowGroupLimit), so a key holding a third of the table sends a few rows per task.
    """
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(rank, numbered).filter(F.col(rank) <= keep)


def latest_version(rows: DataFrame, keys: Sequence[str], versions: Sequence[str]) -> DataFrame:
    """The newest row of each key; ``versions`` are compared one after the other."""
    order = [F.col(version).desc() for version in versions]
    return first_rows(rows, keys, order, 1, "__rank").drop("__rank")
