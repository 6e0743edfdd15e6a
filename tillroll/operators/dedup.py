"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def top1_by(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``; a hash of the whole row settles equal rows.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit), so
    copies of a hot key never travel and never meet in one task.
    """
    window = Window.partitionBy(*_names(keys)).orderBy(*order, F.xxhash64(*df.columns))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_latest(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Newest version per key; versions without an order value come last."""
    known = df.filter(F.col(key).isNotNull())
    return top1_by(known, key, [F.col(order_col).desc_nulls_last()])


def dedup_first(df: DataFrame, key: str, order_cols: Sequence[str] = ()) -> DataFrame:
    """Earliest copy per key, the same one on every run."""
    known = df.filter(F.col(key).isNotNull())
    return top1_by(known, key, [F.col(c).asc_nulls_last() for c in order_cols])
