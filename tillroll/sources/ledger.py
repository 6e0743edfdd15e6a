"""Run ledgers: what has been merged into a table, told by numbered runs and not by clocks.

A run takes a number, writes its rows, and is committed by its last step, a folder with one
row of facts and Spark's ``_SUCCESS``.  A reader of the table goes by committed runs: rows of a
higher number belong to a run that is at work or has failed.  So a run that stops half-way leaves
no mark, and one with an earlier clock is not taken for an old one.  One run at a time per table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.versions import version_path, versions


def _root(root: str, table: str) -> str:
    return f"{root}/_runs/{table}"


def begin(spark: SparkSession, root: str, table: str) -> int:
    """The number of a new run, above those of all committed runs."""
    return max((n for n, _ in versions(spark, _root(root, table))), default=0) + 1


def commit(spark: SparkSession, root: str, table: str, number: int, **facts) -> None:
    """Mark a run as done; facts are texts, numbers or lists of texts."""
    columns = [F.array(*[F.lit(x) for x in v]).cast("array<string>").alias(k) if isinstance(v, list)
               else F.lit(v).alias(k) for k, v in facts.items()]
    row = spark.range(1).coalesce(1).select(F.lit(number).cast("long").alias("run"), *columns)
    row.write.mode("overwrite").parquet(version_path(_root(root, table), number))


def since(spark: SparkSession, root: str, table: str, number: int) -> list[dict]:
    """Facts of the committed runs after ``number``, in their order."""
    path = _root(root, table)
    done = [n for n, complete in versions(spark, path) if complete and n > number]
    return [spark.read.parquet(version_path(path, n)).first().asDict() for n in done]


def last(spark: SparkSession, root: str, table: str) -> dict | None:
    """Facts of the last committed run."""
    path = _root(root, table)
    done = [n for n, complete in versions(spark, path) if complete]
    return spark.read.parquet(version_path(path, done[-1])).first().asDict() if done else None


def between(rows: DataFrame, mark: int, upto: int) -> DataFrame:
    """Rows written by the runs after ``mark``, up to ``upto``; their number is in ``_run``."""
    return rows.filter((F.col("_run") > mark) & (F.col("_run") <= upto))


def moment(value) -> datetime:
    """A run's clock, for comparison; texts are UTC."""
    return value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
