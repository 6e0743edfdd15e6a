"""Tables that are rewritten as a whole: numbered version folders, the last complete one counts.

A write makes a new folder; Spark's committer puts ``_SUCCESS`` into it as its last step.  Readers
take the highest number that has the mark, so a write that fails at any point leaves the table
as it was.  The version before stays for readers that are still at work on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

KEPT = 2
_DONE = "_SUCCESS"


def folder_of(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(number, complete) of the version folders of a table, ascending; one listing of few names."""
    root, files = folder_of(spark, path)
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v") and name[1:].isdigit():
            done = folder_of(spark, f"{path}/{name}/{_DONE}")[0]
            found.append((int(name[1:]), files.exists(done)))
    return sorted(found)


def version_path(path: str, number: int) -> str:
    return f"{path}/v{number:010d}"


def current_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the last complete version; None for a table that was never written."""
    done = [n for n, complete in versions(spark, path) if complete]
    return version_path(path, done[-1]) if done else None


def read_version(spark: SparkSession, path: str) -> DataFrame:
    found = current_path(spark, path)
    if found is None:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.parquet(found)


def write_version(df: DataFrame, path: str, by: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """A new version whose files hold neighbouring values of ``by``; it may read the one before."""
    spark = df.sparkSession
    numbers = [n for n, _ in versions(spark, path)]
    rows = df.hint("rebalance", by[0]).sortWithinPartitions(*by)
    (rows.write.mode("errorifexists").option("compression", "snappy").partitionBy(*partition_by)
        .parquet(version_path(path, max(numbers, default=0) + 1)))
    _drop_old(spark, path)


def _drop_old(spark: SparkSession, path: str) -> None:
    """Keep the last ``KEPT`` complete versions; older ones and broken ones below the last go."""
    found = versions(spark, path)
    done = [n for n, complete in found if complete][-KEPT:]
    for number, _ in found:
        if number not in done and number < done[-1]:
            folder, files = folder_of(spark, version_path(path, number))
            files.delete(folder, True)
