"""Silver, gold and dead-letter writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LAYOUT = "_layout"           # an empty file with the columns of a table that has no row yet


def write_partitioned(
    df: DataFrame, path: str, cols: Sequence[str], sort_by: Sequence[str] = ()
) -> int:
    """Snappy Parquet by partition columns; only the partitions in ``df`` are replaced.

    The rebalance hint gathers each partition into few files and lets adaptive execution
    split a partition that holds a large part of the rows.  Returns the rows written; they
    are counted in the writing tasks, whose counts Spark applies once even after a retry.
    """
    written = Observation("written")
    rows = df.hint("rebalance", *cols)
    if sort_by:
        rows = rows.sortWithinPartitions(*cols, *sort_by)
    rows = rows.observe(written, F.count("*").alias("rows"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*cols)
        .parquet(path)
    )
    if written.get["rows"] == 0 and not has_rows(df.sparkSession, path):
        df.limit(0).write.mode("overwrite").parquet(f"{path}/{_LAYOUT}")
    return written.get["rows"]


def replace_dates(rows: DataFrame, path: str, column: str, kind: str, date=None) -> int:
    """Write ``rows`` as the partition ``column`` = ``date`` of a folder, or as all its partitions.

    What the date (or the folder) held before goes, also when there are no rows now.  Returns the rows written.
    """
    written = Observation("replaced")
    rows = rows.observe(written, F.count("*").alias("rows"))
    mode = "static" if date is None else "dynamic"
    (rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
        .partitionBy(column).format(kind).save(path))
    if date is not None and written.get["rows"] == 0:
        _remove(rows.sparkSession, f"{path}/{column}={date}")
    return written.get["rows"]


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_dlq(bad: DataFrame, root: str, entity: str, date=None) -> int:
    """Keep bad rows as JSON under _dlq/{entity}/date=, by the date they landed on.

    ``bad`` holds the bad rows of ``date``, or of all dates.  A date is replaced as a whole: a run
    that is repeated keeps each bad row once, and one without bad rows leaves none.
    """
    return replace_dates(bad, f"{root}/_dlq/{entity}", "date", "json", date)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Does the table hold a data file?  The listing stops at the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    root = files.getFileStatus(folder).getPath().toString()
    found = files.listFiles(folder, True)
    while found.hasNext():
        names = found.next().getPath().toString()[len(root):].split("/")
        if not any(n.startswith(("_", ".")) for n in names):
            return True
    return False


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table; one without a row has the columns that its first write told."""
    return spark.read.parquet(path if has_rows(spark, path) else f"{path}/{_LAYOUT}")
