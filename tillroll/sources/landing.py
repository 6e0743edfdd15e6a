"""What has landed: file counts and sizes per entity and date partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import day

_PARTS = r"/([^/]+)/date=(\d{4}-\d{2}-\d{2})/[^/]+$"


def _date_folders(spark: SparkSession, root: str, entities: Sequence[str] | None, date) -> list[str]:
    """Folders {entity}/date= that exist; their names only, one listing per entity."""
    wanted = "*" if entities is None else "{" + ",".join(entities) + "}"
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{wanted}/date={'*' if date is None else date}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString() for status in found or []]


def landed_files(
    spark: SparkSession, root: str, entities: Sequence[str] | None = None, date: str | None = None
) -> DataFrame:
    """(entity, date, path, length) of the data files; file contents are not read.

    Only the folders of the asked entities and date are listed, and Spark lists many
    folders in tasks, not on the driver.
    """
    folders = _date_folders(spark, root, entities, date)
    if not folders:
        return spark.createDataFrame([], "entity string, date date, path string, length bigint")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
        .select("path", "length")
    )
    return files.select(
        F.regexp_extract("path", _PARTS, 1).alias("entity"),
        F.regexp_extract("path", _PARTS, 2).try_cast("date").alias("date"),
        "path", "length",
    ).filter(F.col("date").isNotNull())


def landing_report(files: DataFrame, expected: Sequence[str] = ()) -> DataFrame:
    """Files and bytes per entity and date; an expected entity without files has one empty line."""
    found = files.groupBy("entity", "date").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))
    if expected:
        names = F.explode(F.array(*[F.lit(e) for e in expected])).alias("entity")
        wanted = files.sparkSession.range(1).select(names)
        found = found.join(wanted, "entity", "full_outer").fillna(0, ["files", "bytes"])
    mb = F.round(F.col("bytes") / F.lit(1024 * 1024), 2)
    return found.withColumns({"mb": mb, "has_data": F.col("files") > 0})


def date_partitions(report: DataFrame, entity: str) -> DataFrame:
    return report.filter(F.col("entity") == entity).select("date").distinct().orderBy("date")


def latest_partition(report: DataFrame, entity: str) -> DataFrame:
    """One row with the newest date of the entity, NULL when there is none."""
    return report.filter(F.col("entity") == entity).agg(F.max("date").alias("latest_date"))


def _complete(required: Sequence[str]) -> Column:
    found = F.count_if((F.col("entity") == F.lit(required[0])) & (F.col("files") > 0)) > 0
    for entity in required[1:]:
        found = found & (F.count_if((F.col("entity") == F.lit(entity)) & (F.col("files") > 0)) > 0)
    return found.alias("complete")


def bronze_complete(
    report: DataFrame, date, required: Sequence[str] = V.REQUIRED_ENTITIES
) -> DataFrame:
    """One row: has every required entity at least one file for the date?"""
    return report.filter(F.col("date") == day(date)).agg(_complete(required))


def complete_dates(report: DataFrame, required: Sequence[str] = V.REQUIRED_ENTITIES) -> DataFrame:
    """(date, complete) for every date on which anything has landed."""
    return report.filter(F.col("date").isNotNull()).groupBy("date").agg(_complete(required))
