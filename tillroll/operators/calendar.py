"""Calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import day


def spine_of(bounds: DataFrame) -> DataFrame:
    """One row per day from a one-row frame with the dates ``first`` and ``last``, both included."""
    return bounds.select(F.explode(F.sequence("first", "last")).alias("dt"))


def date_spine(spark: SparkSession, start, end, end_inclusive: bool = True) -> DataFrame:
    last = day(end) if end_inclusive else F.date_sub(day(end), 1)
    bounds = spark.range(1).select(day(start).alias("first"), last.alias("last"))
    return spine_of(bounds.filter("first <= last"))


def calendar_columns(days: DataFrame, col: str = "dt") -> DataFrame:
    """The date dimension columns for a frame of days."""
    d = F.col(col)
    weekday = F.dayofweek(d) - 1          # 0 is Sunday
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        weekday.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.month(d).isin(*V.HOLIDAY_MONTHS).alias("is_holiday_season"),
    )


def dim_date(
    spark: SparkSession, start: str = V.CALENDAR_START, end: str = V.CALENDAR_END
) -> DataFrame:
    return calendar_columns(date_spine(spark, start, end))
