"""Row filters of the silver and serving layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import day


def _present(*cols: str):
    test = F.lit(True)
    for c in cols:
        test = test & F.col(c).isNotNull()
    return test


def is_valid_order() -> Column:
    """Known keys, date and amount, no negative amount, known status."""
    return (
        _present("order_id", "customer_id", "total_amount", "order_date")
        & (F.col("total_amount") >= 0)
        & F.col("order_status").isin(*V.ORDER_STATUSES)
    )


def valid_orders(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_order())


def valid_clickstream(df: DataFrame) -> DataFrame:
    return df.filter(
        _present("event_id", "session_id", "event_ts") & F.col("event_type").isin(*V.EVENT_TYPES)
    )


def valid_reviews(df: DataFrame) -> DataFrame:
    return df.filter(_present("review_id") & F.col("rating").between(1, 5))


def current_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_is_current"))


def incremental_rows(
    src: DataFrame, target: DataFrame, ts_col: str = "_processed_ts", lookback_hours: int = 0
) -> DataFrame:
    """Source rows newer than the newest target row, less a look-back.

    An empty target lets every row with a time through.  The mark is a scalar subquery.
    """
    mark = F.max(ts_col) - F.make_dt_interval(hours=F.lit(lookback_hours))
    start = F.lit("0001-01-01 00:00:00").cast(src.schema[ts_col].dataType)
    return src.filter(F.col(ts_col) > target.agg(F.coalesce(mark, start)).scalar())


def date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Both ends are included."""
    return df.filter(F.col(col).between(day(start), day(end)))


def optional_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df if value is None else df.filter(F.col(col) == value)


def segment_match(df: DataFrame, wanted: str) -> DataFrame:
    """'all', or a churn tier, or a segment."""
    if wanted == "all":
        return df
    return df.filter((F.col("churn_risk_tier") == wanted) | (F.col("segment") == wanted))
