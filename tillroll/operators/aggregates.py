"""Most frequent values, distinct counts per key, shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tally(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, attr, value, n): how often each non-NULL value occurs per key and column.

    One scan serves all columns.  The shuffle is by key, column and value with map-side
    counting, so neither a hot key nor a column with very many values fills one task.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    return (
        df.filter(F.col(key).isNotNull())
        .select(key, F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy(key, "attr", "value")
        .agg(F.count("*").alias("n"))
    )


TOTAL = ""      # attr of the lines of a profile that carry its metrics


def profile(df: DataFrame, key: str, habits: Sequence[str], metrics: dict) -> DataFrame:
    """A tally of ``habits`` and the metrics per key, from one scan and without an Expand.

    ``metrics`` maps a name to (value, how), how being ``F.sum``, ``F.min`` or ``F.max``.  Rows are first
    counted by key and all habits, which combines on the map side; only the counted rows
    are unpivoted.  Lines with attr ``TOTAL`` carry the metrics and the number of rows,
    to be read by ``metric``; the others are those of ``tally``.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key, *habits).agg(
        F.count("*").alias("n"), *[how(value).alias(m) for m, (value, how) in metrics.items()])
    kinds = {m: counted.schema[m].dataType for m in metrics}

    def line(attr: str, value: Column, whole: bool) -> Column:
        rest = [(F.col(m) if whole else F.lit(None).cast(kinds[m])).alias(m) for m in metrics]
        return F.struct(F.lit(attr).alias("attr"), value.cast("string").alias("value"), "n", *rest)

    lines = [line(c, F.col(c), False) for c in habits] + [line(TOTAL, F.lit(None), True)]
    told = counted.select(key, F.inline(F.array(*lines)))
    told = told.filter((F.col("attr") == TOTAL) | F.col("value").isNotNull())
    return told.groupBy(key, "attr", "value").agg(
        F.sum("n").alias("n"), *[how(m).cast(kinds[m]).alias(m) for m, (_, how) in metrics.items()])


def metric(name: str) -> Column:
    """Over a profile: a metric of the key, or ``n``, its number of rows."""
    return F.max(F.when(F.col("attr") == TOTAL, F.col(name)))


def most_frequent(attr: str) -> Column:
    """Over a tally: the value with the highest count, lowest value on ties."""
    ranked = F.when(F.col("attr") == attr, F.struct((-F.col("n")).alias("order"), F.col("value")))
    return F.min(ranked)["value"]


def distinct_values(attr: str) -> Column:
    """Over a tally: number of distinct non-NULL values."""
    return F.count_if(F.col("attr") == attr)


def mode_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value of every column per key."""
    return tally(df, key, cols).groupBy(key).agg(*[most_frequent(c).alias(c) for c in cols])


def mode_tuple_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Most frequent combination of the columns per key, NULL parts allowed.

    Ties go to the lowest combination, NULL first.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key, *cols).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("_order"), *cols))
    return counted.groupBy(key).agg(best.alias("_best")).select(
        key, *[F.col("_best")[c].alias(c) for c in cols]
    )


def share_of_total(df: DataFrame, col: str, out: str, factor: float = 100.0) -> DataFrame:
    """Add each row's share of the column total (times ``factor``), NULL for a zero total.

    The total is an uncorrelated scalar subquery: no window over all rows, no cross join.
    """
    total = df.agg(F.sum(col).cast("double")).scalar()
    return df.withColumn(out, F.try_divide(F.col(col).cast("double") * factor, total))


def duplicated(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*names).agg(F.count("*").alias("n")).filter("n > 1")
