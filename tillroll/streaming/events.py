"""Streams of events: removing repeats, sessions, latest stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.dedup import top1_by

GAP = "30 minutes"


def dedup_stream(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """First delivery of each key; state is dropped once the watermark is past it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def with_late(stored: DataFrame, late: DataFrame, key: str, ts: str) -> DataFrame:
    """The stored events, and of late ones with a new key the first by ``ts``; for the daily merge."""
    first = top1_by(late, key, [F.col(ts).asc_nulls_last(), F.xxhash64(*stored.columns)])
    return stored.unionByName(first.join(stored.select(key), key, "left_anti").select(*stored.columns))


def sessionize_stream(
    stream: DataFrame, key: str, ts: str, gap: str = GAP, delay: str = "1 hour"
) -> DataFrame:
    """Activity sessions per key, given out when the watermark has passed their end."""
    grouped = stream.withWatermark(ts, delay).groupBy(key, F.session_window(ts, gap).alias("s"))
    return grouped.agg(
        F.count("*").alias("events"), F.min(ts).alias("started"), F.max(ts).alias("last_event"),
    ).select(key, "started", "last_event", "events")


def sessionize(df: DataFrame, key: str, ts: str, gap_minutes: int = 30) -> DataFrame:
    """The same sessions over a table, safe for a key with very many events.

    Time is cut into slots as long as the gap.  Events of one key and slot are less than a
    gap apart, so they belong together and plain partial aggregation turns them into one
    piece before the shuffle.  A key then has at most one piece per slot of its history,
    however many events it has, and joining pieces in time order is light.
    """
    gap = F.expr(f"INTERVAL {gap_minutes} MINUTES")
    known = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    slot = F.floor(F.unix_micros(ts) / F.lit(gap_minutes * 60_000_000))
    pieces = known.groupBy(key, slot.alias("_slot")).agg(
        F.count("*").alias("events"), F.min(ts).alias("started"), F.max(ts).alias("last_event"))

    in_order = Window.partitionBy(key).orderBy("_slot")
    previous = F.lag("last_event").over(in_order)
    opens = F.when(previous.isNull() | (F.col("started") > previous + gap), 1).otherwise(0)
    numbered = pieces.withColumn("_opens", opens).withColumn(
        "_session", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "_session").agg(
        F.min("started").alias("started"), F.max("last_event").alias("last_event"),
        F.sum("events").alias("events"),
    ).drop("_session")


def latest_stock(events: DataFrame) -> DataFrame:
    """Newest quantity per warehouse and product, for a table or a running stream."""
    newest = F.struct("event_ts", "event_id")
    return events.groupBy("warehouse_id", "product_sku").agg(
        F.max_by("new_quantity", newest).alias("quantity"),
        F.max("event_ts").alias("as_of"),
        F.sum("quantity_change").alias("net_change"),
        F.count("*").alias("events"),
    )
