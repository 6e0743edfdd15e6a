"""Serving queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.expressions import (
    avg_if, count_if, day, instant, mean, ratio, rounded, sum_if,
)
from tillroll.functions.retail import freshness_status
from tillroll.operators.filters import current_rows, optional_eq, segment_match
from tillroll.operators.joins import explode_items

_DONE = "is_completed = 1"


def _done():
    return F.expr(_DONE)


def _placed(orders: DataFrame, start, end=None) -> DataFrame:
    """Orders placed on the days from ``start`` to ``end``; both are included, dates or columns.

    Fact and silver orders are stored by year and month, so the first test, on those two,
    keeps whole folders from being opened.
    """
    first = F.make_date("order_year", "order_month", F.lit(1))
    since = start if isinstance(start, Column) else day(start)
    kept = orders.filter((first >= F.trunc(since, "month")) & (F.col("order_date_day") >= since))
    return kept if end is None else kept.filter((first <= day(end)) & (F.col("order_date_day") <= day(end)))


def daily_revenue(fact: DataFrame, start, end, one_row_per_order: bool = False) -> DataFrame:
    """Per day; ``one_row_per_order``, which the merge of the fact guarantees, counts rows for orders."""
    refunded = count_if(F.col("order_status") == "refunded")
    orders = F.count("order_id") if one_row_per_order else F.count_distinct("order_id")
    days = _placed(fact, start, end).groupBy(
        F.col("order_date_day").alias("date")
    ).agg(
        orders.alias("total_orders"),
        F.sum("is_completed").alias("completed_orders"),
        sum_if(_done(), "total_amount").alias("total_revenue"),
        rounded(avg_if(_done(), "total_amount"), 2).alias("avg_order_value"),
        rounded(ratio(F.sum("is_cancelled"), F.count("*")), 4).alias("cancellation_rate"),
        rounded(ratio(refunded, F.count("*")), 4).alias("refund_rate"),
    )
    return days.orderBy(F.col("date").desc())


def revenue_summary(fact: DataFrame, as_of) -> DataFrame:
    """One row: completed revenue of today, 7 days, 30 days, this month, this year.

    Windows are open to the right: a row after the as-of date counts in 7d and 30d.
    No window reaches back beyond the start of the year or 30 days, so older days are
    filtered out at the scan; without any such row the sums are 0.
    """
    placed, today = F.col("order_date_day"), day(as_of)
    fact = _placed(fact, F.least(F.trunc(today, "year"), F.date_sub(today, 30)))

    def revenue(when):
        return F.coalesce(sum_if(_done() & when, "total_amount"), F.lit(0))

    def same(unit):
        return F.trunc(placed, unit) == F.trunc(today, unit)

    return fact.agg(
        revenue(placed == today).alias("today"),
        revenue(placed >= F.date_sub(today, 7)).alias("last_7d"),
        revenue(placed >= F.date_sub(today, 30)).alias("last_30d"),
        revenue(same("month")).alias("mtd"),
        revenue(same("year")).alias("ytd"),
        F.count_distinct(F.when(placed == today, F.col("customer_id"))).alias(
            "unique_customers_today"),
    )


def _snapshot(features: DataFrame, as_of) -> DataFrame:
    return features.filter(F.col("snapshot_date") == day(as_of))


def _bounded(limit: int, most: int) -> int:
    """The limit of a report; one outside 1..``most`` is refused, not cut."""
    if not 1 <= limit <= most:
        raise ValueError(f"limit must lie between 1 and {most}, not {limit}")
    return limit


def segment_customers(features: DataFrame, segment: str, as_of, limit: int = 100) -> DataFrame:
    """Customers of a segment by revenue; a report of at most 1000 lines."""
    chosen = segment_match(_snapshot(features, as_of), segment)
    return chosen.select(
        "customer_id", "loyalty_tier", "total_orders", "total_revenue", "recency_days",
        "rfm_total_score", "churn_risk_tier",
    ).orderBy(F.col("total_revenue").desc(), "customer_id").limit(_bounded(limit, 1000))


_TOP_BY = {"revenue": "total_revenue", "orders": "total_orders", "rfm": "rfm_total_score"}


def top_customers(features: DataFrame, as_of, by: str = "revenue", limit: int = 20) -> DataFrame:
    """The first customers by revenue, orders or score; a report of at most 500 lines."""
    return _snapshot(features, as_of).select(
        "customer_id", "loyalty_tier", "segment", "total_orders", "total_revenue",
        "recency_days", "rfm_total_score", "churn_risk_tier",
    ).orderBy(F.col(_TOP_BY[by]).desc(), "customer_id").limit(_bounded(limit, 500))


def customer_360(
    features: DataFrame, dim: DataFrame, as_of, customer_id: str | None = None
) -> DataFrame:
    """Profile of one customer, or of all when no id is given."""
    f = optional_eq(_snapshot(features, as_of), "customer_id", customer_id).select(
        "customer_id", "total_orders", "total_revenue", "recency_days", "rfm_total_score",
        "churn_risk_tier", "customer_profile_text",
    )
    d = optional_eq(current_rows(dim), "customer_id", customer_id).select(
        "customer_id", "loyalty_tier", "segment", "age_bracket", "country", "ltv_band"
    )
    return f.join(d, "customer_id").select(
        "customer_id", "loyalty_tier", "segment", "age_bracket", "country", "total_orders",
        "total_revenue", "recency_days", "rfm_total_score", "churn_risk_tier",
        "customer_profile_text", "ltv_band",
    )


def product_performance(
    orders: DataFrame, start, end, category: str | None = None, limit: int = 50
) -> DataFrame:
    """Per product over the order lines of the period; reads orders, which hold the lines.

    The return rate is refunded lines over distinct orders and may pass 1.  A report of at
    most 500 lines.
    """
    placed = orders.withColumn("order_date_day", F.col("order_date").cast("date"))
    lines = explode_items(
        _placed(placed, start, end).select("order_id", "order_status", "items")
    )
    n_orders = F.count_distinct("order_id")
    refunded = count_if(F.col("order_status") == "refunded")
    products = optional_eq(lines, "category", category).groupBy(
        "product_sku", "product_name", "category", "subcategory"
    ).agg(
        F.sum("quantity").alias("total_units_sold"),
        F.sum("total_price").alias("total_revenue"),
        rounded(mean("unit_price"), 2).alias("avg_unit_price"),
        rounded(ratio(refunded, n_orders), 4).alias("return_rate"),
        n_orders.alias("order_count"),
    )
    return products.orderBy(F.col("total_revenue").desc(), "product_sku").limit(_bounded(limit, 500))


def low_stock(inventory: DataFrame, as_of, limit: int = 500) -> DataFrame:
    """Rows at or below the reorder point on the day, scarcest first.

    ``limit`` is the length of the report, a documented parameter of it.
    """
    return inventory.filter(
        (F.col("snapshot_date") == day(as_of)) & F.col("is_low_stock")
    ).select(
        "warehouse_id", "product_sku", "quantity_available", "is_low_stock", "is_out_of_stock",
        "reorder_point",
    ).orderBy("quantity_available", "warehouse_id", "product_sku").limit(limit)


def load_health(fact: DataFrame, now_ts) -> DataFrame:
    """Newest load and order day, orders today, hours since the load, and a status."""
    now = instant(now_ts)
    seconds = F.unix_micros(now) - F.unix_micros(F.max("_processed_ts"))
    found = fact.agg(
        F.max("_processed_ts").alias("last_pipeline_run"),
        F.max("order_date_day").alias("latest_order_date"),
        count_if(F.col("order_date_day") == now.cast("date")).alias("total_orders_today"),
        ratio(seconds, F.lit(3_600_000_000)).alias("data_freshness_hours"),
    )
    return found.withColumn("status", freshness_status("data_freshness_hours"))


def channel_attribution(fact: DataFrame, start, end) -> DataFrame:
    """Per channel; the fact has one row per order.

    Customers are counted by first adding up the rows of each customer and channel, so
    nothing is multiplied; the shares are taken over the few channels, in one window.
    """
    channel = ("utm_source", "utm_medium", "channel")
    amount = F.when(_done(), F.col("total_amount"))
    per_customer = _placed(fact, start, end).groupBy(*channel, "customer_id").agg(
        F.count("order_id").alias("orders"), F.sum(amount).alias("paid"), F.count(amount).alias("paid_rows"))
    channels = per_customer.groupBy(*channel).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.coalesce(F.sum("paid"), F.lit(0)).alias("revenue"),
        rounded(ratio(F.sum("paid"), F.sum("paid_rows")), 2).alias("avg_order_value"),
    )
    total = F.sum("revenue").over(Window.partitionBy()).cast("double")
    shared = channels.withColumn(
        "revenue_share_pct", F.try_divide(F.col("revenue").cast("double") * 100.0, total))
    return shared.withColumn(
        "revenue_share_pct", rounded("revenue_share_pct", 2)
    ).orderBy(F.col("revenue").desc(), "utm_source", "utm_medium", "channel")
