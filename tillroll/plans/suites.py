"""The quality suites of the silver and gold tables.

Names, limits and severities are fixed values of the data model; the checks themselves
are in ``operators.quality``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import instant
from tillroll.operators import quality as Q


def _key(col: str) -> list[Q.Check]:
    return [Q.unique(col), Q.not_null(col)]


def silver_orders_suite() -> list[Q.Check]:
    return [
        *_key("order_id"), Q.not_null("customer_id"), Q.not_null("total_amount"),
        Q.expression("non_negative", "total_amount", "total_amount >= 0"),
        Q.in_set("order_status", V.ORDER_STATUSES),
    ]


def silver_customers_suite() -> list[Q.Check]:
    return [
        *_key("customer_id"), Q.not_null("email_hash"), Q.in_set("loyalty_tier", V.LOYALTY_TIERS),
    ]


def silver_clickstream_suite() -> list[Q.Check]:
    return [*_key("event_id"), Q.in_set("event_type", V.EVENT_TYPES)]


def silver_reviews_suite() -> list[Q.Check]:
    return _key("review_id")


def silver_inventory_suite() -> list[Q.Check]:
    """Inventory is stored as it comes; the checks report what could not be read or repeats."""
    key = ("warehouse_id", "product_sku", "snapshot_ts")
    return [
        *[Q.not_null(c) for c in key], Q.unique_combo(key, Q.WARN),
        Q.not_null("quantity_available", Q.WARN), Q.not_null("reorder_point", Q.WARN),
    ]


def fact_orders_suite(dim_customers: DataFrame, now_ts) -> list[Q.Check]:
    latest = instant(now_ts) + F.expr("INTERVAL 1 HOUR")
    return [
        Q.row_count(1),
        *_key("order_sk"), *_key("order_id"),
        Q.not_null("customer_id"),
        Q.relationships("customer_id", dim_customers, "customer_id", Q.WARN),
        Q.not_null("order_date"),
        Q.expression("not_before_2020", "order_date", "order_date >= timestamp '2020-01-01'"),
        Q.not_null("total_amount"),
        Q.expression("non_negative", "total_amount", "total_amount >= 0"),
        Q.between("total_amount", low=0),
        Q.not_null("order_status"),
        Q.in_set("order_status", V.ORDER_STATUSES),
        Q.in_set("payment_method", V.PAYMENT_METHODS, Q.WARN),
        Q.in_set("shipping_method", V.SHIPPING_METHODS, Q.WARN),
        Q.not_null("customer_sk"),
        Q.not_null("item_count"),
        Q.expression("at_least_one", "item_count", "item_count >= 1"),
        Q.expression("no_future_orders", "order_date", F.col("order_date") <= latest),
    ]


def dim_customers_suite() -> list[Q.Check]:
    return [
        Q.row_count(1),
        *_key("customer_sk"),
        Q.not_null("customer_id"),
        Q.not_null("loyalty_tier"), Q.in_set("loyalty_tier", V.LOYALTY_TIERS),
        Q.not_null("segment"), Q.in_set("segment", V.SEGMENTS),
        Q.not_null("_is_current"), Q.in_set("_is_current", (True, False)),
        Q.not_null("email_hash"), Q.length_equals("email_hash", 64),
        Q.in_set("age_bracket", V.AGE_BRACKETS, Q.WARN),
        Q.expression("valid_range", "loyalty_tier_rank", "loyalty_tier_rank between 1 and 4"),
        Q.one_current("customer_id"),
    ]


def dim_promotions_suite() -> list[Q.Check]:
    return _key("campaign_id")


def customer_ml_features_suite() -> list[Q.Check]:
    scores = []
    for c in ("r_score", "f_score", "m_score"):
        scores += [Q.not_null(c), Q.between(c, 1, 5),
                   Q.expression("valid_range", c, F.col(c).between(1, 5))]
    return [
        Q.row_count(1),
        Q.not_null("customer_id"), Q.not_null("snapshot_date"),
        *scores,
        Q.in_set("churn_risk_tier", V.CHURN_TIERS),
        Q.expression("valid_range", "rfm_total_score", "rfm_total_score between 3 and 15"),
        Q.expression("non_negative", "total_revenue", "total_revenue >= 0"),
        Q.not_null("customer_profile_text"),
        Q.unique_combo(("customer_id", "snapshot_date")),
        Q.expression("has_content", "customer_profile_text", "length(customer_profile_text) > 50"),
    ]


def fact_reviews_suite() -> list[Q.Check]:
    return [
        *_key("review_sk"), *_key("review_id"),
        Q.expression("valid_range", "rating", "rating between 1 and 5"),
    ]
