"""Silver to gold: dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions import retail as R
from tillroll.functions.expressions import instant
from tillroll.functions.keys import surrogate_key
from tillroll.operators.aggregates import mode_tuple_by
from tillroll.operators.filters import current_rows
from tillroll.operators.joins import PIECE_ROWS, join_versions, lookup_join

_CUSTOMER_ATTRS = ("loyalty_tier", "segment", "age_bracket", "country", "preferred_device")


# --- dimensions -----------------------------------------------------------------


def dim_customers(history: DataFrame, as_of, now_ts) -> DataFrame:
    """All versions of the customer history with derived bands."""
    registered = "registration_date"
    return history.select(
        surrogate_key("customer_id", "_valid_from").alias("customer_sk"),
        "customer_id", "email_hash", "phone_hash", "age_bracket", "birth_year", "gender",
        "country", "state", "postal_code_prefix", "loyalty_tier", "segment",
        R.loyalty_rank("loyalty_tier").alias("loyalty_tier_rank"),
        "total_orders", "ltv_usd", "is_email_verified", "preferred_device",
        registered, "registration_year", "registration_month",
        R.tenure_days(registered, as_of).alias("customer_age_days"),
        R.tenure_band(registered, as_of).alias("tenure_band"),
        R.ltv_band("ltv_usd").alias("ltv_band"),
        "_valid_from", "_valid_to", "_is_current", "_record_hash",
        instant(now_ts).alias("_dbt_updated_at"),
    )


def campaign_totals(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("utm_campaign").isNotNull())
        .groupBy(F.col("utm_campaign").alias("campaign_id"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("total_amount").alias("total_revenue"),
        )
    )


def campaign_channel_mode(orders: DataFrame) -> DataFrame:
    """Most frequent (source, medium) pair per campaign."""
    return mode_tuple_by(
        orders.withColumnRenamed("utm_campaign", "campaign_id"), "campaign_id",
        ("utm_source", "utm_medium"),
    )


def dim_promotions(orders: DataFrame, now_ts) -> DataFrame:
    """One row per campaign."""
    both = campaign_totals(orders).join(campaign_channel_mode(orders), "campaign_id", "left")
    return both.select(
        surrogate_key("campaign_id").alias("promotion_sk"),
        "campaign_id",
        F.col("campaign_id").alias("campaign_name"),
        F.col("utm_source").alias("channel"),
        R.campaign_type("utm_medium").alias("campaign_type"),
        "utm_medium", "total_orders", "total_revenue",
        instant(now_ts).alias("_dbt_updated_at"),
    )


# --- facts ----------------------------------------------------------------------


def order_measures(orders: DataFrame) -> DataFrame:
    """The part of the order fact that needs no lookup: keys, days, flags, bands."""
    day_of = F.col("order_date").cast("date")
    status, total = "order_status", "total_amount"
    return orders.withColumns({
        "order_sk": surrogate_key("order_id"),
        "order_date_day": day_of,
        "delivery_days": R.delivery_days(
            "order_date", "estimated_delivery_date", "actual_delivery_date"),
        "is_on_time_delivery": R.on_time("estimated_delivery_date", "actual_delivery_date"),
        "gross_margin_usd": R.gross_margin(total, "discount_total", "shipping_fee", "tax_amount"),
        "is_completed": R.is_completed(status),
        "is_cancelled": R.is_cancelled(status),
        "refund_amount": R.refund_amount(status, total),
        "order_value_band": R.order_value_band(total),
    })


def join_customers(
    orders: DataFrame, dim: DataFrame, piece_rows: int = PIECE_ROWS,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Attributes of the current customer row; unknown customers get the unknown member."""
    side = current_rows(dim).select(
        "customer_id", "customer_sk", *[F.col(c).alias(f"customer_{c}") for c in _CUSTOMER_ATTRS]
    )
    joined = lookup_join(
        orders, side, "customer_id", "order_id", piece_rows, profile)
    return _fill_customer(joined)


def join_customers_asof(orders: DataFrame, dim: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Attributes of the customer row that was valid when the order was placed."""
    side = dim.select(
        "customer_id", "customer_sk", "_valid_from", "_valid_to",
        *[F.col(c).alias(f"customer_{c}") for c in _CUSTOMER_ATTRS],
    )
    joined = join_versions(orders, side, "customer_id", "order_date", "order_id", piece_rows)
    return _fill_customer(joined.drop("_valid_from", "_valid_to"))


def _fill_customer(joined: DataFrame) -> DataFrame:
    filled = {"customer_sk": F.coalesce("customer_sk", F.lit(V.UNKNOWN_KEY))}
    for c in _CUSTOMER_ATTRS:
        filled[f"customer_{c}"] = F.coalesce(f"customer_{c}", F.lit(V.UNKNOWN))
    return joined.withColumns(filled)


def join_dates(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Date keys of the order day and of the real delivery day.

    The calendar has one row per day of a fixed range; adaptive execution sees that it is small.
    """
    placed = dates.select(
        F.col("full_date").alias("order_date_day"), F.col("date_sk").alias("order_date_sk"))
    arrived = dates.select(
        F.col("full_date").alias("actual_delivery_date"), F.col("date_sk").alias("delivery_date_sk"))
    return orders.join(placed, "order_date_day", "left").join(
        arrived, "actual_delivery_date", "left")


def join_promotions(
    orders: DataFrame, promos: DataFrame, piece_rows: int = PIECE_ROWS,
    profile: DataFrame | None = None,
) -> DataFrame:
    side = promos.select(F.col("campaign_id").alias("utm_campaign"), "campaign_type", "channel")
    joined = lookup_join(
        orders, side, "utm_campaign", "order_id", piece_rows, profile)
    return joined.withColumns({
        c: F.coalesce(c, F.lit(V.UNKNOWN)) for c in ("campaign_type", "channel")
    })


FACT_ORDERS = """
  order_sk order_id customer_id session_id customer_sk order_date_sk delivery_date_sk
  order_date order_date_day estimated_delivery_date actual_delivery_date delivery_days
  is_on_time_delivery order_status payment_status payment_method shipping_method
  shipping_address_city shipping_address_state shipping_address_country
  utm_source utm_medium utm_campaign campaign_type channel
  subtotal discount_total shipping_fee tax_amount total_amount gross_margin_usd
  is_gift has_discount item_count
  customer_loyalty_tier customer_segment customer_age_bracket customer_country
  customer_preferred_device
  order_year order_month order_day order_hour order_dayofweek is_weekend
  is_completed is_cancelled refund_amount order_value_band
  _ingestion_ts _processed_ts _pipeline_version _dbt_updated_at
""".split()


def fact_orders(
    orders: DataFrame, customers: DataFrame, dates: DataFrame, promos: DataFrame, now_ts,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """One row per order with its customer, date and campaign keys.

    Hot customers and campaigns are looked for in ``orders`` itself, which is a scan of
    one column, not in the joined rows.  The measures are taken after the joins, so that
    they need not be shuffled.
    """
    plain = orders.drop("items").withColumn("order_date_day", F.col("order_date").cast("date"))
    known = join_customers(plain, customers, piece_rows, profile=orders)
    dated = join_dates(known, dates)
    full = join_promotions(dated, promos, piece_rows, profile=orders)
    return order_measures(full).withColumn("_dbt_updated_at", instant(now_ts)).select(*FACT_ORDERS)


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        surrogate_key("review_id").alias("review_sk"),
        "review_id", "customer_id", "product_sku", "rating", "verified_purchase",
        "helpful_votes", "images_count", "sentiment", "review_date",
    )
