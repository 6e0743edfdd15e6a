"""Bronze to silver: type, validate, enrich, mask and deduplicate the five entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import instant, money, parse_as, parse_day, parse_ts
from tillroll.functions.keys import record_hash
from tillroll.functions.privacy import postal_prefix
from tillroll.operators.dedup import dedup_first, dedup_latest, top1_by
from tillroll.operators.filters import is_valid_order, valid_clickstream, valid_reviews

PARTITIONS = {
    "orders": ("order_year", "order_month", "order_day"),
    "customers": ("registration_year", "registration_month"),
    "clickstream": ("event_year", "event_month", "event_day"),
    "inventory": ("snapshot_year", "snapshot_month", "snapshot_date"),
    "reviews": ("review_year", "review_month"),
}

_ORDER_MONEY = ("subtotal", "discount_total", "shipping_fee", "tax_amount", "total_amount")
_ITEM_MONEY = ("unit_price", "discount_amount", "total_price")


def _item_cents(item):
    for name in _ITEM_MONEY:
        item = item.withField(name, money(item[name]))
    return item


# --- orders ---------------------------------------------------------------------


def cast_orders(df: DataFrame) -> DataFrame:
    """Times and dates from ISO text, money to cents."""
    typed = {c: parse_ts(c) for c in ("order_date", "updated_at", "_ingestion_ts")}
    typed |= {c: parse_day(c) for c in ("estimated_delivery_date", "actual_delivery_date")}
    typed |= {c: money(c) for c in _ORDER_MONEY}
    return df.withColumns(typed | {"items": F.transform("items", _item_cents)})


def enrich_orders(df: DataFrame, now_ts) -> DataFrame:
    at = F.col("order_date")
    return df.withColumns({
        "order_year": F.year(at),
        "order_month": F.month(at),
        "order_day": F.dayofmonth(at),
        "order_hour": F.hour(at),
        "order_dayofweek": F.dayofweek(at),               # 1 is Sunday
        "is_weekend": F.dayofweek(at).isin(1, 7),
        "item_count": F.coalesce(F.size("items"), F.lit(0)),
        "has_discount": F.col("discount_total") > 0,
        "_processed_ts": instant(now_ts),
        "_pipeline_version": F.lit(V.PIPELINE_VERSION),
    })


def silver_orders(raw: DataFrame, now_ts) -> DataFrame:
    """Newest version per order (by the text of updated_at), then typed, validated, enriched.

    An order whose newest version is invalid is left out, older versions notwithstanding.
    """
    return order_versions(raw, now_ts).filter("not _invalid").drop("_invalid")


def order_versions(raw: DataFrame, now_ts) -> DataFrame:
    """Newest version per order, typed and enriched; ``_invalid`` marks those without a silver row."""
    return typed_versions(dedup_latest(raw, "order_id", "updated_at"), now_ts)


def typed_versions(newest: DataFrame, now_ts) -> DataFrame:
    """Chosen order versions, typed and enriched, with ``_invalid``."""
    marked = cast_orders(newest).withColumn("_invalid", ~F.coalesce(is_valid_order(), F.lit(False)))
    return enrich_orders(marked, now_ts)


# --- customers ------------------------------------------------------------------


def mask_customers(df: DataFrame) -> DataFrame:
    """Names and contacts go; the postal code is shortened and only the birth year stays."""
    coarse = df.withColumns({
        "postal_code_prefix": postal_prefix("postal_code"),
        "birth_year": F.year(parse_day("date_of_birth")),
    })
    return coarse.drop(
        "email", "first_name", "last_name", "phone", "postal_code", "date_of_birth"
    )


def customer_scd_meta(df: DataFrame, now_ts) -> DataFrame:
    registered = parse_day("registration_date")
    return df.withColumns({
        "registration_date": registered,
        "registration_year": F.year(registered),
        "registration_month": F.month(registered),
        "ltv_usd": money("ltv_usd"),
        "_valid_from": instant(now_ts),
        "_valid_to": F.lit(None).cast("timestamp"),
        "_is_current": F.lit(True),
        "_record_hash": record_hash("customer_id", "loyalty_tier", "segment", "total_orders"),
        "_processed_ts": instant(now_ts),
    })


def silver_customers(raw: DataFrame, now_ts) -> DataFrame:
    """One masked row per customer: the one registered last."""
    known = raw.filter(F.col("customer_id").isNotNull())
    one = top1_by(known, "customer_id", [F.col("registration_date").desc_nulls_last()])
    return customer_scd_meta(mask_customers(one), now_ts)


# --- clickstream ----------------------------------------------------------------


def cast_clickstream(df: DataFrame) -> DataFrame:
    at = parse_ts("event_ts")
    return df.withColumns({"event_ts": at, "_ingestion_ts": parse_ts("_ingestion_ts")}).withColumns({
        "event_date": F.col("event_ts").cast("date"),
        "event_hour": F.hour("event_ts"),
        "event_year": F.year("event_ts"),
        "event_month": F.month("event_ts"),
        "event_day": F.dayofmonth("event_ts"),
    })


def silver_clickstream(raw: DataFrame, now_ts) -> DataFrame:
    """First delivery of each event, typed, then validated."""
    first = dedup_first(raw, "event_id", ["_ingestion_ts"])
    return valid_clickstream(cast_clickstream(first)).withColumn("_processed_ts", instant(now_ts))


# --- inventory ------------------------------------------------------------------


def cast_inventory(df: DataFrame) -> DataFrame:
    whole = ("quantity_on_hand", "quantity_reserved", "quantity_available", "reorder_point",
             "reorder_quantity")
    typed = {c: parse_as(c, "int") for c in whole}
    typed |= {
        "unit_cost": money("unit_cost"),
        "snapshot_ts": parse_ts("snapshot_ts"),
        "last_received_date": parse_day("last_received_date"),
    }
    free = F.col("quantity_available")
    return df.withColumns(typed).withColumns({
        "is_low_stock": free <= F.col("reorder_point"),
        "is_out_of_stock": free == 0,
        "snapshot_date": F.col("snapshot_ts").cast("date"),
        "snapshot_year": F.year("snapshot_ts"),
        "snapshot_month": F.month("snapshot_ts"),
    })


def silver_inventory(raw: DataFrame, now_ts) -> DataFrame:
    return cast_inventory(raw).withColumn("_processed_ts", instant(now_ts))


# --- reviews --------------------------------------------------------------------


def cast_reviews(df: DataFrame) -> DataFrame:
    typed = {c: parse_as(c, "int") for c in ("rating", "helpful_votes", "images_count")}
    typed |= {
        "verified_purchase": F.col("verified_purchase").cast("string") == "true",
        "review_date": parse_day("review_date"),
    }
    return df.withColumns(typed).withColumns({
        "review_year": F.year("review_date"),
        "review_month": F.month("review_date"),
    })


def clean_reviews(raw: DataFrame, now_ts) -> DataFrame:
    """Typed, validated, then the first copy of each review."""
    valid = valid_reviews(cast_reviews(raw))
    first = dedup_first(valid, "review_id", ["review_date"])
    return first.withColumn("_processed_ts", instant(now_ts))


def silver_reviews(cleaned: DataFrame) -> DataFrame:
    """The published review columns."""
    dtypes = {"rating": "int", "review_date": "date", "helpful_votes": "int", "images_count": "int"}
    names = (
        "review_id", "customer_id", "customer_email_hash", "product_sku", "product_name",
        "rating", "title", "body", "review_date", "verified_purchase", "helpful_votes",
        "images_count", "sentiment",
    )
    return cleaned.filter(F.col("review_id").isNotNull()).select(
        *[parse_as(n, dtypes[n]).alias(n) if n in dtypes else F.col(n) for n in names]
    )
