"""Daily customer features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import retail as R
from tillroll.functions.expressions import day, instant, ratio
from tillroll.operators.aggregates import distinct_values, metric, most_frequent, profile, tally
from tillroll.operators.filters import current_rows

KEY = "customer_id"


def _since(as_of, days: int):
    return F.col("order_date") >= F.date_sub(day(as_of), days).cast("timestamp")


def _flag(test):
    return F.when(test, 1).otherwise(0)


def _order_parts(as_of):
    """name -> (value of one fact row, how fact rows of one order combine)."""
    done, amount = F.col("is_completed") == 1, F.col("total_amount")
    refunded = F.col("order_status") == "refunded"
    parts = {
        "n_orders": (_flag(F.col("order_id").isNotNull()), F.max),
        "n_completed": (_flag(done), F.max),
        "n_cancelled": (_flag(F.col("is_cancelled") == 1), F.max),
        "n_refunded": (_flag(refunded), F.max),
        "n_rows": (F.lit(1), F.sum),
        "revenue": (F.when(done, amount).otherwise(F.lit(0)), F.sum),
        "paid_rows": (_flag(done & amount.isNotNull()), F.sum),
        "refunds": (F.when(refunded, amount).otherwise(F.lit(0)), F.sum),
        "items": (F.col("item_count"), F.sum),
        "item_rows": (_flag(F.col("item_count").isNotNull()), F.sum),
        "weekend_rows": (_flag(F.col("is_weekend")), F.sum),
        "hours": (F.col("order_hour"), F.sum),
        "hour_rows": (_flag(F.col("order_hour").isNotNull()), F.sum),
        "first_at": (F.col("order_date"), F.min),
        "last_at": (F.col("order_date"), F.max),
    }
    for n in (30, 90, 365):
        parts[f"n_{n}d"] = (_flag(_since(as_of, n)), F.max)
        parts[f"revenue_{n}d"] = (F.when(_since(as_of, n), amount).otherwise(F.lit(0)), F.sum)
    return parts


def order_features(fact: DataFrame, as_of, one_row_per_order: bool = False) -> DataFrame:
    """One row per customer over the order fact.

    The many conditional distinct counts are plain sums over one row per (customer,
    order), so nothing is multiplied as it would be with several COUNT(DISTINCT).  When
    the fact is known to hold one row per order, which its merge guarantees and the
    quality suite checks, ``one_row_per_order`` saves that first shuffle.
    Time windows and recency take in every status; revenue counts completed orders.
    """
    parts = _order_parts(as_of)
    habits = ("payment_method", "shipping_method", "utm_source", "order_status")
    rows = fact.filter(F.col(KEY).isNotNull())
    found = {
        "preferred_payment": most_frequent("payment_method"),
        "preferred_shipping": most_frequent("shipping_method"),
        "primary_acquisition_channel": most_frequent("utm_source"),
        "distinct_statuses": distinct_values("order_status"),
    }
    again = {"first_at": F.min, "last_at": F.max}
    if one_row_per_order:
        per_order = rows.select(KEY, *[value.alias(n) for n, (value, _) in parts.items()])
    else:
        per_order = rows.groupBy(KEY, "order_id").agg(
            *[how(value).alias(n) for n, (value, how) in parts.items()])
    # The habits are a second, narrow scan: one pass with the two dozen totals on every unpivoted
    # line took twice as long, as few orders of a customer share all habits.
    totals = per_order.groupBy(KEY).agg(*[again.get(n, F.sum)(n).alias(n) for n in parts])
    both = totals.join(tally(rows, KEY, habits).groupBy(KEY).agg(
        *[c.alias(n) for n, c in found.items()]), KEY, "left")
    return both.select(
        KEY,
        F.col("n_orders").alias("total_orders"),
        F.col("n_completed").alias("completed_orders"),
        F.col("n_cancelled").alias("cancelled_orders"),
        F.col("revenue").alias("total_revenue"),
        ratio("revenue", "paid_rows").alias("avg_order_value"),
        F.col("first_at").alias("first_order_date"),
        F.col("last_at").alias("last_order_date"),
        F.datediff(day(as_of), F.col("last_at").cast("date")).alias("recency_days"),
        *[F.col(f"n_{n}d").alias(f"orders_last_{n}d") for n in (30, 90, 365)],
        *[F.col(f"revenue_{n}d").alias(f"revenue_last_{n}d") for n in (30, 90, 365)],
        F.coalesce("distinct_statuses", F.lit(0)).alias("distinct_statuses"),
        ratio("items", "item_rows").alias("avg_items_per_order"),
        "preferred_payment", "preferred_shipping", "primary_acquisition_channel",
        ratio("weekend_rows", "n_rows").alias("weekend_order_pct"),
        ratio("hours", "hour_rows").alias("avg_order_hour"),
        F.col("n_refunded").alias("total_refunds"),
        F.col("refunds").alias("total_refund_amount"),
        ratio("n_refunded", "n_orders").alias("refund_rate"),
    )


def browse_features(clicks: DataFrame, as_of) -> DataFrame:
    """One row per known customer over the click events; anonymous events are left out first."""
    kind = F.col("event_type")
    known = clicks.filter(F.col(KEY).isNotNull()).withColumn("active_day", F.col("event_ts").cast("date"))
    kinds = {"product_views": "product_view", "cart_adds": "add_to_cart", "searches": "search",
             "checkout_starts": "checkout_start"}
    metrics = {n: (_flag(kind == k), F.sum) for n, k in kinds.items()}
    for c in ("time_on_page_sec", "scroll_depth_pct"):
        metrics |= {f"{c}_sum": (F.col(c), F.sum), f"{c}_rows": (_flag(F.col(c).isNotNull()), F.sum)}
    metrics["last_active_ts"] = (F.col("event_ts"), F.max)
    habits = ("session_id", "active_day", "device_type", "browser", "os")
    both = profile(known, KEY, habits, metrics).groupBy(KEY).agg(
        metric("n").alias("total_events"), *[metric(n).alias(n) for n in kinds],
        *[ratio(metric(f"{c}_sum"), metric(f"{c}_rows")).alias(f"avg_{c}")
          for c in ("time_on_page_sec", "scroll_depth_pct")],
        metric("last_active_ts").alias("last_active_ts"),
        distinct_values("session_id").alias("total_sessions"),
        distinct_values("active_day").alias("active_days"),
        most_frequent("device_type").alias("primary_device"),
        most_frequent("browser").alias("primary_browser"),
        most_frequent("os").alias("primary_os"),
    )
    return both.select(
        KEY,
        F.coalesce("total_sessions", F.lit(0)).alias("total_sessions"),
        ratio("total_sessions", "active_days").alias("sessions_per_active_day"),
        "total_events", "product_views", "cart_adds", "searches", "checkout_starts",
        "avg_time_on_page_sec", "avg_scroll_depth_pct",
        "primary_device", "primary_browser", "primary_os",
        R.engagement_score(
            "product_views", "cart_adds", "checkout_starts", "searches", "total_sessions"
        ).alias("engagement_score_per_session"),
        "last_active_ts",
        F.datediff(day(as_of), F.col("last_active_ts").cast("date")).alias("days_since_last_browse"),
    )


def rfm_scores(features: DataFrame) -> DataFrame:
    scored = features.withColumns({
        "r_score": R.recency_score("recency_days"),
        "f_score": R.frequency_score("orders_last_365d"),
        "m_score": R.monetary_score("revenue_last_365d"),
    })
    return scored.withColumn("rfm_total_score", F.expr("r_score + f_score + m_score"))


def churn_risk(features: DataFrame) -> DataFrame:
    idle = "days_since_last_browse"
    scored = features.withColumn("churn_risk_score", R.churn_score(
        "recency_days", "revenue_last_30d", "revenue_last_90d", "refund_rate", idle))
    return scored.withColumn(
        "churn_risk_tier", R.churn_tier("churn_risk_score", "recency_days", idle))


CUSTOMER_FEATURES = """
  snapshot_date customer_id email_hash loyalty_tier loyalty_tier_rank segment age_bracket
  gender country state tenure_band ltv_band customer_age_days is_email_verified
  total_orders completed_orders cancelled_orders total_revenue avg_order_value
  first_order_date last_order_date recency_days orders_last_30d orders_last_90d
  orders_last_365d revenue_last_30d revenue_last_90d avg_items_per_order
  preferred_payment preferred_shipping primary_acquisition_channel weekend_order_pct
  avg_order_hour total_refunds refund_rate
  total_sessions total_events product_views cart_adds searches avg_time_on_page_sec
  avg_scroll_depth_pct primary_device primary_browser engagement_score_per_session
  days_since_last_browse
  r_score f_score m_score rfm_total_score churn_risk_score churn_risk_tier
  customer_profile_text _feature_created_at _environment
""".split()

_ATTRS = """
  email_hash loyalty_tier loyalty_tier_rank segment age_bracket gender country state
  tenure_band ltv_band customer_age_days is_email_verified
""".split()

_ZERO_WHEN_UNSEEN = """
  total_sessions total_events product_views cart_adds searches avg_time_on_page_sec
  avg_scroll_depth_pct engagement_score_per_session
""".split()


def customer_ml_features(
    fact: DataFrame, dim: DataFrame, clicks: DataFrame, as_of, now_ts,
    environment: str = "dev", one_row_per_order: bool = False,
) -> DataFrame:
    """One row per ordering customer; customers who only browse do not appear.

    The three inputs meet on customer_id, by which both aggregates are already
    partitioned; scores and text are columns of the joined row, not further joins.
    """
    attrs = current_rows(dim).select(KEY, *_ATTRS)
    wide = (
        order_features(fact, as_of, one_row_per_order)
        .join(attrs, KEY, "left")
        .join(browse_features(clicks, as_of), KEY, "left")
    )
    scored = churn_risk(rfm_scores(wide))
    final = {c: F.coalesce(F.col(c), F.lit(0)) for c in _ZERO_WHEN_UNSEEN}
    final |= {
        "snapshot_date": day(as_of),
        "customer_profile_text": R.profile_text(),
        "_feature_created_at": instant(now_ts),
        "_environment": F.lit(environment),
    }
    return scored.withColumns(final).select(*CUSTOMER_FEATURES)
