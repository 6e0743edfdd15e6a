"""Business expressions: bands, order flags, delivery, scores, profile text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import (
    as_col, at_least, below, day, looked_up, more_than, ratio, up_to,
)

# --- bands ----------------------------------------------------------------------


def order_value_band(amount: Column | str) -> Column:
    return below(amount, V.ORDER_VALUE_LADDER, V.ORDER_VALUE_TOP)


def revenue_band(amount: Column | str) -> Column:
    return below(amount, V.REVENUE_LADDER, V.REVENUE_TOP)


def ltv_band(ltv: Column | str) -> Column:
    return below(ltv, V.LTV_LADDER, V.LTV_TOP)


def tenure_days(registered: Column | str, as_of) -> Column:
    return F.datediff(day(as_of), as_col(registered))


def tenure_band(registered: Column | str, as_of) -> Column:
    return up_to(tenure_days(registered, as_of), V.TENURE_STEPS, V.TENURE_TOP)


def loyalty_rank(tier: Column | str) -> Column:
    return looked_up(tier, V.LOYALTY_RANK, 0)


def campaign_type(medium: Column | str) -> Column:
    return looked_up(medium, V.CAMPAIGN_TYPE, "other")


def freshness_status(hours: Column | str) -> Column:
    """Missing hours count as unknown, which is stale; zero hours are fresh."""
    known = F.coalesce(as_col(hours), F.lit(V.FRESHNESS_UNKNOWN_HOURS))
    return below(known, V.FRESHNESS_LADDER, V.FRESHNESS_TOP)


# --- one order ------------------------------------------------------------------


def gross_margin(total, discount, shipping, tax) -> Column:
    """Total less discount, shipping and tax.  The total is already net of the discount."""
    return as_col(total) - as_col(discount) - as_col(shipping) - as_col(tax)


def delivery_days(ordered, estimated, actual) -> Column:
    """Calendar days from the order to the real, else the promised, delivery."""
    arrived = F.coalesce(as_col(actual), as_col(estimated))
    return F.datediff(arrived, as_col(ordered).cast("date"))


def on_time(estimated, actual) -> Column:
    return F.coalesce(as_col(actual) <= as_col(estimated), F.lit(False))


def is_completed(status: Column | str) -> Column:
    return F.when(as_col(status) == "delivered", 1).otherwise(0)


def is_cancelled(status: Column | str) -> Column:
    return F.when(as_col(status).isin("cancelled", "refunded"), 1).otherwise(0)


def refund_amount(status: Column | str, amount: Column | str) -> Column:
    value = as_col(amount)
    return F.when(as_col(status) == "refunded", value).otherwise(F.lit(0))


# --- one customer ---------------------------------------------------------------


def engagement_score(views, carts, checkouts, searches, sessions) -> Column:
    """Weighted event counts per session."""
    w = V.ENGAGEMENT_WEIGHTS
    points = (
        as_col(views) * w["product_view"]
        + as_col(carts) * w["add_to_cart"]
        + as_col(checkouts) * w["checkout_start"]
        + as_col(searches) * w["search"]
    )
    return ratio(points, sessions)


def recency_score(days: Column | str) -> Column:
    return up_to(days, V.RECENCY_STEPS, 1)


def frequency_score(orders: Column | str) -> Column:
    return at_least(orders, V.FREQUENCY_STEPS, 1)


def monetary_score(revenue: Column | str) -> Column:
    return at_least(revenue, V.MONETARY_STEPS, 1)


def _recency_points(days: Column | str) -> Column:
    return more_than(days, V.CHURN_LONG_RECENCY, 0)


def _browse_points(days: Column | str) -> Column:
    idle = F.coalesce(as_col(days), F.lit(V.CHURN_NO_BROWSE_DAYS))
    return F.when(idle > V.CHURN_BROWSE_DAYS, V.CHURN_BROWSE_POINTS).otherwise(0)


def churn_score(recency, spend_30d, spend_90d, refund_rate, browse_days) -> Column:
    # a third of the 90-day spend, compared without dividing
    falling = as_col(spend_30d) * 3 < as_col(spend_90d)
    return (
        _recency_points(recency)
        + F.when(falling, V.CHURN_FALLING_SPEND).otherwise(0)
        + F.when(as_col(refund_rate) > V.CHURN_REFUND_RATE, V.CHURN_REFUND_POINTS).otherwise(0)
        + _browse_points(browse_days)
    )


def churn_tier(score, recency, browse_days) -> Column:
    quiet = _recency_points(recency) + _browse_points(browse_days)
    return (
        F.when(as_col(score) >= V.CHURN_HIGH, "high")
        .when(quiet >= V.CHURN_MEDIUM, "medium")
        .otherwise("low")
    )


def profile_text() -> Column:
    """Sentence over the feature columns; any missing attribute makes it NULL.

    Payment and device fall back to 'unknown'.
    """
    made = {
        "ltv": F.round(F.col("total_revenue"), 0).cast("decimal(18,0)"),
        "payment": F.coalesce(F.col("preferred_payment"), F.lit(V.UNKNOWN)),
        "device": F.coalesce(F.col("primary_device"), F.lit(V.UNKNOWN)),
    }
    pieces = [x for text, name in V.PROFILE for x in (F.lit(text), made.get(name, F.col(name)).cast("string"))]
    return F.concat(*pieces, F.lit("."))
