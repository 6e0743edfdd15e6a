"""Fixed values of the retail data model.

Everything in this module is a fixed value: names, enumerations, limits and
formats that a result must carry to mean the same thing everywhere.  No logic
lives here.
"""

# --- fixed values: enumerations -------------------------------------------------

ORDER_STATUSES = (
    "pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded",
)
EVENT_TYPES = (
    "page_view", "product_view", "add_to_cart", "remove_from_cart", "checkout_start",
    "search", "wishlist_add", "review_view", "click",
)
LOYALTY_TIERS = ("bronze", "silver", "gold", "platinum")
SEGMENTS = ("bargain_hunter", "loyal", "at_risk", "new", "vip", "dormant")
AGE_BRACKETS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
PAYMENT_METHODS = (
    "credit_card", "debit_card", "paypal", "apple_pay", "google_pay",
    "buy_now_pay_later", "gift_card",
)
SHIPPING_METHODS = ("standard", "express", "overnight", "pickup", "same_day")
CHURN_TIERS = ("low", "medium", "high")

TOPICS = ("orders", "clickstream", "inventory-events", "product-reviews", "user-sessions")
ENTITIES = ("orders", "customers", "clickstream", "inventory", "reviews")
REQUIRED_ENTITIES = ("orders", "clickstream")

# --- fixed values: ladders, read as "below the limit -> label", last label is the rest

ORDER_VALUE_LADDER = ((25, "micro"), (100, "small"), (250, "medium"), (500, "large"))
ORDER_VALUE_TOP = "whale"
REVENUE_LADDER = ORDER_VALUE_LADDER + ((2000, "premium"),)
REVENUE_TOP = "whale"
LTV_LADDER = ((0, "inactive"), (100, "low"), (500, "medium"), (2000, "high"))
LTV_TOP = "vip"
AGE_LADDER = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
AGE_TOP = "65+"
FRESHNESS_LADDER = ((6, "healthy"), (24, "degraded"))
FRESHNESS_TOP = "stale"
FRESHNESS_UNKNOWN_HOURS = 999.0

# --- fixed values: ladders read as "up to and including the limit -> label"

TENURE_STEPS = ((30, "new"), (180, "recent"), (365, "established"))
TENURE_TOP = "veteran"
RECENCY_STEPS = ((7, 5), (30, 4), (90, 3), (180, 2))

# --- fixed values: ladders read as "at least the limit -> score", 1 is the rest

FREQUENCY_STEPS = ((24, 5), (12, 4), (6, 3), (2, 2))
MONETARY_STEPS = ((5000, 5), (2000, 4), (500, 3), (100, 2))

# --- fixed values: lookups

LOYALTY_RANK = {"bronze": 1, "silver": 2, "gold": 3, "platinum": 4}
CAMPAIGN_TYPE = {
    "cpc": "paid_search", "social": "paid_social", "email": "email", "organic": "organic",
}
ENGAGEMENT_WEIGHTS = {
    "product_view": 1.0, "add_to_cart": 3.0, "checkout_start": 5.0, "search": 2.0,
}

# --- fixed values: churn points

CHURN_LONG_RECENCY = ((90, 3), (30, 1))     # more than n days -> points
CHURN_FALLING_SPEND = 2
CHURN_REFUND_RATE = 0.3
CHURN_REFUND_POINTS = 2
CHURN_BROWSE_DAYS = 60
CHURN_BROWSE_POINTS = 2
CHURN_NO_BROWSE_DAYS = 999
CHURN_HIGH = 6
CHURN_MEDIUM = 3

# --- fixed values: misc

PIPELINE_VERSION = "1.0.0"
UNKNOWN_KEY = "-1"
UNKNOWN = "unknown"
KEY_SEPARATOR = "|"
KEY_NULL = "null"
HOLIDAY_MONTHS = (11, 12, 1, 2)
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2030-12-31"
FLUSH_SECONDS = 30

# --- fixed values: raw record layouts (DDL)

ITEM_DDL = """
  order_item_id string, product_sku string, product_name string, category string,
  subcategory string, quantity int, unit_price double, discount_amount double,
  total_price double, warehouse_id string
"""

ORDERS_DDL = f"""
  order_id string, customer_id string, order_status string, order_date string,
  updated_at string, items array<struct<{ITEM_DDL}>>,
  subtotal double, discount_total double, shipping_fee double, tax_amount double,
  total_amount double, payment_method string, payment_status string,
  shipping_method string, shipping_address_city string, shipping_address_state string,
  shipping_address_country string, estimated_delivery_date string,
  actual_delivery_date string, session_id string, utm_source string, utm_medium string,
  utm_campaign string, is_gift boolean, notes string, _ingestion_ts string, _source string
"""

CUSTOMERS_DDL = """
  customer_id string, email string, email_hash string, first_name string,
  last_name string, phone string, phone_hash string, date_of_birth string,
  age_bracket string, gender string, country string, city string, state string,
  postal_code string, registration_date string, loyalty_tier string, total_orders int,
  ltv_usd double, is_email_verified boolean, preferred_device string, segment string
"""

CLICKSTREAM_DDL = """
  event_id string, session_id string, customer_id string, event_type string,
  event_ts string, page_url string, referrer_url string, product_sku string,
  product_category string, search_query string, device_type string, browser string,
  os string, ip_hash string, user_agent string, viewport_width int, viewport_height int,
  scroll_depth_pct int, time_on_page_sec int, utm_source string, utm_medium string,
  _ingestion_ts string, _partition_key string
"""

INVENTORY_DDL = """
  snapshot_ts string, warehouse_id string, product_sku string, quantity_on_hand string,
  quantity_reserved string, quantity_available string, reorder_point string,
  reorder_quantity string, unit_cost string, last_received_date string, supplier_id string
"""

REVIEWS_DDL = """
  review_id string, customer_id string, customer_email_hash string, product_sku string,
  product_name string, rating string, title string, body string, review_date string,
  verified_purchase string, helpful_votes string, images_count string, sentiment string
"""

INVENTORY_EVENTS_DDL = """
  event_id string, event_type string, event_ts string, warehouse_id string,
  product_sku string, quantity_change int, new_quantity int, triggered_by string,
  _ingestion_ts string
"""

# Nullable fields of the click event contract; every other field is required there.
CLICKSTREAM_OPTIONAL = (
    "customer_id", "referrer_url", "product_sku", "product_category", "search_query",
    "scroll_depth_pct", "time_on_page_sec", "utm_source", "utm_medium",
)

# The profile sentence, as (text, column that follows it).
PROFILE = (
    ("Customer ", "age_bracket"), (" ", "gender"), (" in ", "state"), (", ", "country"),
    (". Loyalty: ", "loyalty_tier"), (". Segment: ", "segment"),
    (". Member for ", "customer_age_days"), (" days. Total orders: ", "total_orders"),
    (", LTV: $", "ltv"), (", Last purchase: ", "recency_days"),
    (" days ago. Preferred payment: ", "payment"), (". Preferred device: ", "device"),
)
