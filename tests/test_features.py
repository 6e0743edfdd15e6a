import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.plans import features, gold, kpis

AS_OF, NOW = "2024-01-31", "2024-01-31 12:00:00"
STATUSES = ("delivered", "cancelled", "refunded", "shipped")
PAY = ("paypal", "gift_card", None)


@pytest.fixture(scope="module")
def fact_rows():
    rng = random.Random(3)
    out = []
    for i in range(400):
        at = datetime(2024, 1, 31) - timedelta(days=rng.choice([0, 29, 30, 31, 89, 90, 91, 364, 365, 366]),
                                               hours=rng.choice([0, 0, 5]))
        out.append((f"o{i}", f"c{i % 23}", rng.choice(STATUSES), at, float(rng.randrange(1, 900)),
                    rng.choice(PAY), "standard", rng.choice(("google", "email")), rng.randrange(1, 6)))
    return out


@pytest.fixture(scope="module")
def fact(spark, fact_rows):
    df = spark.createDataFrame(
        fact_rows, "order_id string, customer_id string, order_status string, order_date timestamp, "
        "total_amount double, payment_method string, shipping_method string, utm_source string, item_count int")
    return df.withColumns({
        "total_amount": F.col("total_amount").cast("decimal(18,2)"),
        "is_completed": F.expr("int(order_status = 'delivered')"),
        "is_cancelled": F.expr("int(order_status in ('cancelled', 'refunded'))"),
        "is_weekend": F.dayofweek("order_date").isin(1, 7),
        "order_hour": F.hour("order_date"),
    })


def test_order_features_against_brute_force(fact, fact_rows):
    got = {r.customer_id: r for r in features.order_features(fact, AS_OF).collect()}
    midnight = datetime(2024, 1, 31)
    assert len(got) == 23
    for c, r in got.items():
        mine = [x for x in fact_rows if x[1] == c]
        done = [x[4] for x in mine if x[2] == "delivered"]
        assert r.total_orders == len(mine) and r.completed_orders == len(done)
        assert float(r.total_revenue) == sum(done)
        assert r.avg_order_value == (sum(done) / len(done) if done else None)
        for n in (30, 90, 365):
            near = [x for x in mine if x[3] >= midnight - timedelta(days=n)]
            assert r[f"orders_last_{n}d"] == len(near)
            assert float(r[f"revenue_last_{n}d"]) == sum(x[4] for x in near)
        pays = Counter(x[5] for x in mine if x[5])
        assert r.preferred_payment == min(pays, key=lambda p: (-pays[p], p))
        assert r.recency_days == (midnight.date() - max(x[3] for x in mine).date()).days
        assert r.refund_rate == sum(x[2] == "refunded" for x in mine) / len(mine)
        assert r.distinct_statuses == len({x[2] for x in mine})
        assert r.avg_items_per_order == pytest.approx(sum(x[8] for x in mine) / len(mine))


def test_the_short_cut_gives_the_same_rows(fact):
    a = features.order_features(fact, AS_OF)
    b = features.order_features(fact, AS_OF, one_row_per_order=True)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_repeated_order_rows_count_once(fact):
    twice = fact.unionByName(fact)
    a = {r.customer_id: r.total_orders for r in features.order_features(fact, AS_OF).collect()}
    b = {r.customer_id: r.total_orders for r in features.order_features(twice, AS_OF).collect()}
    assert a == b


def test_feature_table(spark, fact):
    clicks = spark.createDataFrame(
        [("c1", "s1", datetime(2024, 1, 30), "product_view", "mobile", "Chrome", "iOS", 10, 50),
         ("c1", "s1", datetime(2024, 1, 30, 1), "add_to_cart", "mobile", "Chrome", "iOS", 20, None),
         ("c1", "s2", datetime(2024, 1, 29), "search", "desktop", "Edge", "iOS", None, 70),
         (None, "s3", datetime(2024, 1, 29), "search", "desktop", "Edge", "iOS", 1, 1),
         ("only_clicks", "s4", datetime(2024, 1, 29), "search", "desktop", "Edge", "iOS", 1, 1)],
        "customer_id string, session_id string, event_ts timestamp, event_type string, "
        "device_type string, browser string, os string, time_on_page_sec int, scroll_depth_pct int")
    dim = spark.createDataFrame(
        [("c1", True), ("c1", False), ("c2", True)], "customer_id string, _is_current boolean"
    ).withColumns({c: F.lit("v") for c in (
        "email_hash", "loyalty_tier", "segment", "age_bracket", "gender", "country", "state",
        "tenure_band", "ltv_band")} | {
        "loyalty_tier_rank": F.lit(1), "customer_age_days": F.lit(9), "is_email_verified": F.lit(True)})
    table = features.customer_ml_features(fact, dim, clicks, AS_OF, NOW)
    assert table.columns == features.CUSTOMER_FEATURES and len(table.columns) == 55
    got = {r.customer_id: r for r in table.collect()}
    assert len(got) == 23 and "only_clicks" not in got
    c1, c2, c3 = got["c1"], got["c2"], got["c3"]
    assert (c1.total_sessions, c1.total_events, c1.primary_device) == (2, 3, "mobile")
    assert c1.engagement_score_per_session == (1 + 3 + 2) / 2
    assert (c1.avg_time_on_page_sec, c1.avg_scroll_depth_pct) == (15.0, 60.0)
    assert c1.customer_profile_text.startswith("Customer v v in v, v. Loyalty: v. Segment: v. Member for 9 days.")
    assert "Preferred device: mobile." in c1.customer_profile_text
    assert "Preferred device: unknown." in c2.customer_profile_text
    assert (c2.total_sessions, c2.days_since_last_browse) == (0, None)
    assert c3.customer_profile_text is None and c3.loyalty_tier is None


def test_unknown_customer_and_campaign(spark, fact):
    dim = spark.createDataFrame(
        [("c1", "sk1", True, "gold")], "customer_id string, customer_sk string, _is_current boolean, "
        "loyalty_tier string").withColumns({c: F.lit("v") for c in (
            "segment", "age_bracket", "country", "preferred_device")})
    got = gold.join_customers(fact, dim).groupBy("customer_sk", "customer_loyalty_tier").count().collect()
    assert {(r.customer_sk, r.customer_loyalty_tier) for r in got} == {("sk1", "gold"), ("-1", "unknown")}
    orders = fact.withColumn("utm_campaign", F.when(F.col("utm_source") == "google", "x"))
    promos = spark.createDataFrame([("x", "email", "tv")], "campaign_id string, campaign_type string, channel string")
    joined = gold.join_promotions(orders, promos).select("channel", "utm_source").distinct().collect()
    assert {tuple(r) for r in joined} == {("tv", "google"), ("unknown", "email")}


def test_health_is_fresh_at_zero_hours_and_stale_without_rows(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 31, 12))], "order_id string, _processed_ts timestamp")
    df = df.withColumn("order_date_day", F.to_date("_processed_ts"))
    assert kpis.load_health(df, NOW).first().status == "healthy"
    assert kpis.load_health(df.limit(0), NOW).first().status == "stale"
