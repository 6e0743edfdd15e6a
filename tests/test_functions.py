from datetime import date

import pytest
from pyspark.sql import functions as F

from tillroll.functions import expressions as X
from tillroll.functions import keys, privacy, retail


def values(spark, data, dtype, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {dtype}")
    rows = df.select("i", *[e.alias(f"e{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    out = [tuple(r)[1:] for r in rows]
    return [o[0] for o in out] if len(exprs) == 1 else out


def test_postal_prefix(spark):
    got = values(spark, ["12345-6789", "12", None, " 9-8 ", "abc", ""], "string",
                 privacy.postal_prefix("x"))
    assert got == ["123**", "***", None, "***", "abc**", "***"]


def test_mask_email(spark):
    got = values(spark, ["jane@shop.com", "a@b.c", "@b.c", "no-at", "a@b@c", None, "ab@"], "string",
                 privacy.mask_email("x"))
    assert got == ["j***e@shop.com", "a***@b.c", "***@b.c", "***@***", "***@***", None, "a***b@"]


def test_hashes(spark):
    got = values(spark, [" A "], "string", privacy.hash_pii("x", "s"), privacy.sha_lower("x"),
                 privacy.sha("x"))
    import hashlib
    assert got == [(hashlib.md5(b"as").hexdigest(), hashlib.sha256(b" a ").hexdigest(),
                    hashlib.sha256(b" A ").hexdigest())]


def test_age_bracket(spark):
    born = [date(2024 - y, 1, 31) for y in (24, 26, 36, 46, 56, 70)] + [None]
    got = values(spark, born, "date", privacy.age_bracket("x", "2024-01-31"))
    assert got == ["18-24", "25-34", "35-44", "45-54", "55-64", "65+", None]


def test_keys_treat_nulls_differently(spark):
    import hashlib
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    lit = F.lit("k")
    got = values(spark, [None, "v"], "string", keys.surrogate_key(lit, "x"), keys.record_hash(lit, "x"))
    assert got == [(md5("k|null"), md5("k")), (md5("k|v"), md5("k|v"))]


@pytest.mark.parametrize("fn,data,want", [
    (retail.order_value_band, [24.99, 25, 99.99, 100, 249, 250, 499.99, 500, None],
     ["micro", "small", "small", "medium", "medium", "large", "large", "whale", "whale"]),
    (retail.revenue_band, [500, 1999.99, 2000], ["premium", "premium", "whale"]),
    (retail.ltv_band, [-1, 0, 100, 500, 2000, None], ["inactive", "low", "medium", "high", "vip", "vip"]),
    (retail.recency_score, [7, 8, 30, 31, 90, 91, 180, 181], [5, 4, 4, 3, 3, 2, 2, 1]),
    (retail.frequency_score, [1, 2, 6, 12, 24], [1, 2, 3, 4, 5]),
    (retail.monetary_score, [99.99, 100, 500, 2000, 5000], [1, 2, 3, 4, 5]),
    (retail.freshness_status, [0.0, 5.9, 6.0, 24.0, None],
     ["healthy", "healthy", "degraded", "stale", "stale"]),
])
def test_ladders(spark, fn, data, want):
    data = [None if v is None else float(v) for v in data]
    assert values(spark, data, "double", fn("x")) == want


def test_tenure_band(spark):
    got = values(spark, [date(2024, 1, 1), date(2023, 12, 31), date(2023, 2, 1), date(2022, 1, 1)],
                 "date", retail.tenure_band("x", "2024-01-31"))
    assert got == ["new", "recent", "established", "veteran"]


def test_lookups(spark):
    assert values(spark, ["cpc", "tv", None], "string", retail.campaign_type("x")) == [
        "paid_search", "other", "other"]
    assert values(spark, ["gold", "x", None], "string", retail.loyalty_rank("x")) == [3, 0, 0]


def test_ratios(spark):
    got = values(spark, [2.0, 0.0, None], "double", X.ratio(F.lit(1), "x"),
                 X.safe_divide(F.lit(1), "x", -1))
    assert got == [(0.5, 0.5), (None, -1.0), (None, -1.0)]


def test_safe_divide_keeps_a_missing_numerator(spark):
    assert values(spark, [None], "double", X.safe_divide("x", F.lit(2), 7)) == [None]


def test_tolerant_parsing(spark):
    got = values(spark, ["2024-01-02T03:04:05", "2024-13-01", "x", None], "string",
                 X.parse_ts("x").cast("string"), X.parse_day("x"), X.parse_as("x", "int"))
    assert got[0] == ("2024-01-02 03:04:05", date(2024, 1, 2), None)
    assert got[1:] == [(None, None, None)] * 3


def test_churn_boundaries(spark):
    rows = [
        # recency, rev30, rev90, refund rate, browse days -> score, tier
        (30, 10.0, 30.0, 0.3, 60, 0, "low"),          # exactly a third is not falling
        (31, 9.99, 30.0, 0.3, 61, 5, "medium"),
        (91, 0.0, 0.0, 0.31, None, 7, "high"),
        (91, 0.0, 0.0, 0.0, 1, 3, "medium"),
        (1, 0.0, 3.0, 0.9, 1, 4, "low"),
    ]
    df = spark.createDataFrame(
        rows, "a int, b double, c double, d double, e int, score int, tier string")
    df = df.withColumn("got", retail.churn_score("a", "b", "c", "d", "e"))
    df = df.withColumn("got_tier", retail.churn_tier("got", "a", "e"))
    for r in df.collect():
        assert (r.got, r.got_tier) == (r.score, r.tier)
