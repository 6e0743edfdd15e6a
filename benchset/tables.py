"""The given tables dressed as retail data.

``ORDERS`` .. ``REVIEWS`` are typed views whose SQL text runs on Spark and DuckDB alike
(``{sha256}`` is the only difference).  The raw_* functions give the same data in its raw
form: texts, several versions of an order, repeated deliveries, and faulty rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AS_OF = "2024-01-31"
NOW = "2024-01-31 12:00:00"
START = "2023-10-01"       # the period of the KPI queries
END = "2024-01-31"

ORDERS = """
select o_orderkey, cast(o_orderkey as string) as order_id, cast(o_custkey as string) as customer_id,
 case when o_orderstatus = 'P' then 'pending'
      when o_orderstatus = 'O' and o_orderkey % 3 = 0 then 'confirmed'
      when o_orderstatus = 'O' and o_orderkey % 3 = 1 then 'processing'
      when o_orderstatus = 'O' then 'shipped'
      when o_orderkey % 10 = 0 then 'refunded'
      when o_orderkey % 10 = 1 then 'cancelled' else 'delivered' end as order_status,
 o_orderdate + INTERVAL '8218' DAY + INTERVAL '1' HOUR * cast(o_orderkey % 24 as int) as order_date,
 o_orderdate + INTERVAL '8220' DAY as updated_at,
 o_orderdate + INTERVAL '8218' DAY + INTERVAL '1' HOUR * cast(o_orderkey % 24 + 1 as int) as _ingestion_ts,
 cast(o_orderdate + INTERVAL '8224' DAY as date) as estimated_delivery_date,
 case when o_orderstatus = 'F' and o_orderkey % 10 > 1
      then cast(o_orderdate + INTERVAL '8222' DAY + INTERVAL '1' DAY * cast(o_orderkey % 5 as int) as date) end as actual_delivery_date,
 cast(cast(cast(floor(o_totalprice / 5) as bigint) as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(18,2)) as total_amount,
 cast(case when o_orderkey % 4 = 0 then 1.50 else 0.00 end as decimal(18,2)) as discount_total,
 cast(case when o_orderkey % 5 < 2 then 0.00 when o_orderkey % 5 = 2 then 5.99 when o_orderkey % 5 = 3 then 9.99 else 14.99 end as decimal(18,2)) as shipping_fee,
 cast(cast(cast(floor(o_totalprice / 68) as bigint) as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(18,2)) as tax_amount,
 cast(cast(cast(floor(o_totalprice / 6) as bigint) as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(18,2)) as subtotal,
 case cast(o_orderkey % 7 as int) when 0 then 'credit_card' when 1 then 'debit_card' when 2 then 'paypal' when 3 then 'apple_pay'
      when 4 then 'google_pay' when 5 then 'buy_now_pay_later' else 'gift_card' end as payment_method,
 case when o_orderkey % 20 = 0 then 'pending' else 'paid' end as payment_status,
 case cast(o_orderkey % 11 as int) when 0 then 'standard' when 1 then 'express' when 2 then 'overnight' when 3 then 'pickup' when 4 then 'same_day' else 'standard' end as shipping_method,
 concat('City', cast(o_custkey % 40 as string)) as shipping_address_city,
 concat('ST', cast(o_custkey % 50 as string)) as shipping_address_state,
 'US' as shipping_address_country,
 concat('s', cast(o_orderkey as string)) as session_id,
 case cast(o_orderkey % 3 as int) when 0 then 'google' when 1 then 'facebook' else 'email' end as utm_source,
 case cast(o_custkey % 5 as int) when 0 then 'cpc' when 1 then 'social' when 2 then 'email' when 3 then 'organic' else 'referral' end as utm_medium,
 case when o_orderkey % 5 = 0 then null else concat('camp_', cast(o_custkey % 12 as string)) end as utm_campaign,
 o_orderkey % 9 = 0 as is_gift,
 cast(1 + o_orderkey % 5 as int) as item_count
from {orders}
"""

# Line i of an order, i from 1 to item_count; written over o_orderkey and i.
LINE = {
    "sku": "(o_orderkey * 7 + i * 13) % 2000",
    "product_sku": "cast((o_orderkey * 7 + i * 13) % 2000 as string)",
    "product_name": "concat('Product ', cast((o_orderkey * 7 + i * 13) % 2000 as string))",
    "category": "concat('cat_', cast((o_orderkey * 7 + i * 13) % 2000 % 8 as string))",
    "subcategory": "concat('sub_', cast((o_orderkey * 7 + i * 13) % 2000 % 24 as string))",
    "quantity": "cast(1 + (o_orderkey + i) % 4 as int)",
    "unit_price": "cast(cast(500 + (o_orderkey * 7 + i * 13) % 2000 * 3 as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(18,2))",
}
LINE["total_price"] = f"cast({LINE['unit_price']} * {LINE['quantity']} as decimal(18,2))"

CUSTOMERS = """
select c_custkey, cast(c_custkey as string) as customer_id, {sha256}(lower(c_name){bits}) as email_hash,
 {sha256}(cast(c_custkey as string){bits}) as phone_hash,
 case when c_acctbal < 2000 then 'bronze' when c_acctbal < 5000 then 'silver' when c_acctbal < 8000 then 'gold' else 'platinum' end as loyalty_tier,
 case c_mktsegment when 'AUTOMOBILE' then 'loyal' when 'BUILDING' then 'at_risk' when 'FURNITURE' then 'new' when 'HOUSEHOLD' then 'vip' else 'dormant' end as segment,
 case cast(c_custkey % 6 as int) when 0 then '18-24' when 1 then '25-34' when 2 then '35-44' when 3 then '45-54' when 4 then '55-64' else '65+' end as age_bracket,
 case cast(c_custkey % 3 as int) when 0 then 'M' when 1 then 'F' else 'NB' end as gender,
 n_name as country, concat('ST', cast(c_custkey % 50 as string)) as state,
 cast(c_custkey % 201 as int) as total_orders,
 cast(cast(cast(floor(c_acctbal) as bigint) as decimal(18,2)) as decimal(18,2)) as ltv_usd,
 cast(timestamp '2019-02-01 00:00:00' + INTERVAL '1' DAY * cast((c_custkey * 37) % 1826 as int) as date) as registration_date,
 cast(timestamp '1948-03-01 00:00:00' + INTERVAL '1' DAY * cast((c_custkey * 97) % 20000 as int) as date) as date_of_birth,
 c_custkey % 7 <> 0 as is_email_verified,
 case cast(c_custkey % 3 as int) when 0 then 'mobile' when 1 then 'tablet' else 'desktop' end as preferred_device
from {customer} join {nation} on c_nationkey = n_nationkey
"""

CLICKS = """
select event_id as event_key, cast(event_id as string) as event_id,
 cast(case when event_id % 10 < 3 then null else user_id end as string) as customer_id,
 concat(cast(user_id as string), '-', cast(cast(ts as date) as string)) as session_id, ts as event_ts,
 case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart' when 'purchase' then 'checkout_start' when 'signup' then 'search' else event_type end as event_type,
 case cast(event_id % 3 as int) when 0 then 'mobile' when 1 then 'tablet' else 'desktop' end as device_type,
 case cast(event_id % 5 as int) when 0 then 'Chrome' when 1 then 'Safari' when 2 then 'Firefox' when 3 then 'Edge' else 'Opera' end as browser,
 case cast(event_id % 2 as int) when 0 then 'iOS' else 'Android' end as os,
 cast(floor(value) as int) as time_on_page_sec, cast(10 + event_id % 91 as int) as scroll_depth_pct
from {events}
"""

# One stock row per supplier and part that occur together in the order lines.
INVENTORY = """
select concat('WH-', cast(l_suppkey as string)) as warehouse_id, cast(l_partkey as string) as product_sku,
 cast(sum(cast(l_quantity as int)) as int) as quantity_on_hand,
 cast(sum(case when l_linestatus = 'O' then cast(l_quantity as int) else 0 end) as int) as quantity_reserved,
 cast(sum(case when l_linestatus = 'O' then 0 else cast(l_quantity as int) end) as int) as quantity_available,
 cast(5 + l_partkey % 20 as int) as reorder_point,
 cast(100 + l_suppkey % 50 as int) as reorder_quantity,
 cast(cast(cast(1000 + l_partkey % 900 as bigint) as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(18,2)) as unit_cost,
 cast(max(l_shipdate) + INTERVAL '8000' DAY as date) as last_received_date,
 case when l_partkey % 4 = 0 then timestamp '2024-01-30 06:00:00' else timestamp '2024-01-31 06:00:00' end as snapshot_ts,
 concat('SUP-', cast(l_suppkey as string)) as supplier_id
from {lineitem} group by l_suppkey, l_partkey
"""

REVIEWS = """
select d.doc_id, cast(d.doc_id as string) as review_id, cast(d.doc_id % 1500 as string) as customer_id,
 {sha256}(cast(d.doc_id % 1500 as string){bits}) as customer_email_hash,
 cast(d.doc_id % 2000 as string) as product_sku, concat('Product ', cast(d.doc_id % 2000 as string)) as product_name,
 cast(d.doc_id % 7 as int) as rating, concat('Review ', cast(d.doc_id as string)) as title, d.text as body,
 cast(timestamp '2023-06-01 00:00:00' + INTERVAL '1' DAY * cast(d.doc_id % 240 as int) as date) as review_date,
 d.doc_id % 5 <> 0 as verified_purchase, cast(d.doc_id % 30 as int) as helpful_votes, cast(d.doc_id % 4 as int) as images_count,
 case when l.toxic = 1 then 'negative' when l.quality = 1 then 'positive' else 'neutral' end as sentiment
from {documents} d left join {labels} l on d.doc_id = l.doc_id
"""

_SPARK = {"sha256": "sha2", "bits": ", 256"}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def even(given: DataFrame) -> DataFrame:
    """A given table in tasks of even size, before its rows are widened to texts."""
    return given.hint("rebalance")


def _view(spark: SparkSession, sf_dir: str, text: str, *names: str, deal=None) -> DataFrame:
    """Run a view text over the given tables; wall-clock columns become UTC instants.

    ``deal`` brings the narrow given rows into the tasks that the wide ones are to be made in.
    """
    frames = {n: table(spark, sf_dir, n) for n in names}
    if deal is not None:
        frames = {n: deal(f) for n, f in frames.items()}
    holes = {n: "{" + n + "}" for n in names}
    df = spark.sql(text.format(**holes, **_SPARK), **frames)
    local = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in local}) if local else df


# --- typed ----------------------------------------------------------------------


def orders(spark: SparkSession, sf_dir: str, deal=None) -> DataFrame:
    """Typed orders with their lines, one row per order."""
    fields = ("product_sku", "product_name", "category", "subcategory", "quantity", "unit_price",
              "total_price")
    line = ", ".join(f"'{f}', {LINE[f]}" for f in fields)
    items = (
        "transform(sequence(1, cast(1 + o_orderkey % 5 as int)), i -> named_struct("
        f"'order_item_id', concat(order_id, '-', cast(i as string)), {line}, "
        "'discount_amount', cast(0 as decimal(18,2)), "
        "'warehouse_id', concat('WH-', cast(o_orderkey % 5 as string))))"
    )
    return _view(spark, sf_dir, ORDERS, "orders", deal=deal).withColumn("items", F.expr(items))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, CUSTOMERS, "customer", "nation")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, CLICKS, "events")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, INVENTORY, "lineitem")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, REVIEWS, "documents", "labels")


# --- raw ------------------------------------------------------------------------

_STAMP = "yyyy-MM-dd HH:mm:ss"
_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def raw_orders(spark: SparkSession, sf_dir: str, deal=None) -> DataFrame:
    """Order messages: 1 to 3 versions per order, each a day later than the one before.

    Older versions are pending; some newest versions are faulty on purpose.
    """
    o = orders(spark, sf_dir, deal)
    as_text = {c: F.col(c).cast("string") for c in ("estimated_delivery_date", "actual_delivery_date")}
    as_double = {c: F.col(c).cast("double") for c in
                 ("subtotal", "discount_total", "shipping_fee", "tax_amount")}
    items = F.transform("items", lambda i: i.withField("unit_price", i["unit_price"].cast("double"))
                        .withField("total_price", i["total_price"].cast("double"))
                        .withField("discount_amount", i["discount_amount"].cast("double")))
    # what the versions of an order share is made once, before there are several
    shared = o.withColumns(as_text | as_double | {
        "items": items, "_ingestion_ts": F.date_format("_ingestion_ts", _STAMP),
        "n_versions": F.expr("1 + o_orderkey % 3"),
    })
    v = shared.withColumn("version", F.explode(F.expr("sequence(1, cast(n_versions as int))")))
    newest = F.col("version") == F.col("n_versions")
    k = F.col("o_orderkey")
    status = F.when(~newest, "pending").when(k % 37 == 0, "lost").otherwise(F.col("order_status"))
    amount = F.when(newest & (k % 41 == 0), F.lit(-1.0)).otherwise(
        F.col("total_amount").cast("double"))
    placed = F.when(newest & (k % 47 == 0), F.lit("n/a")).otherwise(
        F.date_format("order_date", _STAMP))
    moved = F.col("order_date") + F.expr("make_dt_interval(cast(version as int))")
    return v.withColumns({
        "order_status": status,
        "total_amount": amount,
        "customer_id": F.when(~(newest & (k % 43 == 0)), F.col("customer_id")),
        "updated_at": F.date_format(moved, _STAMP),
        "order_date": placed,
        "notes": F.lit(None).cast("string"),
        "_source": F.lit("orders-api"),
    }).drop("n_versions", "version", "item_count")


def is_cut():
    """Which order messages are cut short."""
    return F.col("o_orderkey") % 53 == 0


def raw_order_lines(spark: SparkSession, sf_dir: str, deal=None, keep=()) -> DataFrame:
    """JSON text of the order messages, some cut short; columns o_orderkey and value, and those of the messages in ``keep``."""
    raw = raw_orders(spark, sf_dir, deal)
    text = F.to_json(F.struct(*[c for c in raw.columns if c != "o_orderkey"]))
    cut = F.expr("left(value, length(value) - 9)")
    return raw.select("o_orderkey", text.alias("value"), *keep).withColumn(
        "value", F.when(is_cut(), cut).otherwise(F.col("value")))


def raw_customers(spark: SparkSession, sf_dir: str, repeats: bool = True) -> DataFrame:
    """Customer records with contact data; with ``repeats`` odd customers come twice."""
    c = customers(spark, sf_dir)
    k = F.col("c_custkey")
    code = F.concat(F.lpad((k * 7 % 100000).cast("string"), 5, "0"), F.lit("-"), (k % 10).cast("string"))
    twice = c.withColumn("copy", 
        F.explode(F.expr("sequence(0, cast(c_custkey % 2 as int))")) if repeats else F.lit(0))
    return twice.withColumns({
        "email": F.concat(F.lit("Shopper."), F.col("customer_id"), F.lit("@mail.example")),
        "first_name": F.concat(F.lit("First"), F.col("customer_id")),
        "last_name": F.concat(F.lit("Last"), F.col("customer_id")),
        "phone": F.concat(F.lit("+1-555-"), F.col("customer_id")),
        "city": F.concat(F.lit("City"), (k % 40).cast("string")),
        "postal_code": F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit("1-2 ")).otherwise(code),
        "date_of_birth": F.when(k % 17 > 0, F.col("date_of_birth").cast("string")),
        "registration_date": F.date_sub(F.col("registration_date"), F.col("copy")).cast("string"),
        "total_orders": F.expr("total_orders - copy"),
        "ltv_usd": F.col("ltv_usd").cast("double"),
    }).drop("copy")


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click messages; odd events are delivered twice, some lack a session."""
    c = clicks(spark, sf_dir)
    k = F.col("event_key")
    sent = c.withColumn("copy", F.explode(F.expr("sequence(0, cast(event_key % 2 as int))")))
    late = F.col("event_ts") + F.expr("make_dt_interval(0, 0, cast(1 + copy as int))")
    blank = F.lit(None).cast("string")
    return sent.withColumns({
        "session_id": F.when(k % 50 != 7, F.col("session_id")),
        "_ingestion_ts": F.date_format(late, _MICROS),
        "event_ts": F.date_format("event_ts", _MICROS),
        "page_url": F.concat(F.lit("/p/"), F.col("event_id")),
        "referrer_url": blank, "product_sku": (k % 2000).cast("string"),
        "product_category": blank, "search_query": blank,
        "ip_hash": F.md5("event_id"), "user_agent": F.lit("agent"),
        "viewport_width": F.lit(1280), "viewport_height": F.lit(720),
        "utm_source": blank, "utm_medium": blank,
        "_partition_key": F.col("session_id"),
    }).drop("copy")


def bad_lines(raw: DataFrame, key: str, amount: str) -> DataFrame:
    """JSON lines that a reader must refuse: every 53rd record cut short, every 59th wrong-typed."""
    text = F.to_json(F.struct(*[c for c in raw.columns if c != key]))
    told = raw.withColumn("value", text)
    cut = told.filter(F.col(key) % 53 == 0).withColumn("value", F.expr("left(value, length(value) - 9)"))
    odd = told.filter(F.col(key) % 59 == 0).withColumn(
        "value", F.regexp_replace("value", f'"{amount}":-?[0-9]+', f'"{amount}":"many"'))
    return cut.unionByName(odd)


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock rows as text; some quantities cannot be read as numbers."""
    i = inventory(spark, sf_dir)
    bad = F.col("product_sku").cast("bigint") % 31 == 0
    text = {c: F.col(c).cast("string") for c in i.columns}
    text["snapshot_ts"] = F.date_format("snapshot_ts", _STAMP)
    text["quantity_available"] = F.when(bad, "unknown").otherwise(
        F.col("quantity_available").cast("string"))
    return i.withColumns(text)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review records as text; odd reviews come a second time, a day later and with more votes."""
    r = reviews(spark, sf_dir)
    sent = r.withColumn("copy", F.explode(F.expr("sequence(0, cast(doc_id % 2 as int))")))
    return sent.withColumns({
        "rating": F.col("rating").cast("string"),
        "review_date": F.date_add("review_date", F.col("copy")).cast("string"),
        "verified_purchase": F.col("verified_purchase").cast("string"),
        "helpful_votes": F.expr("cast(helpful_votes + copy as string)"),
        "images_count": F.col("images_count").cast("string"),
    }).drop("copy")
