"""The registered queries: one per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchset import tables as T
from tillroll import vocabulary as V
from tillroll.functions import expressions as X
from tillroll.functions import keys, privacy, retail
from tillroll.operators import aggregates as A
from tillroll.operators import calendar as C
from tillroll.operators import dedup as D
from tillroll.operators import filters as W
from tillroll.operators import joins as J
from tillroll.operators import maintain as M
from tillroll.operators import quality as Q
from tillroll.plans import daily, features, gold, kpis, silver, suites
from tillroll.session import configure, scratch_path
from tillroll.sources import landing, readers, versions, writers
from tillroll.sources.key_index import KeyIndex
from tillroll.streaming import events as E
from tillroll.streaming import landing as L

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

HISTORY_START = "2017-01-01 00:00:00"
HISTORY_CHANGE = "2021-01-01 00:00:00"
LOADED_UNTIL = "2023-12-31 23:59:59"     # what the target of an incremental run already holds


def portable(df: DataFrame) -> DataFrame:
    """Money as double and instants as UTC wall-clock, for comparison across engines."""
    plain = {}
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            plain[f.name] = F.col(f.name).cast("double")
        elif kind == "timestamp":
            plain[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(plain) if plain else df


def query(fn):
    """Register under the function's name."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(configure(spark), sf_dir.rstrip("/")))

    QUERIES[fn.__name__] = run
    return run


# --- shared inputs --------------------------------------------------------------

_STAGED: dict[tuple[str, str, str], str] = {}


def _staged(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a folder derived from the tables, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = scratch_path(spark, name)
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


# Landed texts are packed, in files of so many lines as one task should read: a packed file is read whole.
# At the usual level the packing takes longer than the making of the texts.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000}
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _unsorted(spark: SparkSession, dates: int = 64):
    """Inside, a task keeps the files of up to ``dates`` dates open; the wide lines are sorted only beyond that."""
    before = spark.conf.get(_OPEN_FILES, None)
    spark.conf.set(_OPEN_FILES, str(dates))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FILES) if before is None else spark.conf.set(_OPEN_FILES, before)


def _bronze(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """Root of the landed files with this entity in it, as {entity}/date=."""
    today = F.lit(T.AS_OF).alias("date")

    def write(root: str) -> None:
        with _unsorted(spark):
            put(f"{root}/{entity}")

    def put(out: str) -> None:
        if entity == "orders":
            lines = T.raw_order_lines(spark, sf_dir, T.even).select("value", today)
            lines.write.options(**_PACKED).partitionBy("date").text(out)
        elif entity == "customers":
            raw = T.raw_customers(spark, sf_dir)
            bad = T.bad_lines(T.raw_customers(spark, sf_dir, repeats=False), "c_custkey", "total_orders")
            lines = raw.select(F.to_json(F.struct("*")).alias("value")).unionByName(bad.select("value"))
            lines.select("value", today).write.options(**_PACKED).partitionBy("date").text(out)
        elif entity == "clickstream":
            raw = T.raw_clicks(spark, sf_dir)
            bad = T.bad_lines(raw, "event_key", "viewport_width")
            lines = raw.withColumn("value", F.to_json(F.struct("*"))).unionByName(bad)
            dated = lines.select("value", F.left("event_ts", F.lit(10)).alias("date"))
            dated.hint("rebalance", "date").write.options(**_PACKED).partitionBy("date").text(out)
        elif entity == "inventory":
            raw = T.raw_inventory(spark, sf_dir).withColumn("date", F.left("snapshot_ts", F.lit(10)))
            raw.select(*readers_columns(V.INVENTORY_DDL), "date").hint("rebalance", "date").write \
                .options(**_PACKED).partitionBy("date").option("header", True).csv(out)
        else:
            raw = T.raw_reviews(spark, sf_dir).select(*readers_columns(V.REVIEWS_DDL), today)
            raw.write.partitionBy("date").format("xml").option("rowTag", "review").save(out)

    return _staged(spark, sf_dir, f"bronze-{entity}", write)


def readers_columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _stored(spark, d, name, build):
    """A frame kept as a table; ``build`` deals the given rows out evenly, so the wide ones need no shuffle."""
    path = _staged(spark, d, name, lambda p: build().write.option("compression", "zstd").parquet(p))
    return spark.read.parquet(path)


def _raw_orders(spark, d):
    """The order messages as a landed table."""
    return _stored(spark, d, "raw_orders", lambda: T.raw_orders(spark, d, T.even))


def _orders(spark, d):
    """The silver order table."""
    return _stored(
        spark, d, "silver_orders", lambda: silver.enrich_orders(T.orders(spark, d, T.even), T.NOW))


def _measures(spark, d):
    return gold.order_measures(_orders(spark, d))


def _customers(spark, d, changed: bool = False):
    """The customer table of the first run; ``changed`` gives that of the second.

    By the second run accounts in debt are gone and every 'vip' has become platinum.
    """
    masked = silver.mask_customers(T.raw_customers(spark, d, repeats=False))
    if changed:
        promoted = F.when(F.col("segment") == "vip", "platinum").otherwise(F.col("loyalty_tier"))
        masked = masked.filter("ltv_usd >= 0").withColumn("loyalty_tier", promoted)
    return silver.customer_scd_meta(masked, HISTORY_START)


def _customers_day1(spark, d):
    return _customers(spark, d)


def _customers_day2(spark, d):
    return _customers(spark, d, changed=True)


def _history(spark, d):
    first = M.snapshot_customers(None, _customers_day1(spark, d), HISTORY_START)
    return M.snapshot_customers(first, _customers_day2(spark, d), HISTORY_CHANGE)


def _dim(spark, d):
    return gold.dim_customers(_history(spark, d), T.AS_OF, T.NOW)


def _promos(spark, d):
    """From the few columns it needs; the silver order table need not be stored for it."""
    return gold.dim_promotions(silver.enrich_orders(T.orders(spark, d), T.NOW), T.NOW)


def _fact(spark, d):
    return gold.fact_orders(
        _orders(spark, d), _gold(spark, d, "dim_customers"), C.dim_date(spark),
        _gold(spark, d, "dim_promotions"), T.NOW)


def _clicks(spark, d):
    return W.valid_clickstream(T.clicks(spark, d))


def _features(spark, d):
    """The order fact has one row per order (its merge key, checked by its quality suite)."""
    return features.customer_ml_features(
        _gold(spark, d, "fact_orders"), _gold(spark, d, "dim_customers"), _clicks(spark, d),
        T.AS_OF, T.NOW, one_row_per_order=True)


# name -> (how it is built, its partition columns, what it is sorted by)
_GOLD = {
    "dim_customers": (_dim, (), ("customer_id", "_valid_from")),
    "dim_promotions": (_promos, (), ("campaign_id",)),
    "fact_orders": (_fact, daily.FACT_PARTITIONS, daily.FACT_SORT),
    "customer_ml_features": (_features, ("snapshot_date",), ()),
}


def _gold(spark, d, name):
    """A gold table in the layout of the daily run: built and stored once, then read."""
    build, parts, by = _GOLD[name]

    def write(path: str) -> None:
        if parts:
            writers.write_partitioned(build(spark, d), path, parts, by)
        else:
            versions.write_version(build(spark, d), path, by)

    path = _staged(spark, d, name, write)
    return spark.read.parquet(path) if parts else versions.read_version(spark, path)


def _order_browse(spark, d):
    fact = _gold(spark, d, "fact_orders")
    orders = features.order_features(fact, T.AS_OF, one_row_per_order=True)
    return orders.join(features.browse_features(_clicks(spark, d), T.AS_OF), "customer_id", "left")


# --- sources, sinks, landing ----------------------------------------------------


@query
def read_orders_json(spark, d):
    raw = readers.read_orders(spark, _bronze(spark, d, "orders") + "/orders")
    good, _ = readers.split_corrupt(raw)
    units = F.aggregate("items", F.lit(0), lambda n, i: n + i["quantity"])
    return good.select(
        "order_id", "customer_id", "order_status", "order_date", "updated_at", "total_amount",
        "is_gift", F.size("items").alias("lines"), units.alias("units"))


@query
def read_customers_json(spark, d):
    raw = readers.read_customers(spark, _bronze(spark, d, "customers") + "/customers")
    return readers.split_corrupt(raw)[0].drop("date")


@query
def read_clickstream_json(spark, d):
    raw = readers.read_clickstream(spark, _bronze(spark, d, "clickstream") + "/clickstream")
    return readers.split_corrupt(raw)[0].select(
        "event_id", "session_id", "customer_id", "event_type", "event_ts", "product_sku",
        "device_type", "viewport_width", "scroll_depth_pct", "time_on_page_sec",
        F.col("date").alias("landed_date"))


@query
def read_inventory_csv(spark, d):
    return readers.read_inventory(spark, _bronze(spark, d, "inventory") + "/inventory").drop("date")


@query
def read_reviews_xml(spark, d):
    """The whole text of every review; white space at its ends is not kept by XML."""
    raw = readers.read_reviews(spark, _bronze(spark, d, "reviews") + "/reviews")
    letters = F.coalesce(F.regexp_replace("body", r"[^\p{L}\p{N}]+", ""), F.lit(""))
    return raw.withColumn("letters_md5", F.md5(letters)).drop("date", "body")


@query
def corrupt_split(spark, d):
    raw = readers.read_orders(spark, _bronze(spark, d, "orders") + "/orders")
    good, bad = readers.split_corrupt(raw)
    order_id = F.coalesce(
        "order_id", F.regexp_extract(readers.CORRUPT, r'"order_id":"(\d+)"', 1))
    sides = good.select("order_id", F.lit("good").alias("side")).unionByName(
        bad.select(order_id.alias("order_id"), F.lit("bad").alias("side")))
    return sides.groupBy("side", "order_id").agg(F.count("*").alias("versions"))


@query
def write_dlq_orders(spark, d):
    raw = readers.read_orders(spark, _bronze(spark, d, "orders") + "/orders")
    out = scratch_path(spark, "dlq")
    writers.write_dlq(readers.split_corrupt(raw)[1], out, "orders")
    letters = (
        spark.read.schema("_corrupt_record string, date date")
        .option("columnNameOfCorruptRecord", "_unreadable").json(f"{out}/_dlq/orders")
    )
    return letters.withColumn(
        "order_id", F.regexp_extract("_corrupt_record", r'"order_id":"(\d+)"', 1)
    ).groupBy("date", "order_id").agg(F.count("*").alias("letters"))


def _letters(spark, d, entity, read, key):
    """Dead letters per date and record, written twice as a repeated run would."""
    raw = read(spark, f"{_bronze(spark, d, entity)}/{entity}")
    out = scratch_path(spark, "dlq")
    for _ in range(2):
        writers.write_dlq(readers.split_corrupt(raw)[1], out, entity)
    letters = (
        spark.read.schema("_corrupt_record string, date date")
        .option("columnNameOfCorruptRecord", "_unreadable").json(f"{out}/_dlq/{entity}")
    )
    record = F.regexp_extract("_corrupt_record", rf'"{key}":"([^"]+)"', 1)
    return letters.groupBy("date", record.alias(key)).agg(F.count("*").alias("letters"))


@query
def dlq_customers(spark, d):
    return _letters(spark, d, "customers", readers.read_customers, "customer_id")


@query
def dlq_clickstream(spark, d):
    return _letters(spark, d, "clickstream", readers.read_clickstream, "event_id")


@query
def history_daily(spark, d):
    """Two daily runs from landed customers: debtors are missing and 'vip' has moved by the second."""
    bronze, out, gold_root = (scratch_path(spark, n) for n in ("bronze", "silver", "gold"))
    first = T.raw_customers(spark, d, repeats=False)
    promoted = F.when(F.col("segment") == "vip", "platinum").otherwise(F.col("loyalty_tier"))
    second = first.filter("ltv_usd >= 0").withColumn("loyalty_tier", promoted)
    for raw, now in ((first, HISTORY_START), (second, HISTORY_CHANGE)):
        date = now[:10]
        raw.write.json(f"{bronze}/customers/date={date}")
        daily.build_silver(spark, "customers", bronze, out, now, date)
        daily.build_customer_history(spark, out, gold_root)
    return daily.read_table(spark, gold_root, "snapshot_customers").select(*_HISTORY_COLUMNS)


@query
def history_out_of_order(spark, d):
    """Three deliveries run as third, first, second, and the second once more.

    In the second debtors are missing and 'vip' has moved; in the third every tenth customer is missing.
    """
    bronze, out, gold_root = (scratch_path(spark, n) for n in ("bronze", "silver", "gold"))
    first = T.raw_customers(spark, d, repeats=False)
    promoted = F.when(F.col("segment") == "vip", "platinum").otherwise(F.col("loyalty_tier"))
    second = first.filter("ltv_usd >= 0").withColumn("loyalty_tier", promoted)
    third = first.filter("c_custkey % 10 <> 3")
    landed = {HISTORY_START: first, HISTORY_CHANGE: second, T.NOW: third}
    for now, raw in landed.items():
        raw.write.json(f"{bronze}/customers/date={now[:10]}")
    for now in (T.NOW, HISTORY_START, HISTORY_CHANGE, HISTORY_CHANGE):
        daily.build_silver(spark, "customers", bronze, out, now, now[:10])
        daily.build_customer_history(spark, out, gold_root)
    return daily.read_table(spark, gold_root, "snapshot_customers").select(*_HISTORY_COLUMNS)


@query
def dlq_rerun(spark, d):
    """Two landed dates with bad lines; the second is delivered again without any."""
    bronze, out = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    lines = T.raw_order_lines(spark, d, T.even)
    first, second = lines.filter("o_orderkey % 2 = 0"), lines.filter("o_orderkey % 2 = 1")
    whole = second.filter("o_orderkey % 53 <> 0")
    for landed in ({"2024-01-30": first, "2024-01-31": second}, {"2024-01-31": whole}):
        for date, rows in landed.items():      # each date into its own folder, so nothing is sorted by date
            rows.select("value").write.mode("overwrite").options(**_PACKED).text(f"{bronze}/orders/date={date}")
        for date in ("2024-01-30", "2024-01-31"):
            raw = readers.read_orders(spark, f"{bronze}/orders").filter(F.col("date") == X.day(date))
            writers.write_dlq(readers.split_corrupt(raw)[1], out, "orders", date)
    letters = spark.read.schema("_corrupt_record string, date date").json(f"{out}/_dlq/orders")
    return letters.groupBy("date").agg(F.count("*").alias("letters"))


def _by_order(given):
    """Given orders by their key: the window over the versions then shuffles none of the wide lines."""
    pieces = max(given.sparkSession.sparkContext.defaultParallelism, -(-given.count() // 50_000))
    return given.repartition(pieces, "o_orderkey")


def _read_back(lines):
    """``at``: the time of the version that its line tells; a line that was cut short cannot be read and tells none."""
    return lines.withColumn("at", F.when(T.is_cut(), None).otherwise(F.col("updated_at")))


def _on_the_first():
    """The line with the order placed on the first of its month; other texts of a date stay."""
    said, before = F.col("order_date"), F.lit('"order_date":"')
    moved = F.regexp_replace(said, r"^(\d{4}-\d{2})-\d{2}", "$1-01")
    return F.when(said.isNull(), F.col("value")).otherwise(
        F.replace("value", F.concat(before, said), F.concat(before, moved)))


def _daily_orders(spark, d):
    """Roots of silver and gold after four runs: versions land on three dates, by their number.

    The third date is run before the second, the first twice, and the second with an earlier clock;
    the fact is brought up to date in between.  Orders are placed on the first of their month, as
    each day is a folder that every merge would write.
    """
    def write(root: str) -> None:
        raw = _read_back(T.raw_order_lines(spark, d, _by_order, ("updated_at", "order_date")))
        turn = Window.partitionBy("o_orderkey").orderBy("at", "value")
        dated = raw.withColumn("n", F.row_number().over(turn))
        landed = dated.select(_on_the_first().alias("value"), F.expr("date'2024-01-28' + n").alias("date"))
        with _unsorted(spark):
            landed.write.options(**_PACKED).partitionBy("date").text(f"{root}/bronze/orders")
        for name in ("dim_customers", "dim_promotions"):
            versions.write_version(_gold(spark, d, name), f"{root}/gold/{name}", _GOLD[name][2])
        versions.write_version(C.dim_date(spark), f"{root}/gold/dim_date", ("full_date",))
        for date, now in (("2024-01-29", "01-29 03:00"), ("2024-01-31", "01-31 03:00"), ("2024-01-29", "01-31 04:00"),
                          ("2024-01-30", "01-30 03:00")):
            daily.build_silver(spark, "orders", f"{root}/bronze", f"{root}/silver", f"2024-{now}:00", date)
            if date != "2024-01-31":
                daily.build_order_fact(spark, f"{root}/silver", f"{root}/gold", f"2024-{now}:30")

    root = _staged(spark, d, "daily_orders", write)
    return f"{root}/silver", f"{root}/gold"


@query
def silver_orders_daily(spark, d):
    return daily.read_table(spark, _daily_orders(spark, d)[0], "orders").select(
        "order_id", "customer_id", "order_status", "order_date", "order_year", "order_month", "total_amount", "item_count")


@query
def fact_orders_daily(spark, d):
    return daily.read_table(spark, _daily_orders(spark, d)[1], "fact_orders").select(
        "order_id", "customer_id", "order_status", "order_year", "order_month", "total_amount", "item_count")


@query
def write_silver(spark, d):
    out = scratch_path(spark, "silver")
    daily.build_silver(spark, "orders", _bronze(spark, d, "orders"), out, T.NOW, T.AS_OF)
    return spark.read.parquet(f"{out}/orders").select(
        "order_id", "customer_id", "order_status", "order_year", "order_month", "order_day",
        "total_amount", "item_count", "is_weekend", "_pipeline_version")


@query
def pass_rate(spark, d):
    out = scratch_path(spark, "silver")
    counts = {
        e: daily.build_silver(spark, e, _bronze(spark, d, e), out, T.NOW) for e in V.ENTITIES
    }
    return daily.pass_rate(spark, counts)


def _landed(spark, d, entities=V.ENTITIES, expected=()):
    files = [landing.landed_files(spark, _bronze(spark, d, e), [e]) for e in entities]
    whole = files[0]
    for more in files[1:]:
        whole = whole.unionByName(more)
    return landing.landing_report(whole, expected)


@query
def landing_report(spark, d):
    """Every landed entity and date, and an empty line for an entity that never landed."""
    report = _landed(spark, d, expected=(*V.ENTITIES, "returns"))
    return report.select("entity", "date", "has_data")


@query
def date_partitions(spark, d):
    return landing.date_partitions(_landed(spark, d, ["clickstream"]), "clickstream")


@query
def latest_partition(spark, d):
    return landing.latest_partition(_landed(spark, d, ["clickstream"]), "clickstream")


@query
def bronze_complete(spark, d):
    """For every landed date: are the required entities there?"""
    return landing.complete_dates(_landed(spark, d))


# --- projections, casts, derived columns ----------------------------------------


@query
def cast_orders(spark, d):
    return silver.cast_orders(_raw_orders(spark, d)).select(
        "order_id", "order_date", "updated_at", "_ingestion_ts", "estimated_delivery_date",
        "actual_delivery_date", "total_amount", "subtotal")


@query
def enrich_orders(spark, d):
    return silver.enrich_orders(T.orders(spark, d), T.NOW).select(
        "order_id", "order_year", "order_month", "order_day", "order_hour", "order_dayofweek",
        "is_weekend", "item_count", "has_discount", "_processed_ts", "_pipeline_version")


@query
def mask_customers(spark, d):
    return silver.mask_customers(T.raw_customers(spark, d)).drop("c_custkey", "ltv_usd")


@query
def postal_prefix(spark, d):
    return T.raw_customers(spark, d).select(
        "customer_id", "postal_code", privacy.postal_prefix("postal_code").alias("prefix"))


@query
def mask_email(spark, d):
    """Good addresses, one without and one with two at signs, an empty local part."""
    k = F.col("c_custkey")
    address = (
        F.when(k % 5 == 1, F.replace("email", F.lit("@"), F.lit(" at ")))
        .when(k % 5 == 2, F.concat("email", F.lit("@x")))
        .when(k % 5 == 3, F.lit("@mail.example"))
        .when(k % 5 == 4, F.lit("a@mail.example"))
        .otherwise(F.col("email"))
    )
    c = T.raw_customers(spark, d, repeats=False).withColumn("address", address)
    return c.select("customer_id", "address", privacy.mask_email("address").alias("masked"))


@query
def hash_pii(spark, d):
    c = T.raw_customers(spark, d, repeats=False)
    padded = F.concat(F.lit("  "), "email", F.lit(" "))
    return c.select("customer_id", privacy.hash_pii(padded, "pepper").alias("hashed"))


@query
def email_phone_hash(spark, d):
    c = T.raw_customers(spark, d, repeats=False)
    return c.select("customer_id", privacy.sha_lower("email").alias("email_sha"),
                    privacy.sha("phone").alias("phone_sha"))


@query
def age_bracket(spark, d):
    c = T.customers(spark, d)
    return c.select("customer_id", "date_of_birth",
                    privacy.age_bracket("date_of_birth", T.AS_OF).alias("bracket"))


@query
def record_hash(spark, d):
    c = T.customers(spark, d).withColumn(
        "segment", F.when(F.col("segment") != "new", F.col("segment")))
    return c.select("customer_id", keys.record_hash(
        "customer_id", "loyalty_tier", "segment", "total_orders").alias("record_md5"))


@query
def customer_scd_meta(spark, d):
    return silver.silver_customers(T.raw_customers(spark, d), T.NOW).select(
        "customer_id", "registration_date", "registration_year", "registration_month",
        "total_orders", "ltv_usd", "_valid_from", "_valid_to", "_is_current", "_record_hash")


@query
def cast_clickstream(spark, d):
    return silver.cast_clickstream(T.raw_clicks(spark, d)).select(
        "event_id", "event_ts", "_ingestion_ts", "event_date", "event_hour", "event_year",
        "event_month", "event_day")


@query
def cast_inventory(spark, d):
    return silver.cast_inventory(T.raw_inventory(spark, d)).select(
        "warehouse_id", "product_sku", "snapshot_ts", "quantity_on_hand", "quantity_reserved",
        "quantity_available", "reorder_point", "reorder_quantity", "unit_cost",
        "last_received_date", "is_low_stock", "is_out_of_stock", "snapshot_date",
        "snapshot_year", "snapshot_month")


@query
def clean_reviews(spark, d):
    return silver.clean_reviews(T.raw_reviews(spark, d), T.NOW).drop("doc_id", "title")


@query
def silver_reviews(spark, d):
    return silver.silver_reviews(silver.clean_reviews(T.raw_reviews(spark, d), T.NOW))


@query
def fact_reviews(spark, d):
    return gold.fact_reviews(
        silver.silver_reviews(silver.clean_reviews(T.raw_reviews(spark, d), T.NOW)))


@query
def surrogate_key(spark, d):
    o = T.orders(spark, d)
    return o.select("order_id", keys.surrogate_key("order_id").alias("order_sk"),
                    keys.surrogate_key("customer_id", "utm_campaign").alias("pair_sk"))


@query
def order_value_band(spark, d):
    o = T.orders(spark, d).withColumn(
        "total_amount", F.when(F.col("payment_status") == "paid", F.col("total_amount")))
    return o.select("order_id", retail.order_value_band("total_amount").alias("band"))


@query
def revenue_band(spark, d):
    scaled = F.col("total_amount") * 10
    return T.orders(spark, d).select("order_id", retail.revenue_band(scaled).alias("band"))


@query
def safe_divide(spark, d):
    return T.orders(spark, d).select(
        "order_id", X.safe_divide("total_amount", "discount_total", -1).alias("per_discount"),
        X.safe_divide("total_amount", "item_count").alias("per_item"))


@query
def gross_margin(spark, d):
    margin = retail.gross_margin("total_amount", "discount_total", "shipping_fee", "tax_amount")
    return T.orders(spark, d).select("order_id", margin.alias("gross_margin_usd"))


@query
def delivery_metrics(spark, d):
    est, act = "estimated_delivery_date", "actual_delivery_date"
    return T.orders(spark, d).select(
        "order_id", retail.delivery_days("order_date", est, act).alias("delivery_days"),
        retail.on_time(est, act).alias("is_on_time_delivery"))


@query
def order_flags(spark, d):
    return _measures(spark, d).select(
        "order_id", "order_status", "is_completed", "is_cancelled", "refund_amount")


@query
def loyalty_rank(spark, d):
    return T.customers(spark, d).select(
        "customer_id", retail.loyalty_rank("loyalty_tier").alias("rank"))


@query
def tenure_band(spark, d):
    return T.customers(spark, d).select(
        "customer_id", "registration_date",
        retail.tenure_band("registration_date", T.AS_OF).alias("band"))


@query
def ltv_band(spark, d):
    return T.customers(spark, d).select("customer_id", retail.ltv_band("ltv_usd").alias("band"))


@query
def campaign_type(spark, d):
    return T.orders(spark, d).select(
        "order_id", "utm_medium", retail.campaign_type("utm_medium").alias("campaign_type"))


@query
def rfm_scores(spark, d):
    return features.rfm_scores(_order_browse(spark, d)).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_total_score")


@query
def churn_risk(spark, d):
    return features.churn_risk(_order_browse(spark, d)).select(
        "customer_id", "churn_risk_score", "churn_risk_tier")


@query
def profile_text(spark, d):
    return _gold(spark, d, "customer_ml_features").select("customer_id", "customer_profile_text")


@query
def engagement_score(spark, d):
    return features.browse_features(_clicks(spark, d), T.AS_OF).select(
        "customer_id", "total_sessions", "engagement_score_per_session")


@query
def freshness_status(spark, d):
    """Age of every customer's newest click."""
    newest = _clicks(spark, d).groupBy("session_id").agg(F.max("event_ts").alias("newest"))
    micros = F.unix_micros(X.instant(T.NOW)) - F.unix_micros("newest")
    hours = X.ratio(micros, F.lit(3_600_000_000))
    return newest.select("session_id", retail.freshness_status(hours).alias("status"))


# --- filters --------------------------------------------------------------------


@query
def valid_orders(spark, d):
    return silver.silver_orders(_raw_orders(spark, d), T.NOW).select(
        "order_id", "customer_id", "order_status", "order_date", "updated_at", "total_amount",
        "item_count", "order_hour")


@query
def valid_clickstream(spark, d):
    return silver.silver_clickstream(T.raw_clicks(spark, d), T.NOW).select(
        "event_id", "session_id", "customer_id", "event_type", "event_ts", "event_date")


@query
def valid_reviews(spark, d):
    return W.valid_reviews(silver.cast_reviews(T.raw_reviews(spark, d))).select(
        "review_id", "rating", "review_date", "verified_purchase")


@query
def current_rows(spark, d):
    return W.current_rows(_gold(spark, d, "dim_customers")).select("customer_id", "loyalty_tier", "_valid_from")


@query
def incremental_rows(spark, d):
    o = T.orders(spark, d)
    target = o.filter(F.col("_ingestion_ts") <= X.instant(LOADED_UNTIL))
    return W.incremental_rows(o, target, "_ingestion_ts").select("order_id", "_ingestion_ts")


@query
def incremental_lookback(spark, d):
    o = T.orders(spark, d)
    target = o.filter(F.col("_ingestion_ts") <= X.instant(LOADED_UNTIL))
    return W.incremental_rows(o, target, "_ingestion_ts", lookback_hours=3).select(
        "order_id", "_ingestion_ts")


@query
def date_range(spark, d):
    return W.date_range(_gold(spark, d, "fact_orders"), "order_date_day", T.START, T.END).select(
        "order_id", "order_date_day")


@query
def optional_eq(spark, d):
    o = T.orders(spark, d)
    one = W.optional_eq(o, "payment_method", "paypal").select("order_id", F.lit("set").alias("how"))
    return one.unionByName(
        W.optional_eq(o, "payment_method", None).select("order_id", F.lit("unset").alias("how")))


@query
def segment_match(spark, d):
    f = _gold(spark, d, "customer_ml_features")
    cols = ("customer_id", "segment", "churn_risk_tier")
    parts = [W.segment_match(f, w).select(*cols, F.lit(w).alias("wanted"))
             for w in ("all", "medium", "at_risk")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- joins ----------------------------------------------------------------------


@query
def fact_orders(spark, d):
    return _fact(spark, d)


@query
def fact_orders_spread(spark, d):
    """The lookups with every key of more than 20 rows split into pieces."""
    o = _measures(spark, d)
    known = gold.join_customers(o, _gold(spark, d, "dim_customers"), piece_rows=20, profile=o)
    full = gold.join_promotions(known, _gold(spark, d, "dim_promotions"), piece_rows=1000, profile=o)
    return full.select("order_id", "customer_id", "customer_sk", "customer_segment", "utm_campaign",
                       "campaign_type", "channel")


@query
def join_dates(spark, d):
    dated = gold.join_dates(_measures(spark, d), C.dim_date(spark))
    return dated.select("order_id", "order_date_day", "order_date_sk", "delivery_date_sk")


@query
def fact_customer_asof(spark, d):
    return gold.join_customers_asof(_measures(spark, d), _gold(spark, d, "dim_customers"), piece_rows=20).select(
        "order_id", "customer_id", "order_date", "customer_sk", "customer_loyalty_tier")


@query
def customer_360(spark, d):
    return kpis.customer_360(_gold(spark, d, "customer_ml_features"), _gold(spark, d, "dim_customers"), T.AS_OF)


@query
def explode_items(spark, d):
    return J.explode_items(T.orders(spark, d).select("order_id", "items")).select(
        "order_id", "order_item_id", "product_sku", "category", "quantity", "unit_price",
        "total_price")


@query
def fk_integrity(spark, d):
    o = T.orders(spark, d)
    return J.fk_integrity(o, "customer_id", W.current_rows(_gold(spark, d, "dim_customers")), "customer_id",
                          unknown=V.UNKNOWN_KEY)


# --- aggregations ---------------------------------------------------------------


@query
def campaign_totals(spark, d):
    return gold.campaign_totals(T.orders(spark, d))


@query
def campaign_channel_mode(spark, d):
    return gold.campaign_channel_mode(T.orders(spark, d))


@query
def order_features(spark, d):
    return features.order_features(_gold(spark, d, "fact_orders"), T.AS_OF)


@query
def browse_features(spark, d):
    return features.browse_features(_clicks(spark, d), T.AS_OF)


@query
def conditional_aggregates(spark, d):
    paid = F.col("payment_status") == "paid"
    return T.orders(spark, d).groupBy("payment_method").agg(
        X.sum_if(paid, "total_amount").alias("paid_amount"),
        X.count_if(paid).alias("paid_orders"),
        X.avg_if(paid, "total_amount").alias("paid_mean"))


@query
def ratio_guard(spark, d):
    gifts = X.count_if(F.col("discount_total") > 0)
    return T.orders(spark, d).groupBy("customer_id").agg(
        X.ratio(F.sum("total_amount"), gifts).alias("amount_per_discounted"))


@query
def customer_modes(spark, d):
    return A.mode_by(T.orders(spark, d), "customer_id",
                     ("payment_method", "shipping_method", "utm_source"))


@query
def click_modes(spark, d):
    return A.mode_by(T.clicks(spark, d), "customer_id", ("device_type", "browser", "os"))


@query
def daily_revenue(spark, d):
    return kpis.daily_revenue(_gold(spark, d, "fact_orders"), T.START, T.END, one_row_per_order=True)


@query
def revenue_summary(spark, d):
    return kpis.revenue_summary(_gold(spark, d, "fact_orders"), T.AS_OF)


@query
def product_performance(spark, d):
    return kpis.product_performance(_orders(spark, d), T.START, T.END)


@query
def product_performance_category(spark, d):
    return kpis.product_performance(_orders(spark, d), T.START, T.END, category="cat_3", limit=500)


@query
def channel_attribution(spark, d):
    return kpis.channel_attribution(_gold(spark, d, "fact_orders"), T.START, T.END)


@query
def revenue_share(spark, d):
    by = T.orders(spark, d).groupBy("customer_id").agg(F.sum("total_amount").alias("revenue"))
    return A.share_of_total(by, "revenue", "share_pct")


@query
def load_health(spark, d):
    fact = _gold(spark, d, "fact_orders").withColumn("_processed_ts", F.col("_ingestion_ts"))
    return kpis.load_health(fact, T.NOW)


@query
def dup_current_customers(spark, d):
    """Current rows of the history as it is, and of one that was appended twice."""
    once = W.current_rows(_gold(spark, d, "dim_customers"))
    twice = once.unionByName(once.filter(F.col("segment") == "vip"))
    a = A.duplicated(once, "customer_id").withColumn("case", F.lit("once"))
    return a.unionByName(A.duplicated(twice, "customer_id").withColumn("case", F.lit("twice")))


# --- deduplication, ranking, limits ---------------------------------------------


@query
def dedup_orders(spark, d):
    return D.dedup_latest(_raw_orders(spark, d), "order_id", "updated_at").select(
        "order_id", "customer_id", "order_status", "updated_at", "total_amount", "order_date")


@query
def dedup_clickstream(spark, d):
    return D.dedup_first(T.raw_clicks(spark, d), "event_id", ["_ingestion_ts"]).select(
        "event_id", "session_id", "event_type", "event_ts", "_ingestion_ts")


@query
def dedup_reviews(spark, d):
    return D.dedup_first(T.raw_reviews(spark, d), "review_id", ["review_date"]).select(
        "review_id", "rating", "review_date", "helpful_votes")


@query
def row_number(spark, d):
    """The largest order of every customer."""
    return D.top1_by(T.orders(spark, d), "customer_id",
                     [F.col("total_amount").desc(), F.col("order_id")]).select(
        "customer_id", "order_id", "total_amount")


@query
def top_customers(spark, d):
    f = _gold(spark, d, "customer_ml_features")
    parts = [kpis.top_customers(f, T.AS_OF, by).withColumn("by", F.lit(by))
             for by in ("revenue", "orders", "rfm")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def segment_customers(spark, d):
    return kpis.segment_customers(_gold(spark, d, "customer_ml_features"), "medium", T.AS_OF)


@query
def low_stock(spark, d):
    return kpis.low_stock(silver.silver_inventory(T.raw_inventory(spark, d), T.NOW), T.AS_OF)


# --- table maintenance ----------------------------------------------------------


def _versions_for_merge(spark, d):
    """The order table before, and the rows of the next run: open orders, now delivered, late ones."""
    o = _measures(spark, d).select("order_sk", "order_id", "order_status", "order_date_day",
                                   "total_amount")
    loaded = o.filter(F.col("order_date_day") < X.day("2023-11-01"))
    fresh = o.filter(F.col("order_date_day") >= X.day("2023-10-01")).withColumn(
        "order_status", F.when(F.col("order_status") == "shipped", "delivered")
        .otherwise(F.col("order_status")))
    return loaded, fresh


@query
def merge_upsert(spark, d):
    loaded, fresh = _versions_for_merge(spark, d)
    return M.merge_upsert(loaded, fresh, "order_sk")


@query
def merge_into_table(spark, d):
    """The same merge on a stored table, where only the touched months are rewritten."""
    loaded, fresh = _versions_for_merge(spark, d)
    month = {"y": F.year("order_date_day"), "m": F.month("order_date_day")}
    path = scratch_path(spark, "fact")
    writers.write_partitioned(loaded.withColumns(month), path, ("y", "m"), ["order_sk"])
    M.merge_into_table(spark, path, fresh.withColumns(month), "order_sk", ("y", "m"))
    return spark.read.parquet(path).drop("y", "m")


@query
def merge_by_key_index(spark, d):
    """Three merges in a row whose rows are stored by status: orders change partition, the key index finds them."""
    loaded, fresh = _versions_for_merge(spark, d)
    path = scratch_path(spark, "orders-by-status")
    index = KeyIndex(spark, scratch_path(spark, "keys"), "order_sk", ("status",), buckets=16)
    first = loaded.withColumn("status", F.col("order_status"))
    writers.write_partitioned(first, path, ("status",), ["order_sk"])
    opened = fresh.withColumn("status", F.col("order_status"))
    paid = F.when(F.col("order_status") == "delivered", "paid").otherwise(F.col("order_status"))
    closed = fresh.withColumn("order_status", paid).withColumn("status", F.col("order_status"))
    for src in (opened, closed, opened):
        M.merge_into_table(spark, path, src, "order_sk", ("status",), index=index)
    return spark.read.parquet(path).drop("status")


_HISTORY_COLUMNS = ("customer_id", "loyalty_tier", "segment", "total_orders", "ltv_usd",
                    "_valid_from", "_valid_to", "_is_current")


@query
def scd2_merge(spark, d):
    """Missing customers stay open."""
    checked = ("loyalty_tier", "segment", "total_orders")
    first = M.scd2_merge(None, _customers_day1(spark, d), "customer_id", checked, HISTORY_START)
    return M.scd2_merge(
        first, _customers_day2(spark, d), "customer_id", checked, HISTORY_CHANGE
    ).select(*_HISTORY_COLUMNS)


@query
def snapshot_customers(spark, d):
    """Missing customers are closed; a third, unchanged run adds nothing."""
    again = M.snapshot_customers(_history(spark, d), _customers_day2(spark, d), T.NOW)
    return again.select(*_HISTORY_COLUMNS)


@query
def dim_customers(spark, d):
    return _dim(spark, d)


@query
def dim_date(spark, d):
    """The calendar with the orders placed and delivered on each day."""
    o = _measures(spark, d)
    placed = o.groupBy(F.col("order_date_day").alias("full_date")).agg(
        F.count("*").alias("orders_placed"))
    arrived = o.groupBy(F.col("actual_delivery_date").alias("full_date")).agg(
        F.count("*").alias("orders_delivered"))
    both = C.dim_date(spark).join(placed, "full_date", "left").join(arrived, "full_date", "left")
    return both.fillna(0, ["orders_placed", "orders_delivered"])


@query
def date_spine(spark, d):
    """Every day between the first and the last order, with the orders of the day."""
    o = _measures(spark, d)
    bounds = o.agg(F.min("order_date_day").alias("first"), F.max("order_date_day").alias("last"))
    per_day = o.groupBy(F.col("order_date_day").alias("dt")).agg(F.count("*").alias("orders"))
    return C.spine_of(bounds).join(per_day, "dt", "left").fillna(0, ["orders"])


@query
def dim_promotions(spark, d):
    return _promos(spark, d)


@query
def customer_ml_features(spark, d):
    return _features(spark, d)


# --- data quality ---------------------------------------------------------------


def _checked(df, *checks):
    return Q.run_suite(df, "t", list(checks))


@query
def dq_row_count(spark, d):
    o = T.orders(spark, d)
    return _checked(o, Q.row_count(1), Q.row_count(1_000_000_000_000))


@query
def dq_not_null(spark, d):
    return _checked(T.orders(spark, d), Q.not_null("order_id"), Q.not_null("utm_campaign", Q.WARN),
                    Q.not_null("actual_delivery_date"))


@query
def dq_unique(spark, d):
    return _checked(_raw_orders(spark, d), Q.unique("order_id"), Q.unique("updated_at", Q.WARN))


@query
def dq_between(spark, d):
    return _checked(T.orders(spark, d), Q.between("total_amount", 0, 500),
                    Q.between("item_count", 1, 5), Q.between("tax_amount", high=20))


@query
def dq_in_set(spark, d):
    return _checked(T.orders(spark, d), Q.in_set("order_status", V.ORDER_STATUSES),
                    Q.in_set("utm_campaign", ("camp_1", "camp_2")))


@query
def dq_length_equals(spark, d):
    return _checked(T.customers(spark, d), Q.length_equals("email_hash", 64),
                    Q.length_equals("customer_id", 3))


@query
def dq_relationships(spark, d):
    known = W.current_rows(_gold(spark, d, "dim_customers"))
    return _checked(T.orders(spark, d), Q.relationships("customer_id", known, "customer_id", Q.WARN))


@query
def dq_expression(spark, d):
    late = "actual_delivery_date <= estimated_delivery_date"
    return _checked(T.orders(spark, d), Q.expression("on_time", "actual_delivery_date", late),
                    Q.expression("non_negative", "total_amount", "total_amount >= 0"))


@query
def dq_unique_combo(spark, d):
    return _checked(T.orders(spark, d), Q.unique_combo(("customer_id", "order_date")),
                    Q.unique_combo(("customer_id", "order_id")))


@query
def dq_one_current(spark, d):
    return _checked(_gold(spark, d, "dim_customers"), Q.one_current("customer_id"))


@query
def dq_failing_rows(spark, d):
    """The stored failures of one check."""
    return Q.failing_rows(_gold(spark, d, "fact_orders"), Q.between("total_amount", high=500)).select(
        "order_id", "total_amount")


@query
def dq_suite(spark, d):
    """All suites over their tables."""
    dim = _gold(spark, d, "dim_customers")
    parts = [
        Q.run_suite(_orders(spark, d), "silver_orders", suites.silver_orders_suite()),
        Q.run_suite(_customers_day1(spark, d), "silver_customers", suites.silver_customers_suite()),
        Q.run_suite(T.clicks(spark, d), "silver_clickstream", suites.silver_clickstream_suite()),
        Q.run_suite(T.reviews(spark, d), "silver_reviews", suites.silver_reviews_suite()),
        Q.run_suite(silver.cast_inventory(T.raw_inventory(spark, d)), "silver_inventory",
                    suites.silver_inventory_suite()),
        Q.run_suite(_gold(spark, d, "fact_orders"), "fact_orders", suites.fact_orders_suite(dim, T.NOW)),
        Q.run_suite(dim, "dim_customers", suites.dim_customers_suite()),
        Q.run_suite(_gold(spark, d, "dim_promotions"), "dim_promotions", suites.dim_promotions_suite()),
        Q.run_suite(gold.fact_reviews(T.reviews(spark, d)), "fact_reviews",
                    suites.fact_reviews_suite()),
    ]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


@query
def dq_features_suite(spark, d):
    return Q.run_suite(_gold(spark, d, "customer_ml_features"), "customer_ml_features",
                       suites.customer_ml_features_suite())


@query
def dq_verdict(spark, d):
    results = Q.run_suite(_orders(spark, d), "silver_orders", suites.silver_orders_suite())
    worse = Q.run_suite(T.clicks(spark, d), "silver_clickstream", suites.silver_clickstream_suite())
    a = Q.verdict(results).withColumn("table", F.lit("silver_orders"))
    return a.unionByName(Q.verdict(worse).withColumn("table", F.lit("silver_clickstream")))


_SCHEMAS = ("0a1b2c3d-0000-4000-8000-0123456789ab", "7")


@query
def avro_framing(spark, d):
    """Clicks in the frames of two registries, some with another schema, packed or without a header."""
    key = F.col("event_key")
    frame = (F.when(key % 13 == 0, F.lit("7B")).when(key % 11 == 0, F.lit("0305" + "0A1B2C3D0000400080000123456789AB"))
             .when(key % 7 == 0, F.lit("0000000009")).when(key % 2 == 0, F.lit("0000000007"))
             .otherwise(F.lit("0300" + "0A1B2C3D0000400080000123456789AB")))
    framed = T.raw_clicks(spark, d).select(
        "event_key", F.concat(F.unhex(frame), F.encode(F.col("event_key").cast("string"), "utf-8")).alias("value"))
    good, letters = readers.unframe_avro(framed, _SCHEMAS)
    told = good.select("event_key", "_schema_id", F.decode("value", "utf-8").alias("body"), F.lit(None).cast("string").alias("_error"))
    return told.unionByName(letters.select("event_key", "_schema_id", F.lit(None).cast("string").alias("body"), "_error"))


# --- streaming ------------------------------------------------------------------

_CONSUMED = "2024-01-31 13:00:00"
_NOW_ONLY = {"availableNow": True}


def _messages(spark, d, *topics) -> str:
    """Folder of the message files of ``topics``: order versions and clicks, as a topic reader would give them."""

    def orders():
        return T.raw_order_lines(spark, d, T.even).select(
            F.lit("orders").alias("topic"), F.col("o_orderkey").alias("offset"), "value")

    def clicks():
        raw = T.raw_clicks(spark, d)
        return raw.select(
            F.lit("clickstream").alias("topic"), F.col("event_key").alias("offset"),
            F.to_json(F.struct(*[c for c in raw.columns if c != "event_key"])).alias("value"))

    def write(path: str) -> None:
        asked = [lines() for topic, lines in (("orders", orders), ("clickstream", clicks)) if topic in topics]
        whole = reduce(DataFrame.unionByName, asked).withColumns({
            "partition": (F.col("offset") % 6).cast("int"),
            "key": F.col("offset").cast("string"),
            "timestamp": X.instant(_CONSUMED),
        })
        whole.select("topic", "partition", "offset", "key", "value", "timestamp").write.option(
            "compression", "zstd").parquet(path)

    return _staged(spark, d, "-".join(("messages", *topics)), write)


def _read_messages(spark, d, *topics):
    asked = topics or V.TOPICS
    return L.read_topics(spark, "parquet", asked, path=_messages(spark, d, *asked))


def _finish(query):
    query.awaitTermination()
    return query


@query
def stream_land(spark, d):
    """Every landed line with its place and what it says, read back."""
    out, mark = scratch_path(spark, "landed"), scratch_path(spark, "mark")
    _finish(L.land_stream(
        _read_messages(spark, d), out, mark, _NOW_ONLY, X.instant(_CONSUMED), packing=_PACKED))
    lines = spark.read.schema("value string, topic string, date string").text(out)
    said = F.from_json("value", "order_id string, event_id string, updated_at string, event_ts string, "
                       "_error string, _raw string, _kafka_offset bigint")
    return lines.select("topic", F.col("date").cast("date").alias("date"), said.alias("s")).select(
        "topic", "date", F.coalesce("s.order_id", "s.event_id").alias("record"),
        F.coalesce("s.updated_at", "s.event_ts").alias("at"), F.col("s._error").alias("error"),
        F.col("s._kafka_offset").alias("offset"))


def _parsed(spark, d):
    return L.parse_stream(
        _read_messages(spark, d, "orders"), V.ORDERS_DDL, X.instant(_CONSUMED))


@query
def stream_parse(spark, d):
    out, mark = scratch_path(spark, "parsed"), scratch_path(spark, "mark")
    _finish(L.land_table(_parsed(spark, d), out, mark, _NOW_ONLY))
    return spark.read.parquet(out).select(
        "order_id", "order_status", "updated_at", "_error", "_kafka_topic", "_kafka_partition",
        "_kafka_offset", "_consumed_at")


@query
def stream_dlq(spark, d):
    _, bad = L.split_bad(_parsed(spark, d))
    out, mark = scratch_path(spark, "letters"), scratch_path(spark, "mark")
    _finish(L.land_table(bad, out, mark, _NOW_ONLY))
    return spark.read.parquet(out).select("_error", "_kafka_topic", "_kafka_offset")


@query
def stream_event_date(spark, d):
    good, _ = L.split_bad(_parsed(spark, d))
    dated = L.partition_by_event_date(good, "order_date")
    out, mark = scratch_path(spark, "dated"), scratch_path(spark, "mark")
    _finish(L.land_table(dated, out, mark, _NOW_ONLY, ["date"]))
    rows = spark.read.schema(dated.schema).parquet(out)
    return rows.groupBy("date", "arrival_date").agg(F.count("*").alias("rows"))


def _click_stream(spark, d):
    clicks = L.parse_stream(
        _read_messages(spark, d, "clickstream"), V.CLICKSTREAM_DDL, X.instant(_CONSUMED))
    return L.split_bad(clicks)[0].withColumn("event_ts", X.parse_ts("event_ts"))


@query
def stream_dedup(spark, d):
    """The watermark delay covers the whole month, since the files are not in time order."""
    first = E.dedup_stream(_click_stream(spark, d), "event_id", "event_ts", "60 days")
    out, mark = scratch_path(spark, "once"), scratch_path(spark, "mark")
    _finish(L.land_table(first.select("event_id", "event_type", "event_ts"), out, mark, _NOW_ONLY))
    return spark.read.parquet(out)


@query
def stream_restart(spark, d):
    """Half of the message files land, the query stops, the rest land, it goes on from its checkpoint."""
    source = spark.read.parquet(_messages(spark, d, "orders"))
    inbox, out, mark = (scratch_path(spark, n) for n in ("inbox", "parsed", "mark"))
    for half in (0, 1):
        source.filter(F.col("offset") % 2 == half).write.mode("append").option("compression", "zstd").parquet(inbox)
        parsed = L.parse_stream(L.read_topics(spark, "parquet", ("orders",), path=inbox), V.ORDERS_DDL, X.instant(_CONSUMED))
        _finish(L.land_table(parsed, out, mark, _NOW_ONLY))
    return spark.read.parquet(out).groupBy("_kafka_offset").agg(
        F.count("*").alias("rows"), F.count_if(F.col("_error").isNotNull()).alias("errors"))


@query
def stream_stats(spark, d):
    """Counted over the landed table, after more micro-batches than a query remembers."""
    out, mark = scratch_path(spark, "counted"), scratch_path(spark, "mark")
    _finish(L.land_table(_parsed(spark, d), out, mark, _NOW_ONLY))
    return L.stream_totals(spark.read.parquet(out))


def _in_batches(spark, d, topic):
    return L.read_topics(spark, "parquet", (topic,), path=_messages(spark, d, topic), maxFilesPerTrigger=4)


@query
def stream_two_sinks(spark, d):
    """Good rows and dead letters of the orders, from one parse of each micro-batch."""
    out, mark = scratch_path(spark, "batches"), scratch_path(spark, "mark")
    parsed = L.parse_stream(_in_batches(spark, d, "orders"), V.ORDERS_DDL, X.instant(_CONSUMED))
    _finish(L.land_batches(parsed, out, mark, _NOW_ONLY))
    cols = ("_kafka_topic", "_kafka_partition", "_kafka_offset", "_consumed_at")
    good = L.read_batches(spark, out, "rows").select("order_id", "order_status", "updated_at", F.lit(None).cast("string").alias("_error"), *cols)
    letters = L.read_batches(spark, out, "letters").select("_error", *cols)
    return good.unionByName(letters, allowMissingColumns=True)


@query
def stream_late(spark, d):
    """Each click once: on-time rows of the stream, then the late ones that are new."""
    out, mark = scratch_path(spark, "batches"), scratch_path(spark, "mark")
    parsed = L.parse_stream(_in_batches(spark, d, "clickstream"), V.CLICKSTREAM_DDL, X.instant(_CONSUMED))
    _finish(L.land_batches(parsed.withColumn("event_ts", X.parse_ts("event_ts")), out, mark, _NOW_ONLY, "event_ts", "1 hour"))
    rows, late = (L.read_batches(spark, out, n).select("event_id", "event_type", "event_ts") for n in ("rows", "late"))
    once = D.top1_by(rows, "event_id", [F.col("event_ts").asc_nulls_last()])
    return E.with_late(once, late, "event_id", "event_ts")


@query
def stream_metrics(spark, d):
    """Counters summed over one line per micro-batch; nothing landed is read again."""
    out, mark = scratch_path(spark, "batches"), scratch_path(spark, "mark")
    parsed = L.parse_stream(_in_batches(spark, d, "orders"), V.ORDERS_DDL, X.instant(_CONSUMED))
    _finish(L.land_batches(parsed, out, mark, _NOW_ONLY))
    return L.batch_totals(L.read_batches(spark, out, "metrics")).select("consumed", "parse_errors")


@query
def sessionize(spark, d):
    return E.sessionize(_clicks(spark, d), "customer_id", "event_ts")


@query
def sessionize_stream(spark, d):
    """The sessions of ``sessionize`` from a stream; one far later event pushes the watermark past them."""
    inbox, out, mark = (scratch_path(spark, n) for n in ("clicks", "sessions", "mark"))
    clicks = _clicks(spark, d).select("customer_id", "event_ts").filter("customer_id is not null")
    last = clicks.agg(F.lit("closer").alias("customer_id"), (F.max("event_ts") + F.expr("interval 30 days")).alias("event_ts"))
    clicks.unionByName(last).write.parquet(inbox)
    stream = spark.readStream.schema(clicks.schema).parquet(inbox)
    _finish(L.land_table(E.sessionize_stream(stream, "customer_id", "event_ts"), out, mark, _NOW_ONLY))
    return spark.read.parquet(out)


def _stock_events(spark, d):
    """Every order line moves stock: sales take, returned lines bring back."""
    line = T.table(spark, d, "lineitem")
    qty = F.col("l_quantity").cast("int")
    return line.select(
        F.concat(F.lit("WH-"), (F.col("l_suppkey") % 5).cast("string")).alias("warehouse_id"),
        F.col("l_partkey").cast("string").alias("product_sku"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", qty).alias("event_id"),
        F.when(F.col("l_returnflag") == "R", "return").otherwise("sale").alias("event_type"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
        F.when(F.col("l_returnflag") == "R", qty).otherwise(-qty).alias("quantity_change"),
        (F.lit(5000) - qty * F.lit(10)).alias("new_quantity"),
    )


@query
def inventory_events(spark, d):
    return E.latest_stock(_stock_events(spark, d))


_STOCK_ROWS = 3_000_000     # stock events in three files, one for each micro-batch


@query
def inventory_events_stream(spark, d):
    """The stock of ``inventory_events`` kept by a stream that writes what each micro-batch changes."""
    inbox, out, mark = (scratch_path(spark, n) for n in ("stock", "latest", "mark"))
    events = _stock_events(spark, d)
    files = max(1, -(-events.count() // _STOCK_ROWS))
    events.repartition(3 * files).write.parquet(inbox)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(inbox)
    _finish(L.land_changes(E.latest_stock(stream), out, mark, _NOW_ONLY))
    return L.newest_changes(spark.read.parquet(out), "warehouse_id", "product_sku")
