"""The daily jobs: landed files to silver tables, silver to gold tables, quality results.

Every step is one table write, so a lost executor costs the tasks it ran and a failed step
can be run again on its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import vocabulary as V
from tillroll.functions.expressions import day
from tillroll.functions.keys import surrogate_key
from tillroll.operators import quality as Q
from tillroll.operators.calendar import dim_date
from tillroll.operators.dedup import dedup_latest
from tillroll.operators.maintain import merge_into_table, snapshot_customers
from tillroll.plans import features, gold, suites
from tillroll.plans import silver as S
from tillroll.session import FAST, materialize, scratch_scope
from tillroll.sources import landing, ledger, readers
from tillroll.sources.key_index import BUCKETS, KeyIndex
from tillroll.sources.versions import current_path, read_version, write_version
from tillroll.sources.writers import has_rows, read_stored, replace_dates, write_dlq, write_partitioned

_READ = {
    "orders": readers.read_orders,
    "customers": readers.read_customers,
    "clickstream": readers.read_clickstream,
    "inventory": readers.read_inventory,
    "reviews": readers.read_reviews,
}
_BUILD = {
    "customers": S.silver_customers,
    "clickstream": S.silver_clickstream,
    "inventory": S.silver_inventory,
    "reviews": S.clean_reviews,
}


# entity -> (key, which version stays, may a key change its partition)
def _merge_rules() -> dict[str, tuple[str, list, bool]]:
    last = F.col("_processed_ts").desc()
    return {
        "orders": ("order_id", [F.col("updated_at").desc_nulls_last(), last], True),
        "customers": ("customer_id", [last, F.col("registration_date").desc_nulls_last()], True),
        "clickstream": ("event_id", [F.col("_ingestion_ts").asc_nulls_last(), last], False),
        "reviews": ("review_id", [F.col("review_date").asc_nulls_last(), last], True),
    }


def build_silver(
    spark: SparkSession, entity: str, bronze: str, silver: str, now_ts, date: str | None = None
) -> dict[str, int]:
    """Build the silver partitions of one landed date (or of all), return the row counts.

    Rows of a date may belong to partitions that hold rows of other dates (an order is
    updated days after it was placed), so they are merged into the stored table by key.
    A stock snapshot has no key and replaces its own day.

    The date is a partition filter, so other dates are not read.  The landed text is parsed once,
    into a staged table; the good rows, the dead letters and the number of landed rows all
    come from there.  Returns the landed rows, the rows written and the bad rows.

    Runs of orders and customers are numbered in a ledger and committed last.  Order rows carry the
    number of the run that wrote them; the customers of a run are kept as a delivery.  Gold goes by these.
    What the run has staged is deleted at its end.
    """
    with scratch_scope(spark):
        return _build_silver(spark, entity, bronze, silver, now_ts, date)


def _build_silver(
    spark: SparkSession, entity: str, bronze: str, silver: str, now_ts, date: str | None
) -> dict[str, int]:
    raw = _READ[entity](spark, f"{bronze}/{entity}")
    if date is not None:
        raw = raw.filter(F.col("date") == day(date))
    raw = materialize(raw, f"landed-{entity}", FAST)
    good, bad = raw, 0
    if readers.CORRUPT in raw.columns:
        good, broken = readers.split_corrupt(raw)
        bad = write_dlq(broken, silver, entity, date)
    path, parts = f"{silver}/{entity}", S.PARTITIONS[entity]
    rule = _merge_rules().get(entity)
    gone = gone_to = run = None
    if entity in LEDGERED:
        run = ledger.begin(spark, silver, entity)
    if entity == "orders":
        table, gone = _order_versions(spark, good, now_ts, silver, date), "_invalid"
        table, gone_to = table.withColumn("_run", F.lit(run).cast("long")), _removed_path(silver, run)
    else:
        table = _BUILD[entity](good.drop("date"), now_ts)
    if entity == "customers":
        delivery = _delivery_path(silver, run)
        table.write.mode("overwrite").parquet(delivery)
        table = spark.read.schema(table.schema).parquet(delivery)
    index = _index(spark, silver, entity, rule[0], parts) if rule is not None and rule[2] else None
    if rule is not None and has_rows(spark, path):
        key, order, moves = rule
        rows_out = merge_into_table(
            spark, path, table, key, parts, order, moves, gone=gone, gone_to=gone_to, index=index,
            restage=entity not in LEDGERED)     # what these two merge is staged by now
    else:
        if index is not None:
            index.forget()
        first = table if gone is None else table.filter(~F.col(gone)).drop(gone)
        rows_out = write_partitioned(first, path, parts)
    if run is not None:
        ledger.commit(spark, silver, entity, run, now=str(now_ts), landed=str(date or "all"), rows=rows_out)
    return {"rows_in": raw.count(), "rows_out": rows_out, "bad": bad}


LEDGERED = ("orders", "customers")


KEY_BUCKETS = "spark.tillroll.keyBuckets"     # setting: buckets of a key index; another number builds it anew


def _index(spark: SparkSession, root: str, table: str, key: str, parts: Sequence[str]) -> KeyIndex:
    """Which partitions of a merged table a key may be in."""
    return KeyIndex(spark, f"{root}/_keys/{table}", key, parts, int(spark.conf.get(KEY_BUCKETS, str(BUCKETS))))


def _removed_path(silver: str, run: int) -> str:
    """Keys of the orders that a run has taken out of the silver table."""
    return f"{silver}/_removed/orders/run={run}"


def _delivery_path(silver: str, run: int) -> str:
    """The customers that a run has processed."""
    return f"{silver}/_deliveries/customers/run={run}"


def _order_versions(
    spark: SparkSession, good: DataFrame, now_ts, silver: str, date: str | None
) -> DataFrame:
    """The newest version of each landed order with ``_invalid``, older than no void version.

    An invalid newest version leaves no silver row, so its key and time are kept in ``_void`` by
    the date they landed on: an older version that lands later must not come back.  Days can then be
    run one by one, again, or in any order, and end in the table of one run over all of them.
    A date that is delivered anew replaces its voids, also when it has none any more.

    Orders that landed once need no choice between versions: as long as those that landed more often can be sent
    to every task, only the latter are sorted and staged, and the rows of the others stay where they landed.

    The voids meet the keys and times of the versions only; the whole rows meet the keys that go, which
    are few, so they need no shuffle.
    """
    newest = S.typed_versions(_newest_landed(good), now_ts)
    void, key = f"{silver}/_void/orders", ("order_id", "updated_at")
    landed = F.coalesce(F.col("date").cast("string"), F.lit("none")).alias("landed")
    replace_dates(newest.filter("_invalid and order_id is not null").select(*key, landed), void, "landed", "parquet", date)
    known = spark.read.schema("order_id string, updated_at timestamp, landed string").parquet(void)
    last = known.groupBy("order_id").agg(F.max("updated_at").alias("_void"))
    older = (F.col("_void") > F.col("updated_at")) | (F.col("updated_at").isNull() & F.col("_void").isNotNull())
    gone = newest.filter("not _invalid").select(*key).join(last, "order_id").filter(older).select("order_id")
    return newest.join(materialize(gone, "older-versions"), "order_id", "left_anti").drop("date")


REPEATED_KEYS = 100_000       # keys of orders that landed more than once, sent to every task: some megabytes


def _newest_landed(good: DataFrame) -> DataFrame:
    """``dedup_latest`` of the landed orders, from staged tables; wide rows move where keys repeat only."""
    known = good.filter(F.col("order_id").isNotNull())
    times = known.groupBy("order_id").agg(F.count("*").alias("_times")).filter("_times > 1")
    repeated = materialize(times.select("order_id"), "orders-repeated")
    number = repeated.count()
    if number == 0:
        return known
    if number > REPEATED_KEYS:
        return materialize(dedup_latest(good, "order_id", "updated_at"), "order-versions", FAST)
    several = known.join(repeated, "order_id", "left_semi").select(*good.columns)
    chosen = materialize(dedup_latest(several, "order_id", "updated_at"), "order-versions", FAST)
    return known.join(repeated, "order_id", "left_anti").select(*good.columns).unionByName(chosen)


def pass_rate(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """One line per entity: rows in, rows out and the percentage kept."""
    lines = [(e, c["rows_in"], c["rows_out"]) for e, c in counts.items()]
    frame = spark.createDataFrame(lines, "entity string, rows_in bigint, rows_out bigint")
    kept = F.try_divide(F.col("rows_out") * 100.0, F.col("rows_in"))
    return frame.withColumn("pass_pct", kept.cast("double"))


def require_bronze(spark: SparkSession, bronze: str, date: str) -> None:
    """Stop a run whose required entities have not landed for the date."""
    files = landing.landed_files(spark, bronze, V.REQUIRED_ENTITIES, date)
    if not landing.bronze_complete(landing.landing_report(files), date).first()["complete"]:
        raise RuntimeError(f"the landed files of {date} are not complete")


def run_silver(
    spark: SparkSession, bronze: str, silver: str, now_ts, date: str | None = None,
    entities: Sequence[str] = V.ENTITIES, gate: bool = True,
) -> DataFrame:
    """Silver tables of a landed date, once its required entities are there; or of all dates."""
    if gate and date is not None:
        require_bronze(spark, bronze, date)
    counts = {e: build_silver(spark, e, bronze, silver, now_ts, date) for e in entities}
    return pass_rate(spark, counts)


# --- gold -----------------------------------------------------------------------

FACT_PARTITIONS = ("order_year", "order_month")
FACT_SORT = ("order_date", "customer_sk")


# Rewritten as a whole by each run, as versions; all other tables are partitioned.
VERSIONED = ("snapshot_customers", "dim_customers", "dim_promotions", "dim_date", "fact_reviews")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored silver or gold table."""
    path = f"{root}/{name}"
    return read_version(spark, path) if name in VERSIONED else read_stored(spark, path)


def _tables(spark: SparkSession, root: str, *names: str) -> list[DataFrame]:
    return [read_table(spark, root, n) for n in names]


def build_customer_history(spark: SparkSession, silver: str, gold_root: str) -> None:
    """Put the customer deliveries that are not in it yet into the stored history, in the order they were run.

    A delivery counts from the clock of its silver run, so one that is run late, with an earlier
    clock, takes its place in between.  A customer that a delivery lacks is gone from there on.
    The versions of the history and its ledger are written one after the other; a run that
    stops between them is put in again, which changes nothing.
    """
    path, table = f"{gold_root}/snapshot_customers", "snapshot_customers"
    seen = ledger.last(spark, gold_root, table) or {"source_run": 0, "times": []}
    times = seen["times"]
    for run in ledger.since(spark, silver, "customers", seen["source_run"]):
        known = read_version(spark, path) if current_path(spark, path) else None
        customers = spark.read.parquet(_delivery_path(silver, run["run"]))
        history = snapshot_customers(known, customers, run["now"], deliveries=times)
        write_version(history, path, ("customer_id", "_valid_from"))
        times = sorted({*times, run["now"]})
        ledger.commit(spark, gold_root, table, ledger.begin(spark, gold_root, table),
                      source_run=run["run"], times=times)


def build_dimensions(spark: SparkSession, silver: str, gold_root: str, as_of, now_ts) -> None:
    (history,) = _tables(spark, gold_root, "snapshot_customers")
    write_version(gold.dim_customers(history, as_of, now_ts), f"{gold_root}/dim_customers",
                  ("customer_id", "_valid_from"))
    (orders,) = _tables(spark, silver, "orders")
    write_version(gold.dim_promotions(orders, now_ts), f"{gold_root}/dim_promotions",
                  ("campaign_id",))
    write_version(dim_date(spark), f"{gold_root}/dim_date", ("full_date",))


def build_order_fact(
    spark: SparkSession, silver: str, gold_root: str, now_ts, lookback_runs: int = 0
) -> None:
    """Bring the orders of the silver runs since the last committed one into the order fact.

    What is new is told by run numbers: the mark is in the fact's ledger, which is written after
    the merge, and rows of a silver run that is not committed wait.  A merge that fails half-way, or a silver
    run with an earlier clock, is thus never passed over.  Orders that these runs have taken
    out of the silver table leave the fact too.  ``lookback_runs`` merges as many earlier runs again.
    """
    path, table = f"{gold_root}/fact_orders", "fact_orders"
    orders = read_table(spark, silver, "orders")
    dims = _tables(spark, gold_root, "dim_customers", "dim_date", "dim_promotions")
    number = ledger.begin(spark, gold_root, table)
    upto = (ledger.last(spark, silver, "orders") or {"run": 0})["run"]
    mark = (ledger.last(spark, gold_root, table) or {"source_run": 0})["source_run"]
    index = _index(spark, gold_root, table, "order_sk", FACT_PARTITIONS)
    if has_rows(spark, path):
        start = max(0, mark - lookback_runs)
        fresh = ledger.between(orders, start, upto)
        rows = gold.fact_orders(fresh.drop("_run"), *dims, now_ts).withColumn("_gone", F.lit(False))
        removed = _removed_orders(spark, silver, start, upto, fresh)
        if removed is not None:
            rows = rows.unionByName(removed, allowMissingColumns=True)
        merge_into_table(
            spark, path, rows, "order_sk", FACT_PARTITIONS, sort_by=FACT_SORT, gone="_gone", index=index)
    else:
        index.forget()
        rows = gold.fact_orders(ledger.between(orders, 0, upto).drop("_run"), *dims, now_ts)
        write_partitioned(rows, path, FACT_PARTITIONS, FACT_SORT)
    ledger.commit(spark, gold_root, table, number, source_run=upto, now=str(now_ts))


def _removed_orders(spark: SparkSession, silver: str, start: int, upto: int, fresh: DataFrame) -> DataFrame | None:
    """order_sk and ``_gone`` of the orders taken out by the runs after ``start`` and not back by ``upto``."""
    runs = [r["run"] for r in ledger.since(spark, silver, "orders", start) if r["run"] <= upto]
    paths = [p for p in (_removed_path(silver, n) for n in runs) if has_rows(spark, p)]
    if not paths:
        return None
    keys = spark.read.schema("order_id string").parquet(*paths).distinct()
    return keys.join(fresh.select("order_id"), "order_id", "left_anti").select(
        surrogate_key("order_id").alias("order_sk"), F.lit(True).alias("_gone"))


def build_facts(spark: SparkSession, silver: str, gold_root: str, now_ts, lookback_runs: int = 0) -> None:
    """Add, replace or remove the orders of the silver runs since the last one; rebuild the review fact."""
    build_order_fact(spark, silver, gold_root, now_ts, lookback_runs)
    (reviews,) = _tables(spark, silver, "reviews")
    write_version(gold.fact_reviews(S.silver_reviews(reviews)), f"{gold_root}/fact_reviews",
                  ("product_sku", "review_id"))


def build_features(
    spark: SparkSession, silver: str, gold_root: str, as_of, now_ts, environment: str = "dev"
) -> None:
    fact, dim = _tables(spark, gold_root, "fact_orders", "dim_customers")
    (clicks,) = _tables(spark, silver, "clickstream")
    table = features.customer_ml_features(
        fact, dim, clicks, as_of, now_ts, environment, one_row_per_order=True)
    write_partitioned(table, f"{gold_root}/customer_ml_features", ("snapshot_date",))


def _suites(spark: SparkSession, silver: str, gold_root: str, now_ts) -> list[tuple]:
    """(root, folder, name, checks) of every checked table."""
    (dim,) = _tables(spark, gold_root, "dim_customers")
    return [
        (silver, "orders", "silver_orders", suites.silver_orders_suite()),
        (silver, "customers", "silver_customers", suites.silver_customers_suite()),
        (silver, "clickstream", "silver_clickstream", suites.silver_clickstream_suite()),
        (silver, "inventory", "silver_inventory", suites.silver_inventory_suite()),
        (silver, "reviews", "silver_reviews", suites.silver_reviews_suite()),
        (gold_root, "fact_orders", "fact_orders", suites.fact_orders_suite(dim, now_ts)),
        (gold_root, "dim_customers", "dim_customers", suites.dim_customers_suite()),
        (gold_root, "dim_promotions", "dim_promotions", suites.dim_promotions_suite()),
        (gold_root, "customer_ml_features", "customer_ml_features",
         suites.customer_ml_features_suite()),
        (gold_root, "fact_reviews", "fact_reviews", suites.fact_reviews_suite()),
    ]


def check_tables(spark: SparkSession, silver: str, gold_root: str, now_ts) -> DataFrame:
    """Results of all suites over the stored tables."""
    results = [
        Q.run_suite(read_table(spark, root, folder), name, checks)
        for root, folder, name, checks in _suites(spark, silver, gold_root, now_ts)
    ]
    return reduce(DataFrame.unionByName, results)


def store_failures(spark: SparkSession, silver: str, gold_root: str, now_ts, results: DataFrame) -> None:
    """Keep the rows that break a check under quality_failures/checked_at=.

    ``results`` has one line per check; only the checks that failed are looked at again.
    """
    broken = {(r["table"], r["check"], r["column"]) for r in results.filter("not passed").collect()}
    parts = []
    for root, folder, name, checks in _suites(spark, silver, gold_root, now_ts):
        failed = [c for c in checks if (name, c.name, c.column) in broken]
        parts.append(Q.failures(read_table(spark, root, folder), name, failed))
    rows = [p for p in parts if p is not None]
    if rows:
        found = reduce(DataFrame.unionByName, rows).withColumn("checked_at", F.lit(str(now_ts)))
        write_partitioned(found, f"{gold_root}/quality_failures", ("checked_at",))


def run_gold(
    spark: SparkSession, silver: str, gold_root: str, as_of, now_ts, environment: str = "dev", lookback_runs: int = 0
) -> DataFrame:
    """History, dimensions, facts, features, checks and their failing rows; returns the stored results."""
    build_customer_history(spark, silver, gold_root)
    build_dimensions(spark, silver, gold_root, as_of, now_ts)
    build_facts(spark, silver, gold_root, now_ts, lookback_runs)
    build_features(spark, silver, gold_root, as_of, now_ts, environment)
    results = check_tables(spark, silver, gold_root, now_ts).withColumn("checked_at", F.lit(str(now_ts)))
    write_partitioned(results, f"{gold_root}/quality_results", ("checked_at",))
    stored = spark.read.parquet(f"{gold_root}/quality_results").filter(
        F.col("checked_at") == F.lit(str(now_ts)))
    store_failures(spark, silver, gold_root, now_ts, stored)
    return stored
