"""Two daily runs over the given tables, from landed files to checked gold tables."""

import json

import pytest
from pyspark.sql import functions as F

from benchset import queries as B
from benchset import tables as T
from tillroll.__main__ import main
from tillroll.operators import maintain
from tillroll.operators.quality import verdict
from tillroll import session
from tillroll.plans import daily
from tillroll.session import sizing
from tillroll.sources import ledger, versions, writers

SF = "/root/testdata/sf0.001"
RUN1, RUN2 = "2024-01-31 12:00:00", "2024-02-01 12:00:00"


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    silver, gold = str(root / "silver"), str(root / "gold")
    for entity in ("orders", "customers", "clickstream", "inventory", "reviews"):
        daily.build_silver(spark, entity, B._bronze(spark, SF, entity), silver, RUN1)
    return silver, gold


def test_two_runs(spark, roots):
    silver, gold = roots
    first = daily.run_gold(spark, silver, gold, T.AS_OF, RUN1)
    failed = {(r.table, r.check, r.column) for r in first.filter("not passed").collect()}
    assert ("fact_orders", "unique", "order_id") not in failed
    assert first.select("table").distinct().count() == 10
    fact = spark.read.parquet(f"{gold}/fact_orders")
    orders = spark.read.parquet(f"{silver}/orders")
    assert fact.count() == orders.count()
    totals = fact.agg(F.sum("total_amount")).first()[0]

    daily.run_gold(spark, silver, gold, T.AS_OF, RUN2)
    again = spark.read.parquet(f"{gold}/fact_orders")
    assert again.agg(F.count("*"), F.sum("total_amount")).first() == (orders.count(), totals)
    history = daily.read_table(spark, gold, "snapshot_customers")
    assert history.count() == spark.read.parquet(f"{silver}/customers").count()
    features = spark.read.parquet(f"{gold}/customer_ml_features")
    assert features.select("snapshot_date").distinct().count() == 1
    assert spark.read.parquet(f"{gold}/quality_results").select("checked_at").distinct().count() == 2
    assert verdict(first).first()["checks"] == first.count()


ORDER = {"order_id": "1", "customer_id": "c", "order_status": "delivered", "order_date": "2024-01-02 10:00:00",
         "total_amount": 10.0, "updated_at": "2024-01-02 10:00:00"}


def land(root, entity, date, rows):
    folder = root / entity / f"date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    (folder / "part.json").write_text("\n".join(lines) + "\n")


def orders_of(spark, silver):
    return {(r["order_id"], str(r["updated_at"]), float(r["total_amount"]))
            for r in spark.read.parquet(f"{silver}/orders").collect()}


def test_days_one_by_one_equal_one_run(spark, tmp_path):
    """Order 4: its newest version is invalid, and an older one lands after it."""
    bronze = tmp_path / "bronze"
    days = {
        "2024-01-02": [ORDER, ORDER | {"order_id": "2"}, ORDER | {"order_id": "4"}, '{"order_id":"9", "total_am'],
        "2024-01-03": [ORDER | {"order_id": "2", "total_amount": 20.0, "updated_at": "2024-01-03 10:00:00",
                                "order_date": "2024-02-01 10:00:00"},
                       ORDER | {"order_id": "4", "order_status": "lost", "updated_at": "2024-01-04 10:00:00"}],
        "2024-01-04": [ORDER | {"order_id": "4", "updated_at": "2024-01-03 00:00:00"},
                       ORDER | {"updated_at": "2024-01-01 00:00:00", "total_amount": 1.0}, ORDER | {"order_id": "3"}],
    }
    for date, rows in days.items():
        land(bronze, "orders", date, rows)
    once, daily_, again = (str(tmp_path / n) for n in ("once", "daily", "again"))
    daily.build_silver(spark, "orders", str(bronze), once, RUN1)
    want = orders_of(spark, once)
    assert {k for k, *_ in want} == {"1", "2", "3"}
    for n, date in enumerate(days):
        counts = daily.build_silver(spark, "orders", str(bronze), daily_, f"2024-02-0{n + 1} 00:00:00", date)
        assert counts["bad"] == (date == "2024-01-02")
    assert orders_of(spark, daily_) == want
    for date in ("2024-01-03", "2024-01-02", "2024-01-04", "2024-01-02"):
        daily.build_silver(spark, "orders", str(bronze), again, RUN1, date)
    assert orders_of(spark, again) == want
    letters = spark.read.text(f"{again}/_dlq/orders")
    assert letters.count() == 1                        # a date that is run again keeps each bad line once


def test_cut_lines_of_customers_and_clicks_become_dead_letters(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", str(tmp_path / "silver")
    land(bronze, "customers", "2024-01-02", [{"customer_id": "a"}, '{"customer_id":"b", "ema', {"customer_id": "c", "total_orders": "x"}])
    land(bronze, "clickstream", "2024-01-02", ['{"event_id":"e'])
    counts = daily.build_silver(spark, "customers", str(bronze), silver, RUN1)
    assert (counts["rows_in"], counts["rows_out"], counts["bad"]) == (3, 1, 2)
    assert daily.build_silver(spark, "clickstream", str(bronze), silver, RUN1)["bad"] == 1


def test_a_customer_missing_from_the_delivery_is_closed(spark, tmp_path):
    bronze, silver, gold = tmp_path / "bronze", str(tmp_path / "silver"), str(tmp_path / "gold")
    land(bronze, "customers", "2024-01-02", [{"customer_id": "a"}, {"customer_id": "b"}])
    land(bronze, "customers", "2024-01-03", [{"customer_id": "a"}, {"customer_id": "c"}])
    for date, now in (("2024-01-02", RUN1), ("2024-01-03", RUN2)):
        daily.build_silver(spark, "customers", str(bronze), silver, now, date)
        daily.build_customer_history(spark, silver, gold)
    rows = daily.read_table(spark, gold, "snapshot_customers").collect()
    assert {(r["customer_id"], r["_is_current"]) for r in rows} == {("a", True), ("b", False), ("c", True)}


def history_of(spark, gold):
    return {(r["customer_id"], r["loyalty_tier"], str(r["_valid_from"])[:10], str(r["_valid_to"])[:10], r["_is_current"])
            for r in daily.read_table(spark, gold, "snapshot_customers").collect()}


def test_deliveries_in_any_order_give_one_history(spark, tmp_path):
    bronze = tmp_path / "bronze"
    tiers = {"2024-01-02": {"a": "gold", "b": "gold", "d": "silver"}, "2024-01-03": {"a": "silver", "c": "gold", "d": "silver"},
             "2024-01-04": {"a": "gold", "b": "gold", "c": "gold", "d": "silver"}}
    for date, known in tiers.items():
        land(bronze, "customers", date, [{"customer_id": k, "loyalty_tier": t} for k, t in known.items()])
    found = []
    for n, turns in enumerate(["234", "432", "3242", "42343"]):
        silver, gold = str(tmp_path / f"silver{n}"), str(tmp_path / f"gold{n}")
        for k in turns:
            daily.build_silver(spark, "customers", str(bronze), silver, f"2024-01-0{k} 03:00:00", f"2024-01-0{k}")
            if k != "2":
                daily.build_customer_history(spark, silver, gold)
        daily.build_customer_history(spark, silver, gold)
        found.append(history_of(spark, gold))
    assert found[0] == {
        ("a", "gold", "2024-01-02", "2024-01-03", False), ("a", "silver", "2024-01-03", "2024-01-04", False),
        ("a", "gold", "2024-01-04", "None", True), ("b", "gold", "2024-01-02", "2024-01-03", False),
        ("b", "gold", "2024-01-04", "None", True), ("c", "gold", "2024-01-03", "None", True),
        ("d", "silver", "2024-01-02", "None", True)}
    assert all(f == found[0] for f in found)


@pytest.fixture
def lake(spark, tmp_path):
    """Roots with the dimensions of the fact, and a reader of its rows."""
    bronze, silver, gold = tmp_path / "bronze", str(tmp_path / "silver"), str(tmp_path / "gold")
    land(bronze, "customers", "2024-01-02", [{"customer_id": "c"}])
    daily.build_silver(spark, "customers", str(bronze), silver, RUN1)
    daily.build_customer_history(spark, silver, gold)

    def run(date, now, fact=True):
        daily.build_silver(spark, "orders", str(bronze), silver, now, date)
        if not current_tables(spark, gold):
            daily.build_dimensions(spark, silver, gold, T.AS_OF, now)
        if fact:
            daily.build_order_fact(spark, silver, gold, now)

    def rows():
        return {(r["order_id"], r["order_status"], float(r["total_amount"])) for r in daily.read_table(spark, gold, "fact_orders").collect()}

    return bronze, silver, gold, run, rows


def current_tables(spark, gold):
    return versions.current_path(spark, f"{gold}/dim_promotions")


def test_a_half_done_merge_and_an_earlier_clock_lose_no_order(spark, lake, monkeypatch):
    bronze, silver, gold, run, rows = lake
    land(bronze, "orders", "2024-01-02", [ORDER])
    land(bronze, "orders", "2024-01-03", [ORDER | {"order_id": "2"}, ORDER | {"order_id": "3", "order_date": "2024-03-02 10:00:00"}])
    land(bronze, "orders", "2024-01-04", [ORDER | {"order_id": "4"}])
    run("2024-01-02", "2024-01-02 03:00:00")
    whole = maintain.write_partitioned

    def half(df, path, parts, sort_by=()):
        whole(df.filter("order_month = 3"), path, parts, sort_by)
        raise OSError("lost between two partitions")

    monkeypatch.setattr(maintain, "write_partitioned", lambda df, path, *more: (
        half if "/fact_orders" in path else whole)(df, path, *more))
    with pytest.raises(OSError, match="lost"):
        run("2024-01-03", "2024-01-03 03:00:00")
    monkeypatch.setattr(maintain, "write_partitioned", whole)
    assert {k for k, *_ in rows()} == {"1", "3"}
    daily.build_order_fact(spark, silver, gold, "2024-01-03 04:00:00")
    assert {k for k, *_ in rows()} == {"1", "2", "3"}
    run("2024-01-04", "2024-01-01 00:00:00")           # back-filled with an earlier clock
    assert {k for k, *_ in rows()} == {"1", "2", "3", "4"}
    assert ledger.last(spark, gold, "fact_orders")["source_run"] == 3
    before = rows()
    daily.build_order_fact(spark, silver, gold, RUN2)
    daily.build_order_fact(spark, silver, gold, RUN2, lookback_runs=2)
    assert rows() == before


def test_an_order_taken_back_leaves_the_fact_and_may_return(spark, lake):
    bronze, silver, gold, run, rows = lake
    land(bronze, "orders", "2024-01-02", [ORDER, ORDER | {"order_id": "2"}])
    run("2024-01-02", "2024-01-02 03:00:00")
    lost = ORDER | {"order_status": "lost", "updated_at": "2024-01-05 10:00:00"}
    land(bronze, "orders", "2024-01-03", [lost])
    run("2024-01-03", "2024-01-03 03:00:00")
    assert {k for k, *_ in rows()} == {"2"}
    land(bronze, "orders", "2024-01-03", [ORDER | {"total_amount": 7.0, "updated_at": "2024-01-03 10:00:00"}])
    run("2024-01-03", "2024-01-03 05:00:00")           # delivered again, without the void version
    assert rows() == {("1", "delivered", 7.0), ("2", "delivered", 10.0)}
    assert spark.read.schema("order_id string, landed string").parquet(f"{silver}/_void/orders").count() == 0


def test_rows_of_a_run_that_is_not_committed_wait(spark, lake, monkeypatch):
    bronze, silver, gold, run, rows = lake
    land(bronze, "orders", "2024-01-02", [ORDER])
    land(bronze, "orders", "2024-01-03", [ORDER | {"order_id": "2"}])
    run("2024-01-02", "2024-01-02 03:00:00")
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run("2024-01-03", "2024-01-03 03:00:00")
    daily.build_order_fact(spark, silver, gold, "2024-01-03 04:00:00")
    assert {k for k, *_ in rows()} == {"1"}
    run("2024-01-03", "2024-01-03 05:00:00")
    assert {k for k, *_ in rows()} == {"1", "2"}


def test_a_clean_delivery_empties_its_dead_letters(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", str(tmp_path / "silver")
    land(bronze, "orders", "2024-01-02", ['{"order_id":"7", "tot'])
    land(bronze, "orders", "2024-01-03", ['{"order_id":"8", "tot', ORDER])
    for date in ("2024-01-02", "2024-01-03"):
        daily.build_silver(spark, "orders", str(bronze), silver, RUN1, date)
    land(bronze, "orders", "2024-01-03", [ORDER])
    daily.build_silver(spark, "orders", str(bronze), silver, RUN2, "2024-01-03")
    assert [r[0] for r in spark.read.text(f"{silver}/_dlq/orders").select("value").collect()] == \
        ['{"_corrupt_record":"{\\"order_id\\":\\"7\\", \\"tot"}']
    land(bronze, "orders", "2024-01-02", [ORDER])
    daily.build_silver(spark, "orders", str(bronze), silver, RUN2)
    assert not writers.has_rows(spark, f"{silver}/_dlq/orders")


FIRST_BAD = {
    "orders": (ORDER | {"order_status": "lost"}, ORDER),
    "customers": ({"email": "x@y.z"}, {"customer_id": "a"}),
    "clickstream": ({"event_id": "e"}, {"event_id": "e", "session_id": "s", "event_ts": "2024-01-02 10:00:00", "event_type": "search"}),
}


@pytest.mark.parametrize("entity", sorted(FIRST_BAD))
def test_a_first_day_without_valid_rows(spark, tmp_path, entity):
    bronze, silver = tmp_path / "bronze", str(tmp_path / "silver")
    for date, row in zip(("2024-01-02", "2024-01-03"), FIRST_BAD[entity], strict=True):
        land(bronze, entity, date, [row])
    daily.build_silver(spark, entity, str(bronze), silver, RUN1, "2024-01-02")
    empty = daily.read_table(spark, silver, entity)
    assert empty.count() == 0
    for now in (RUN1, RUN2):
        daily.build_silver(spark, entity, str(bronze), silver, now, "2024-01-03")
    assert daily.read_table(spark, silver, entity).count() == 1
    assert set(empty.columns) == set(daily.read_table(spark, silver, entity).columns)


def test_a_fact_that_begins_without_an_order(spark, lake):
    bronze, silver, gold, run, rows = lake
    land(bronze, "orders", "2024-01-02", [FIRST_BAD["orders"][0]])
    land(bronze, "orders", "2024-01-03", [ORDER | {"order_id": "2"}])
    run("2024-01-02", RUN1)
    assert rows() == set()
    run("2024-01-03", RUN2)
    assert {k for k, *_ in rows()} == {"2"}


def test_a_failed_write_keeps_the_old_history(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(5), path, ["id"])
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.write_version(broken, path, ["id"])
    assert versions.read_version(spark, path).count() == 5
    for n in range(4):
        versions.write_version(versions.read_version(spark, path).union(spark.range(1)), path, ["id"])
    assert versions.read_version(spark, path).count() == 9
    assert len([n for n, done in versions.versions(spark, path) if done]) == versions.KEPT


def test_staged_tables_of_a_failed_job_stay(spark):
    with pytest.raises(ZeroDivisionError), session.scratch_scope(spark):
        mine = session.materialize(spark.range(3), "mine")
        raise ZeroDivisionError
    assert mine.count() == 3


def test_command_line(spark, roots, capsys):
    silver, gold = roots
    code = main(["gold", "--silver", silver, "--gold", gold, "--as-of", T.AS_OF, "--now", RUN2, "--key-buckets", "16"])
    assert code in (0, 1)
    with pytest.raises(SystemExit):
        main(["silver", "--bronze", "b"])


def test_sizing_grows_with_the_bytes():
    assert int(sizing(1 << 30, 8)["spark.sql.shuffle.partitions"]) == 16
    assert int(sizing(1 << 40, 1000)["spark.sql.shuffle.partitions"]) == 4096
    assert int(sizing(100 << 40, 4000)["spark.sql.shuffle.partitions"]) == 409_600
    assert sizing(1 << 30, 8, 64 << 20)["spark.sql.shuffle.partitions"] == "16"
