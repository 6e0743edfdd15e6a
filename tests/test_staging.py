"""What the queries stage: packed, by the rows asked for, and without shuffles of wide rows."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from benchset import queries as B
from benchset import tables as T
from tillroll import session
from tillroll.operators import maintain as M
from tillroll.operators.dedup import dedup_latest
from tillroll.plans import daily
from tillroll.sources import writers
from tillroll.streaming import landing as L


@pytest.fixture
def given(spark, tmp_path):
    day = datetime(2001, 5, 6)
    orders = [(k, k % 3, "OFP"[k % 3], 100.5 * k, day, "5-LOW") for k in (1, 2, 3, 4, 53)] + [(2, 1, "O", 7.0, day, "5-LOW")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, day, k, "view", 1.5, "{}") for k in range(5)], "event_id long, ts timestamp_ntz, user_id long, "
                          "event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    lines = [(k, k % 4, k % 2, 1, 2.0, 1.0, 0.0, 0.0, "R" if k % 3 else "N", "O", day) for k in range(40)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_orders_are_packed_and_whole(spark, given):
    root = B._bronze(spark, given, "orders")
    files = [f for f in Path(f"{root}/orders/date={T.AS_OF}").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".txt.gz") for f in files)
    found = sorted(r["value"] for r in spark.read.text(f"{root}/orders").collect())
    assert found == sorted(r["value"] for r in T.raw_order_lines(spark, given).filter("value is not null").collect())


def test_the_setting_of_open_files_is_put_back(spark):
    with B._unsorted(spark, 5):
        assert spark.conf.get(B._OPEN_FILES) == "5"
    assert spark.conf.get(B._OPEN_FILES) == "0"


def test_order_versions_are_dealt_out_before_they_are_widened(spark, given):
    text = plan(T.raw_orders(spark, given, T.even))
    assert text.index("Generate") < text.index("Exchange") and text.count("Exchange") == 1


def test_what_the_versions_share_is_made_before_there_are_several(spark, given):
    text = T.raw_orders(spark, given, T.even).select("items")._jdf.queryExecution().optimizedPlan().toString()
    # printed from the last step up: nothing is made of the items once the versions are there
    assert "transform(" not in text[:text.index("Generate explode")]
    assert "transform(" in text


def test_the_window_over_versions_shuffles_no_lines(spark, given):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    lines = T.raw_order_lines(spark, given, B._by_order)
    text = plan(lines.withColumn("n", F.row_number().over(Window.partitionBy("o_orderkey").orderBy("value"))))
    assert text.count("Exchange") == 1 and text.index("Generate") < text.index("Exchange")


def test_messages_hold_the_asked_topics_only(spark, given):
    assert {r["topic"] for r in spark.read.parquet(B._messages(spark, given, "clickstream")).collect()} == {"clickstream"}
    both = spark.read.parquet(B._messages(spark, given, "orders", "clickstream"))
    assert {r["topic"] for r in both.collect()} == {"orders", "clickstream"}


def test_a_message_is_parsed_once(spark):
    stream = spark.createDataFrame([("t", 0, 0, "k", "{}", None), ("t", 0, 1, "k", None, None)], L.MESSAGE_DDL)
    good, bad = L.split_bad(L.parse_stream(stream, "a int, b string"))
    for side in (good, bad):
        assert side._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert (good.count(), bad.count()) == (1, 1)


def test_a_merge_deletes_what_it_has_staged(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, p int")
    writers.write_partitioned(rows, path, ["p"])
    shared = Path(session.shared_dir(spark))
    before = {f.name for f in shared.iterdir()} if shared.exists() else set()
    M.merge_into_table(spark, path, rows.filter("k = 'a'").selectExpr("k", "7 as v", "p"), "k", ["p"])
    assert {f.name for f in shared.iterdir()} - before == set()
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 7, 1), ("b", 2, 1)]


def test_stock_files_grow_with_the_rows_not_the_batches(spark, given, monkeypatch):
    made = []
    land = L.land_changes
    monkeypatch.setattr(L, "land_changes", lambda changes, out, *a: made.append(out) or land(changes, out, *a))
    monkeypatch.setattr(B, "_STOCK_ROWS", 10)
    files = []
    monkeypatch.setattr(B, "scratch_path", lambda s, n: files.append(session.scratch_path(s, n)) or files[-1])
    found = B.inventory_events_stream(spark, given).collect()
    assert sum(f.name.startswith("part-") for f in Path(files[0]).iterdir()) == 12
    assert len(list(Path(made[0]).glob("batch=*"))) == 3
    assert sum(r["events"] for r in found) == 40


_LANDED = "order_id string, updated_at string, notes string, date string"


@pytest.mark.parametrize("most", [100, 0])
def test_only_orders_that_landed_more_than_once_are_sorted(spark, monkeypatch, most):
    monkeypatch.setattr(daily, "REPEATED_KEYS", most)
    once = spark.createDataFrame([("a", "1", "x", "d"), ("b", None, "y", "d"), (None, "3", "z", "d")], _LANDED)
    assert "Window" not in plan(daily._newest_landed(once))
    assert sorted(r["order_id"] for r in daily._newest_landed(once).collect()) == ["a", "b"]
    more = once.unionByName(spark.createDataFrame(
        [("a", "2", "new", "d"), ("a", None, "none", "d"), ("b", None, "other", "d"), ("b", None, "y", "d")], _LANDED))
    found = daily._newest_landed(more)
    assert found.columns == more.columns and "Window" not in plan(found)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, dedup_latest(more, "order_id", "updated_at").collect()))


def test_a_merge_leaves_a_staged_source_where_it_is(spark, tmp_path, monkeypatch):
    path, names = f"{tmp_path}/t", []
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, p int")
    writers.write_partitioned(rows, path, ["p"])
    stage = M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name, *a: names.append(name) or stage(df, name, *a))
    M.merge_into_table(spark, path, rows.filter("k = 'a'").selectExpr("k", "7 as v", "2 as p"), "k", ["p"], restage=False)
    assert "merge-source" not in names and "merge-result" in names
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 7, 2), ("b", 2, 1)]


def test_dated_lines_are_those_that_their_text_tells(spark, given):
    lines = T.raw_order_lines(spark, given, B._by_order, ("updated_at", "order_date"))
    both = B._read_back(lines).select(
        "at", F.get_json_object("value", "$.updated_at").alias("told"), B._on_the_first().alias("moved"),
        F.regexp_replace("value", r'("order_date":"\d{4}-\d{2})-\d{2}', "$1-01").alias("replaced")).collect()
    assert len(both) > 6 and any(r["at"] is None for r in both) and any("-01 " in r["moved"] for r in both)
    assert all(r["at"] == r["told"] and r["moved"] == r["replaced"] for r in both)


def test_promotions_need_no_stored_orders(spark, given):
    assert B._promos(spark, given).count() > 0
    assert (spark.sparkContext.applicationId, given, "silver_orders") not in B._STAGED
