"""Every registered query against its SQL twin, and the shape of the plans."""

import os

import pytest

from __spark_entry__ import entry
from benchset.oracle import ORACLE
from benchset.queries import QUERIES
from compare import differences, duck, duck_rows, spark_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NO_TWIN = set()
SLOW = {"stream_land", "stream_event_date", "write_silver", "pass_rate", "silver_orders_daily", "fact_orders_daily"}   # thousands of date folders


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == NO_TWIN
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_query_equals_its_twin(spark, con, name):
    assert differences(spark_rows(QUERIES[name](spark, SF)), duck_rows(con, ORACLE[name])) == []


@pytest.mark.parametrize("name", sorted(SLOW))
def test_slow_query_equals_its_twin(spark, con, name):
    test_query_equals_its_twin(spark, con, name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


HEAVY = ("fact_orders customer_ml_features order_features browse_features valid_orders dim_customers "
         "snapshot_customers channel_attribution product_performance revenue_share sessionize "
         "fact_customer_asof dq_suite incremental_rows").split()


@pytest.mark.parametrize("name", HEAVY)
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["daily_revenue"](spark, SF))
    assert "PushedFilters: [IsNotNull(order_date_day), GreaterThanOrEqual(order_date_day" in text
    assert "payment_method" not in text


@pytest.mark.parametrize("name", ["daily_revenue", "revenue_summary", "channel_attribution"])
def test_date_filters_keep_folders_closed(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "PartitionFilters: [isnotnull(order_year" in text.replace("PartitionFilters: [(", "PartitionFilters: [") \
        or "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    assert text.count("FileScan") == 1


def test_browse_features_scan_the_clicks_once(spark):
    assert plan(QUERIES["browse_features"](spark, SF)).count("FileScan") == 1


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["segment_customers"](spark, SF))


def test_no_expand_in_the_order_features(spark):
    assert "Expand" not in plan(QUERIES["order_features"](spark, SF))
    assert "Expand" not in plan(QUERIES["browse_features"](spark, SF))


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "customer_profile_text" in df.columns
