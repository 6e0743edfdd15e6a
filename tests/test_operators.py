import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.operators import aggregates as A
from tillroll.operators import calendar as C
from tillroll.operators import dedup as D
from tillroll.operators import filters as W
from tillroll.operators import joins as J
from tillroll.operators import maintain as M
from tillroll.operators import quality as Q
from tillroll.sources import key_index as K
from tillroll.sources.key_index import KeyIndex
from tillroll.sources.writers import write_partitioned


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the orders belong to one customer; some have none."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        who = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"c{rng.randrange(400)}"
        data.append((f"o{i}", who, rng.randrange(100)))
    return spark.createDataFrame(data, "order_id string, customer_id string, v int")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("hot", "H")] + [(f"c{i}", f"n{i}") for i in range(300)], "customer_id string, name string")


def test_spread_join_equals_plain_join(skewed, dim):
    want = rows(skewed.join(dim, "customer_id", "left"))
    got = J.spread_join(skewed, dim, "customer_id", "order_id", piece_rows=100)
    assert rows(got) == want
    assert got.columns == ["customer_id", "order_id", "v", "name"]


def test_spread_join_splits_the_hot_key(spark, skewed, dim):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = J.spread_join(skewed, dim, "customer_id", "order_id", piece_rows=60)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 1500
        assert "SortMergeJoin" in plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_every_hot_key_gets_pieces_by_its_rows(spark, skewed):
    assert [tuple(r) for r in J.hot_keys(skewed, "customer_id", piece_rows=100).collect()] == [("hot", 10)]
    many = spark.range(300 * 7).select((F.col("id") % 300).alias("k"))
    found = J.hot_keys(many, "k", piece_rows=3).collect()
    assert len(found) == 300 and {r["_pieces"] for r in found} == {3}
    dim = spark.range(300).select(F.col("id").alias("k"), F.col("id").alias("v"))
    got = J.spread_join(many.withColumn("n", F.col("k")), dim, "k", F.rand(1), piece_rows=3)
    assert got.count() == 2100 and got.filter("k <> v or v is null").count() == 0


def test_lookup_join_is_one_plan(skewed, dim):
    small = J.lookup_join(skewed, dim, "customer_id", "order_id")
    large = J.lookup_join(skewed, dim, "customer_id", "order_id", piece_rows=100)
    assert rows(small) == rows(large)


def test_join_versions(spark):
    facts = spark.createDataFrame(
        [("1", "a", "2024-01-01"), ("2", "a", "2024-02-01"), ("3", "a", "2023-01-01"),
         ("4", "b", "2024-01-15"), ("5", None, "2024-01-01")], "id string, k string, at string"
    ).withColumn("at", F.to_timestamp("at"))
    versions = spark.createDataFrame(
        [("a", "v1", "2023-06-01", "2024-02-01"), ("a", "v2", "2024-02-01", None),
         ("b", "w", "2020-01-01", "2024-01-01")], "k string, v string, f string, t string"
    ).select("k", "v", F.to_timestamp("f").alias("_valid_from"), F.to_timestamp("t").alias("_valid_to"))
    got = J.join_versions(facts, versions, "k", "at", "id", piece_rows=1).select("id", "v")
    assert rows(got) == [("1", "v1"), ("2", "v2"), ("3", None), ("4", None), ("5", None)]


def test_join_versions_at_every_moment(spark):
    """Against a plain loop, with a hot key in pieces, gaps, facts without key or time, and no range test in a join."""
    rng = random.Random(8)
    start = datetime(2024, 1, 1)
    when = lambda: start + timedelta(hours=rng.randrange(400))
    spans = []
    for k in "abcd":
        ends = sorted({when() for _ in range(9)})
        spans += [(k, f"{k}{n}", f, t) for n, (f, t) in enumerate(zip(ends, ends[1:])) if n % 4 != 2]
        spans.append((k, f"{k}z", ends[-1], None))
    spans += [("a", "never", None, None), (None, "nobody", start, None)]
    facts = [(n, rng.choice(["a"] * 6 + ["b", "c", "d", "e", None]), rng.choice([None] + [when()] * 9)) for n in range(600)]
    want = [(n, next((v for key, v, f, t in spans if key == k and k and at and f and f <= at and (t is None or at < t)), None))
            for n, k, at in facts]
    left = spark.createDataFrame(facts, "id int, k string, at timestamp")
    right = spark.createDataFrame(spans, "k string, v string, _valid_from timestamp, _valid_to timestamp")
    for size in (20, 1_000_000):
        got = J.join_versions(left, right, "k", "at", "id", piece_rows=size)
        assert got.columns == ["k", "id", "at", "v", "_valid_from", "_valid_to"]
        assert sorted(map(tuple, got.select("id", "v").collect())) == want
    joins = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("_valid_from" in line or "_valid_to" in line for line in joins)


def test_fk_integrity(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), ("-1",), (None,), ("y",)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(J.fk_integrity(child, "k", parent, "p", unknown="-1")) == [("x",), ("x",), ("y",)]
    assert rows(J.fk_integrity(child, "k", parent, "p", unknown="-1", limit=2)) == [("x",), ("x",)]


def test_explode_items_drops_empty_orders(spark):
    df = spark.createDataFrame([("a", [("s", 1), ("t", 2)]), ("b", []), ("c", None)],
                               "id string, items array<struct<sku:string,n:int>>")
    assert rows(J.explode_items(df)) == [("a", "s", 1), ("a", "t", 2)]


def test_dedup(spark):
    df = spark.createDataFrame(
        [("a", "1", 1), ("a", "2", 2), ("a", None, 3), ("b", None, 4), (None, "9", 5)],
        "k string, u string, v int")
    assert rows(D.dedup_latest(df, "k", "u")) == [("a", "2", 2), ("b", None, 4)]
    assert rows(D.dedup_first(df, "k", ["u"])) == [("a", "1", 1), ("b", None, 4)]
    twins = spark.createDataFrame([("a", "1", i) for i in range(50)], "k string, u string, v int")
    first = rows(D.dedup_first(twins, "k", ["u"]))
    assert first == rows(D.dedup_first(twins.repartition(7), "k", ["u"])) and len(first) == 1


def test_dedup_limits_each_key_before_the_shuffle(skewed):
    text = plan(D.dedup_latest(skewed, "customer_id", "v"))
    assert text.count("WindowGroupLimit") >= 2


def test_modes(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 1), ("a", None, 2), ("a", "y", None), ("a", "x", 3),
         ("b", None, 5), (None, "x", 1)], "k string, c string, d int")
    got = {r.k: (r.c, r.d) for r in A.mode_by(df, "k", ("c", "d")).collect()}
    assert got == {"a": ("x", "1"), "b": (None, "5")}
    pair = spark.createDataFrame([("a", "x", None), ("a", "x", None), ("a", "x", "m")],
                                 "k string, s string, m string")
    assert rows(A.mode_tuple_by(pair, "k", ("s", "m"))) == [("a", "x", None)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, x double")
    shared = A.share_of_total(df, "x", "p")
    assert rows(shared) == [("a", 1.0, 25.0), ("b", 3.0, 75.0)]
    assert "Join" not in plan(shared) and "Cartesian" not in plan(shared)
    zero = spark.createDataFrame([("a", 0.0)], "k string, x double")
    assert rows(A.share_of_total(zero, "x", "p")) == [("a", 0.0, None)]


def test_incremental_rows(spark):
    src = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 05:00:00"), ("c", None)],
                                "k string, t string").withColumn("_processed_ts", F.to_timestamp("t")).drop("t")
    target = src.filter("k = 'b'")
    assert rows(W.incremental_rows(src, target)) == []
    assert [r.k for r in W.incremental_rows(src, target, lookback_hours=6).orderBy("k").collect()] == ["a", "b"]
    assert [r.k for r in W.incremental_rows(src, src.limit(0)).orderBy("k").collect()] == ["a", "b"]


def test_calendar(spark):
    days = C.dim_date(spark)
    assert days.count() == 2922
    one = days.filter("date_sk = 20240204").first()
    assert (one.day_of_week, one.day_name, one.month_name, one.is_weekend, one.is_holiday_season) == (
        0, "Sunday", "February", True, True)
    assert (one.week_of_year, one.quarter, one.day_of_year) == (5, 1, 35)
    assert C.date_spine(spark, "2024-01-01", "2024-01-03").count() == 3
    assert C.date_spine(spark, "2024-01-01", "2024-01-03", end_inclusive=False).count() == 2
    assert C.date_spine(spark, "2024-01-03", "2024-01-01").count() == 0


DAY1 = [("a", "gold", None, 1), ("b", "gold", "vip", 2), ("c", "gold", "new", 3), ("e", "gold", None, 5)]
DAY2 = [("a", "gold", None, 1), ("b", "platinum", "vip", 2), ("d", "gold", "new", 4), ("e", "gold", "new", 5)]
COLS = "customer_id string, loyalty_tier string, segment string, total_orders int"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def history(df):
    return sorted((r.customer_id, r.loyalty_tier, str(r._valid_from), str(r._valid_to), r._is_current)
                  for r in df.collect())


def test_snapshot(spark):
    day1, day2 = spark.createDataFrame(DAY1, COLS), spark.createDataFrame(DAY2, COLS)
    first = M.snapshot_customers(None, day1, T1)
    second = M.snapshot_customers(first, day2, T2)
    want = [
        ("a", "gold", T1, "None", True),
        ("b", "gold", T1, T2, False), ("b", "platinum", T2, "None", True),
        ("c", "gold", T1, T2, False),
        ("d", "gold", T2, "None", True),
        ("e", "gold", T1, T2, False), ("e", "gold", T2, "None", True),
    ]
    assert history(second) == want
    assert history(M.snapshot_customers(second, day2, T3)) == want
    back = M.snapshot_customers(second, spark.createDataFrame(DAY1, COLS), T3)
    assert [h for h in history(back) if h[0] == "c"] == [
        ("c", "gold", T1, T2, False), ("c", "gold", T3, "None", True)]


def test_scd2_merge_keeps_missing_keys_open(spark):
    first = M.scd2_merge(None, spark.createDataFrame(DAY1, COLS), "customer_id", ["loyalty_tier"], T1)
    second = M.scd2_merge(first, spark.createDataFrame(DAY2, COLS), "customer_id", ["loyalty_tier"], T2)
    got = history(second)
    assert ("c", "gold", T1, "None", True) in got and ("e", "gold", T1, "None", True) in got
    assert len(got) == 6


def test_merge_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = M.merge_upsert(old, new, "k")
    assert rows(once) == [("a", 1), ("b", 3), ("c", 4)] == rows(M.merge_upsert(once, new, "k"))


def test_merge_into_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 3, 2)], "k string, v int, p int"),
                      path, ["p"])
    untouched = sorted(f.name for f in (tmp_path / "t" / "p=2").glob("*.parquet"))
    new = spark.createDataFrame([("b", 9, 1), ("d", 8, 3)], "k string, v int, p int")
    for _ in range(2):
        M.merge_into_table(spark, path, new, "k", ["p"])
        got = rows(spark.read.parquet(path).select("k", "v", "p"))
        assert got == [("a", 1, 1), ("b", 9, 1), ("c", 3, 2), ("d", 8, 3)]
    assert sorted(f.name for f in (tmp_path / "t" / "p=2").glob("*.parquet")) == untouched


def test_merge_follows_a_key_to_another_partition(spark, tmp_path):
    path, cols = str(tmp_path / "t"), "k string, v int, p int"
    write_partitioned(spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 3, 2)], cols), path, ["p"])
    M.merge_into_table(spark, path, spark.createDataFrame([("a", 5, 2), ("c", 6, 3)], cols), "k", ["p"])
    assert rows(spark.read.parquet(path).select("k", "v", "p")) == [("a", 5, 2), ("b", 2, 1), ("c", 6, 3)]
    M.merge_into_table(spark, path, spark.createDataFrame([("b", 7, None)], cols), "k", ["p"])
    assert rows(spark.read.parquet(path).select("k", "v", "p")) == [("a", 5, 2), ("b", 7, None), ("c", 6, 3)]
    assert not (tmp_path / "t" / "p=1").exists()


def test_merge_keeps_the_newest_version(spark, tmp_path):
    path, cols = str(tmp_path / "t"), "k string, v int, p int"
    write_partitioned(spark.createDataFrame([("a", 5, 1), ("b", 2, 1)], cols), path, ["p"])
    late = spark.createDataFrame([("a", 1, 1), ("b", 9, 1)], cols)
    newest = [F.col("v").desc()]
    assert M.merge_into_table(spark, path, late, "k", ["p"], newest, follow_moves=False) == 1
    assert rows(spark.read.parquet(path).select("k", "v")) == [("a", 5), ("b", 9)]


def test_a_merge_that_stops_half_way_is_repaired_by_a_rerun(spark, tmp_path, monkeypatch):
    path, cols = str(tmp_path / "t"), "k string, v int, p int"
    write_partitioned(spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], cols), path, ["p"])
    moved = spark.createDataFrame([("a", 5, 2)], cols)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(M, "_drop_partitions", lost)
        M.merge_into_table(spark, path, moved, "k", ["p"])
    M.merge_into_table(spark, path, moved, "k", ["p"])
    assert rows(spark.read.parquet(path).select("k", "v", "p")) == [("a", 5, 2), ("b", 2, 2)]


def test_many_touched_partitions_still_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(650).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v"),
                                    (F.col("id") % 325).cast("int").alias("p"), F.lit(1).alias("q"))
    write_partitioned(table, path, ["p", "q"])
    touched = spark.range(300).select(F.col("id").cast("int").alias("p"), F.lit(1).alias("q"))
    part = M._partition_filter(spark.read.parquet(path), touched, ["p", "q"])
    assert part.count() == 600
    assert "PartitionFilters: [p#" in plan(part)
    src = spark.range(600).select(F.col("id").cast("string").alias("k"), F.lit(-1).alias("v"),
                                  (F.col("id") % 325).cast("int").alias("p"), F.lit(1).alias("q"))
    assert M.merge_into_table(spark, path, src, "k", ["p", "q"]) == 600
    got = spark.read.parquet(path)
    assert got.count() == 650 and got.filter("v = -1").count() == 600


def test_quality(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", True), ("a", 9, "y", True), ("b", None, None, True), ("b", 3, "x", False),
         (None, 4, "xx", False)], "k string, n int, s string, _is_current boolean")
    parent = spark.createDataFrame([("a",)], "k string")
    checks = [
        Q.row_count(5), Q.row_count(7), Q.not_null("k"), Q.unique("k"), Q.unique("n"),
        Q.between("n", 1, 4), Q.in_set("s", ["x", "y"], Q.WARN), Q.length_equals("s", 1),
        Q.relationships("k", parent, "k", Q.WARN), Q.expression("small", "n", "n < 5"),
        Q.unique_combo(["k", "s"]), Q.one_current("k"),
    ]
    got = {(r.check, r.column, r.failed_rows): r.passed for r in Q.run_suite(df, "t", checks).collect()}
    assert got == {
        ("row_count", "", 0): True, ("row_count", "", 2): False, ("not_null", "k", 1): False,
        ("unique", "k", 4): False, ("unique", "n", 0): True, ("between", "n", 1): False,
        ("in_set", "s", 1): False, ("length_equals", "s", 1): False, ("relationships", "k", 2): False,
        ("small", "n", 2): False, ("unique_combo", "k,s", 0): True, ("one_current", "k", 2): False,
    }
    assert Q.failing_rows(df, checks[5]).count() == 1
    told = Q.failures(df, "t", checks).groupBy("check", "column").count().collect()
    assert {(r["check"], r["column"], r["count"]) for r in told} == {k for k in got if k[2] and k[0] != "row_count"}
    warned = Q.run_suite(df, "t", [Q.in_set("s", ["x", "y"], Q.WARN), Q.unique("n")])
    assert tuple(Q.verdict(warned).first()) == (2, 1, True)
    assert not Q.verdict(Q.run_suite(df, "t", checks)).first().passed


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, n int")
    got = Q.run_suite(df, "t", [Q.row_count(1), Q.unique("k"), Q.not_null("n"),
                                Q.relationships("k", df, "k")]).collect()
    assert [(r.check, r.failed_rows, r.passed) for r in got] == [
        ("row_count", 1, False), ("not_null", 0, True), ("unique", 0, True), ("relationships", 0, True)]


def test_scratch_is_dropped_but_nothing_else(spark):
    from tillroll import session

    other = session.materialize(spark.range(1), "other")
    with session.scratch_scope(spark):
        mine = session.scratch_path(spark, "mine")
        spark.range(3).write.parquet(mine)
        assert spark.read.parquet(mine).count() == 3
    assert other.count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(mine)


def test_key_index_reads_only_the_buckets_of_the_new_keys(spark, tmp_path):
    table = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"),
                                     (F.col("id") % 7).cast("int").alias("p"))
    index = KeyIndex(spark, str(tmp_path / "keys"), "k", ["p"], buckets=64)
    index.ensure(table)
    asked = spark.createDataFrame([("5", 0), ("11", 0), ("none", 0), (None, 0)], "k string, p int")
    found = index.entries(asked)
    assert rows(index.partitions(found, table)) == [(4,), (5,)]
    scan = next(line for line in plan(found).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [bucket" in scan and "ReadSchema: struct<digest:bigint,part_p:string>" in scan


def test_indexed_merges_end_in_the_table_of_plain_ones(spark, tmp_path):
    """Keys move at random, to a null partition too, some merges stop before or after their write."""
    rng, cols = random.Random(3), "k string, v int, p int"
    plain, fast = str(tmp_path / "plain"), str(tmp_path / "fast")
    index = KeyIndex(spark, str(tmp_path / "keys"), "k", ["p"], buckets=4)
    first = spark.createDataFrame([(f"k{i}", 0, i % 5) for i in range(60)], cols)
    write_partitioned(first, plain, ["p"])
    write_partitioned(first, fast, ["p"])
    for turn in range(1, 5):
        some = rng.sample(range(90), 12)
        src = spark.createDataFrame([(f"k{i}", turn, rng.choice([0, 1, 2, 3, 4, None])) for i in some], cols)
        M.merge_into_table(spark, plain, src, "k", ["p"])
        M.merge_into_table(spark, fast, src, "k", ["p"], index=index)
        want = rows(spark.read.parquet(plain).select("k", "v", "p"))
        assert rows(spark.read.parquet(fast).select("k", "v", "p")) == want
        assert len({r[0] for r in want}) == len(want)


@pytest.mark.parametrize("step", ["write_partitioned", "_drop_partitions"])
def test_an_indexed_merge_that_stops_is_repaired_by_a_rerun(spark, tmp_path, monkeypatch, step):
    path, cols = str(tmp_path / "t"), "k string, v int, p int"
    index = KeyIndex(spark, str(tmp_path / "keys"), "k", ["p"], buckets=2)
    write_partitioned(spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], cols), path, ["p"])
    moved = spark.createDataFrame([("a", 5, 2), ("c", 6, 1)], cols)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(M, step, lost)
        M.merge_into_table(spark, path, moved, "k", ["p"], index=index)
    M.merge_into_table(spark, path, moved, "k", ["p"], index=index)
    assert rows(spark.read.parquet(path).select("k", "v", "p")) == [("a", 5, 2), ("b", 2, 2), ("c", 6, 1)]
    back = spark.createDataFrame([("a", 7, 1)], cols)
    M.merge_into_table(spark, path, back, "k", ["p"], index=index)
    assert rows(spark.read.parquet(path).select("k", "v", "p")) == [("a", 7, 1), ("b", 2, 2), ("c", 6, 1)]


def test_key_index_gathers_additions_and_can_be_forgotten(spark, tmp_path, monkeypatch):
    cols = "k string, v int, p int"
    index = KeyIndex(spark, str(tmp_path / "keys"), "k", ["p"], buckets=2)
    table = spark.createDataFrame([("a", 1, 1)], cols)
    index.ensure(table.limit(0))
    for p in (1, 2, 2):
        here = spark.createDataFrame([("a", 1, p)], cols)
        index.add(here, index.entries(here))
    monkeypatch.setattr(K, "FOLD_AFTER", 2)
    index.ensure(table)
    assert index._additions() == [0]
    assert rows(index.partitions(index.entries(table), table)) == [(1,), (2,)]
    index.forget()
    index.ensure(table)
    assert rows(index.partitions(index.entries(table), table)) == [(1,)]
