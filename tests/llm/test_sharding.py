import zlib

from pyspark.sql import functions as F

from tillroll.llm.sharding import LEAST, find_splitters, shard_table, sharded


def check(rows, shards=16):
    """Slots are gapless; returns the bytes per shard."""
    size = [0] * shards
    slots = {}
    for r in rows:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return size


def test_bytes_are_near_equal_with_a_hot_text(docs_of):
    rows = [(k, f"document {k} " * (k % 50)) for k in range(3000)] + [(k, "hot " * 25) for k in range(3000, 4500)]
    docs = docs_of(rows)
    for part in (1 << 30, 5000):
        got = shard_table(docs, part_bytes=part).collect()
        assert len(got) == 4500 and {r["law"] for r in got} == {"bytes"}
        sizes = check(got)
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)
    texts = dict(rows)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in got)
    # equal texts lie together: a group of copies is cut by splitters only
    assert len({r["shard"] for r in got if r["doc_id"] >= 3000}) <= 2 + sum(s for *_, s in [(0, 101 * 1500)]) // min(sizes)


def test_splitters_are_exact_without_tolerance(spark):
    keys = spark.range(1000).select((F.col("id") * 7 % 1000).alias("h"), F.lit(0).cast("long").alias("i"),
                                    F.lit(1).cast("long").alias("size"))
    found = find_splitters(keys, 4, 0.0)
    assert found.bounds == [(250, LEAST), (500, LEAST), (750, LEAST)]
    assert found.rows_before == [0, 250, 500, 750] and found.shards == [0, 1, 2, 3]


def test_edge_cases(docs_of, spark):
    rows = [(1, None), (2, ""), (None, "null id"), (3, "same"), (3, "same"), (4, "x" * 500_000)]
    clash = {c: F.lit("kept") for c in ("size", "h", "i", "part", "nth", "place")}
    docs = docs_of(rows, **clash)
    got = shard_table(docs).collect()
    check(got)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got}[1] == (1, 0)
    whole = sharded(docs.withColumn("slot", F.lit("old")), part_bytes=10)
    assert whole.columns == [*docs.columns, "shard", "slot"]
    assert whole.filter("size = 'kept'").count() == 6
    assert shard_table(docs.limit(0)).count() == 0
    one = shard_table(docs.limit(1)).collect()
    assert [r["slot"] for r in one] == [0]


def test_a_long_document_takes_its_own_shard(docs_of):
    rows = [(k, "a" * 9) for k in range(160)] + [(999, "b" * 100_000)]
    got = shard_table(docs_of(rows)).collect()
    check(got)
    assert len(got) == 161


def test_no_python_in_the_plan(docs_of):
    for frame in (shard_table(docs_of([(1, "a")])), sharded(docs_of([(1, "a")]))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
