"""Registered text queries against their SQL twins, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import differences, duck, duck_rows, spark_rows
from tillroll.llm import mixing
from tillroll.llm.queries import ORACLE, QUERIES

from .test_near_dups import brute


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, sf, name):
    assert differences(spark_rows(QUERIES[name](spark, sf)), duck_rows(duck(sf), ORACLE[name])) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"pipeline"}))
def test_every_row_of_the_table_comes_back(spark, sf, name):
    table, key = ("pages", "page_id") if name.startswith("op5") else ("documents", "doc_id")
    ids = [r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect()]
    assert sorted(r[key] for r in QUERIES[name](spark, sf).collect()) == sorted(ids)


def test_held_out_accuracy(spark, sf):
    big = sf.replace("0.001", "0.1")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    quality = QUERIES["op1_cotrained_quality"](spark, big).collect()
    known = [(r["kept"], labels[r["doc_id"]]["quality"] == 1) for r in quality if r["doc_id"] in labels]
    assert sum(a == b for a, b in known) / len(known) > 0.99
    toxic = [(r["predicted"], labels[r["doc_id"]]["toxic"]) for r in
             QUERIES["op6_factorization_toxicity"](spark, big).collect() if r["doc_id"] in labels and r["held_out"]]
    assert sum(p and not y for p, y in toxic) <= 0.005 * len(toxic)
    assert sum(p for p, y in toxic if y) >= 0.85 * sum(y for _, y in toxic)
    rules = QUERIES["op2_boosted_tree_rules"](spark, big).collect()
    known = [(r["score"] >= 0.5, labels[r["doc_id"]]["quality"] == 1) for r in rules if r["doc_id"] in labels]
    assert sum(a == b for a, b in known) / len(known) > 0.99


def test_pipeline_stage_by_stage(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        seen.append((docs, after))
        docs = after
    texts = lambda frame: {r["doc_id"]: r["text"] for r in frame.collect()}
    assert all(after.columns == columns for _, after in seen[:-1])

    before, after = map(texts, seen[0])
    assert set(after) < set(before)
    before, after = map(texts, seen[1])
    assert set(after) == {d for d, (_, _, kept) in brute(before.items(), 5).items() if kept}
    before, after = map(texts, seen[2])
    items = [" ".join(r["text"].lower().replace(",", " ").replace(".", " ").split())
             for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    flat = {d: " ".join(t.lower().replace(",", " ").replace(".", " ").split()) for d, t in before.items()}
    assert set(before) - set(after) == {d for d, t in flat.items() if any(i in t for i in items)}
    before, after = map(texts, seen[3])
    assert before == after
    slots = {r["doc_id"]: (r["slot"], r["before"]) for r in mixing.mixed(seen[3][0]).select("doc_id", "mix.*").collect()}
    last = seen[4][1].orderBy("shard", "slot").collect()
    assert sorted(r["doc_id"] for r in last) == sorted(after)
    assert [slots[r["doc_id"]] for r in last] == sorted(slots.values())
    sizes = {}
    for r in last:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + len(r["text"].encode()) + 1
    longest = max(len(r["text"].encode()) for r in last)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 2 * longest


def test_pipeline_runs(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == out.select(F.countDistinct("doc_id")).first()[0]
    assert corpus_pipeline.ORACLE_SQL is None
