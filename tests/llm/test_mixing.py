import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tillroll.llm.mixing import in_mixed_order, mixed, one_period, phases, units


def test_one_period_keeps_every_source_within_one_block():
    rng = random.Random(2)
    for _ in range(30):
        weights = {f"s{k}": rng.randrange(1, 100) for k in range(rng.randrange(1, 12))}
        shares = units(weights, 500)
        assert sum(shares.values()) == 500 and min(shares.values()) >= 1
        slots = one_period(shares, 500)
        owner = {t: s for s, found in slots.items() for t in found}
        assert sorted(owner) == list(range(500))
        got = dict.fromkeys(shares, 0)
        for t in range(500):
            got[owner[t]] += 1
            for s, e in shares.items():
                assert abs(got[s] - Fraction(e * (t + 1), 500)) < 1


def test_phases_place_every_block_once():
    blocks = {"a": 37, "b": 5, "c": 0, None: 120, "d": 1}
    plan = phases(blocks, {"a": 3, "b": 1, "c": 2, None: 2, "d": 4}, period=50)
    slots = []
    for s, n in blocks.items():
        done = 0
        for first, end, base, share, period, offsets in plan[s]:
            assert first == done
            done = end
            slots += [base + j // share * period + offsets[j % share] for j in range(end - first)]
        assert done == n
    assert sorted(slots) == list(range(sum(blocks.values())))


def test_documents_keep_release_and_deadline(docs_of):
    rng = random.Random(5)
    rows = [(k, "x" * rng.randrange(200), rng.choice("aaaab")) for k in range(2000)]
    for ranges in (1 << 26, 1500):
        got = mixed(docs_of(rows), block_bytes=1000, range_bytes=ranges).select("doc_id", "source", "text", "mix.*").collect()
        assert sorted(r["doc_id"] for r in got) == list(range(2000))
        for s in "ab":
            own = sorted((r for r in got if r["source"] == s), key=lambda r: r["before"])
            at = 0
            for r in own:
                assert r["before"] == at and r["block"] == at // 1000
                assert r["release"] <= r["slot"] < r["deadline"]
                at += len(r["text"]) + 1
        owners = {}
        for r in got:
            owners.setdefault(r["slot"], set()).add((r["source"], r["block"]))
        assert max(map(len, owners.values())) == 1


def test_target_weights_are_met(docs_of):
    rows = [(k, "x" * 99, "big" if k % 4 else "small") for k in range(4000)]
    got = mixed(docs_of(rows), {"big": 1, "small": 1}, block_bytes=1000).select("source", "mix.*").collect()
    early = [r for r in got if r["slot"] < 60]
    assert len([r for r in early if r["source"] == "small"]) == 300 == len(early) // 2


def test_edge_cases(docs_of, tmp_path, spark):
    rows = [(1, None, None), (2, "", "a"), (None, "null id", "a"), (3, "same", "a"), (3, "same", "a"),
            (4, "y" * 300_000, "long"), (5, "z", "long")]
    clash = {c: F.lit("kept") for c in ("mix_source", "size", "spot", "part", "total", "mix_plan")}
    with pytest.raises(Exception):
        mixed(docs_of(rows), {"a": 1})
    docs = docs_of(rows, **{c: v for c, v in clash.items() if c not in ("mix_source", "mix_plan")})
    got = mixed(docs)
    assert got.columns == [*docs.columns, "mix"] and got.count() == 7
    assert mixed(docs.limit(0)).count() == 0
    out = in_mixed_order(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert in_mixed_order(docs.limit(0)).count() == 0


def test_files_hold_the_mixed_order(docs_of, tmp_path, spark):
    docs = docs_of([(k, "x" * 50, "ab"[k % 3 == 0]) for k in range(3000)])
    slots = {r["doc_id"]: (r["slot"], r["before"]) for r in mixed(docs, block_bytes=500).select("doc_id", "mix.*").collect()}
    in_mixed_order(docs, block_bytes=500).write.parquet(str(tmp_path / "m"))
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long").alias("p")
    back = spark.read.parquet(str(tmp_path / "m")).select("doc_id", part, F.col("_metadata.row_index").alias("n"))
    order = [slots[r["doc_id"]] for r in sorted(back.collect(), key=lambda r: (r["p"], r["n"]))]
    assert order == sorted(order)


def test_shares_follow_the_given_weights_with_many_unequal_sources():
    rng = random.Random(7)
    cases = [{"hot": 19, **{f"s{k}": 1 for k in range(19)}}, {"hot": 199, **{f"s{k}": 1 for k in range(199)}},
             {f"s{k}": Fraction(rng.randrange(1, 10 ** 6)) for k in range(25)},
             {f"s{k}": rng.random() + 0.01 for k in range(20)}]
    for weights in cases:
        total = sum(map(Fraction, weights.values()))
        plan = phases(dict.fromkeys(weights, 4000), weights)
        owner = {}
        for s, found in plan.items():
            first, end, base, share, period, offsets = found[0]
            assert Fraction(share, period) == Fraction(weights[s]) / total
            owner |= {base + j // share * period + offsets[j % share]: s for j in range(end - first)}
        assert sorted(owner) == list(range(len(owner))) and len(owner) >= 4000
        got = dict.fromkeys(weights, 0)
        for t in range(len(owner)):
            s = owner[t]
            got[s] += 1
            # a source gains only here, so it is furthest ahead now and was furthest behind before
            share = Fraction(weights[s]) / total
            assert got[s] - share * (t + 1) < 1 and share * t - (got[s] - 1) < 1


def test_documents_follow_weights_beyond_one_row_of_blocks(docs_of):
    rows = [(k, "x" * 99, "hot" if k % 2 else f"s{k % 38}") for k in range(8000)]
    weights = {"hot": 19, **{f"s{k}": 1 for k in range(0, 38, 2)}}
    got = mixed(docs_of(rows), weights, block_bytes=1000).select("doc_id", "source", "mix.*").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(8000))
    assert sorted({r["slot"] for r in got}) == list(range(got[0]["slots"]))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    hot = {r["slot"] for r in got if r["source"] == "hot"}
    for t in (100, 500, 700):
        assert abs(len([s for s in hot if s < t]) - t / 2) < 1
