import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import toxicity as X


def corpus():
    """An insult alone is harmless here, and so is a group; together they are toxic."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(1600):
        text = [rng.choice(words) for _ in range(25)]
        kind = k % 4
        text += [["harmless"], ["clown"], ["locals"], ["clown,", "Locals"]][kind]
        rng.shuffle(text)
        rows.append((k, " ".join(text), int(kind == 3)))
    return rows


def test_pairs_of_terms_are_learnt_and_held_out_rows_are_not(docs_of, spark):
    rows = corpus()
    docs = docs_of([(k, t) for k, t, _ in rows], toxicity=F.lit("clash"))
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows], "doc_id long, quality int, toxic int")
    machine = X.fit(docs, labels)
    # wrong labels of held-out rows change nothing
    out = lambda k: zlib.crc32(str(k).encode()) % 3 == 1
    other = spark.createDataFrame([(k, 1, 1 - y if out(k) else y) for k, _, y in rows], "doc_id long, quality int, toxic int")
    again = X.fit(docs, other)
    assert np.array_equal(machine.weights, again.weights) and np.array_equal(machine.factors, again.factors)
    got = {r["doc_id"]: r["m"] for r in X.with_toxicity(docs, machine, into="m").collect()}
    held = [(got[k]["score"], y) for k, _, y in rows if out(k)]
    assert sum((s >= 0.5) == bool(y) for s, y in held) / len(held) > 0.9
    flagged = {r["doc_id"]: r["h"] for r in docs.select("doc_id", X.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(flagged[k] == out(k) for k, _, _ in rows)


def test_the_fast_pair_sum_equals_all_pairs():
    rng = np.random.default_rng(1)
    size = 1 << X.BITS
    machine = X.Machine(0.3, rng.normal(0, 1, size), rng.normal(0, 0.3, (size, X.FACTORS)), np.ones(size, bool))
    text = "One two, three! two FOUR compounded"
    place, value = X.terms(text)
    raw = 0.3 + (machine.weights[place] * value).sum()
    raw += sum(machine.factors[place[a]] @ machine.factors[place[b]] * value[a] * value[b]
               for a in range(len(place)) for b in range(a + 1, len(place)))
    assert np.isclose(machine.scores([text])[0], 1 / (1 + np.exp(-raw)), rtol=1e-4)


def test_terms_are_shares_and_repeats():
    one, two = X.terms("one TWO"), X.terms("two\none.")
    assert all(np.array_equal(a, b) for a, b in zip(one, two))
    place, value = X.terms("a a a b " * 50)
    assert sorted(value.tolist()) == [1.0, 1.0, 3.0, 3.0]           # shares are cut at three per hundred
    active = np.zeros(1 << X.BITS, bool)
    active[place[0]] = True
    some, shares = X.terms("a a a b " * 50, active)
    assert some.tolist() == [place[0]] and shares.tolist() == [value[0]]
    long, _ = X.terms("compounded")
    assert len(long) == 1 + len(X.PREFIXES)


def test_edge_cases(docs_of, spark):
    docs = docs_of([(1, None), (2, ""), (None, "a"), (3, "b"), (3, "b"), (4, "long " * 100_000)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = X.with_toxicity(docs, X.fit(docs, none)).collect()
    assert len(got) == 6 and all(0 <= r["toxicity"]["score"] <= 1 and r["toxicity"]["predicted"] == 0 for r in got)
    assert X.with_toxicity(docs.limit(0), X.fit(docs.limit(0), none)).count() == 0
    assert docs.select(X.held_out(F.col("doc_id")).alias("h")).filter("h is null").count() == 0
