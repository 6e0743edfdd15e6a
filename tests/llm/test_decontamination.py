import random

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import decontamination as D


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = D.MATCH if x == y else D.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] + D.GAP, table[i][j - 1] + D.GAP)
    return max(map(max, table))


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(3)
    for _ in range(40):
        item = rng.integers(1, 6, rng.integers(1, 15)).astype(np.uint64)
        rest = [rng.integers(1, 6, rng.integers(1, 30)).astype(np.uint64) for _ in range(rng.integers(1, 5))]
        assert D.align(item, rest).tolist() == [smith_waterman(item.tolist(), r.tolist()) for r in rest]


def setting(spark, docs_of):
    rng = random.Random(12)
    common = "the of and to in a is that for it".split()
    words = common * 8 + [f"w{k}" for k in range(800)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = {k: text(rng.randrange(15, 50)) for k in range(20)}
    rows, planted = [], {}
    for d in range(400):
        body = text(rng.randrange(5, 200))
        kind = d % 4
        if kind < 3:
            item = d % 20 if d % 8 else 3               # one item in many documents
            own = list(items[item])
            if kind == 1:                                # every ninth word replaced
                own = [rng.choice(words) if k % 9 == 4 else w for k, w in enumerate(own)]
            if kind == 2:                                # words dropped and added, other case and marks
                own = [w.upper() + "," for k, w in enumerate(own) if k % 11 != 5]
                own.insert(len(own) // 2, "extra")
            at = rng.randrange(len(body))
            body[at:at] = own
            planted[d] = item
        rows.append((d, " ".join(body)))
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    return rows, bench, planted


def test_exact_and_edited_copies_are_found_and_clean_rows_stay(docs_of, spark):
    rows, bench, planted = setting(spark, docs_of)
    got = {r["doc_id"]: r["leak"] for r in D.with_leaks(docs_of(rows, leak_=F.lit(1), score=F.lit(2)), bench).collect()}
    assert {d for d, x in got.items() if x["contaminated"]} == set(planted)
    assert all(planted[d] in got[d]["items"] for d in planted)
    assert all(got[d]["score"] == 1.0 for d in planted if d % 4 == 0)


def test_blocks_give_the_same_result(docs_of, spark, monkeypatch):
    rows, bench, _ = setting(spark, docs_of)
    docs = docs_of(rows)
    one = sorted(map(tuple, D.with_leaks(docs, bench, keep=["doc_id"]).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 200)
    assert len(list(D.benchmark_blocks(bench))) > 2
    assert sorted(map(tuple, D.with_leaks(docs, bench, keep=["doc_id"]).collect())) == one


def test_edge_cases(docs_of, spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilon"),
                                   (None, "zeta eta theta iota"), (2, None), (3, ""), (4, "kappa lambda")],
                                  "item_id long, text string")
    rows = [(1, None), (2, ""), (None, "x alpha beta gamma delta epsilon y"), (3, "zeta eta theta iota"),
            (4, "Kappa, LAMBDA."), (4, "Kappa, LAMBDA."), (5, "w " * 200_000)]
    clash = {c: F.lit("x") for c in ("leak", "block0", "item_id", "score", "items")}
    docs = docs_of(rows, **clash)
    kept = D.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    found = {r["doc_id"]: r["l"] for r in D.with_leaks(docs, bench, "l").filter("doc_id = 3").collect()}
    assert tuple(found[3]) == (None, 1.0, [], True)
    assert D.without_leaks(docs, bench.limit(0)).count() == 7
    assert D.without_leaks(docs.limit(0), bench).count() == 0


def test_every_alignment_over_the_limit_is_found():
    """Edited copies, common and rare words, against aligning every item with every whole document."""
    rng = random.Random(4)
    words = [f"c{k}" for k in range(12)] * 30 + [f"w{k}" for k in range(500)]
    items = [[rng.choice(words) for _ in range(rng.randrange(4, 30))] for _ in range(25)]
    docs = []
    for n in range(300):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        own, every = list(items[n % 25]), 2 + n % 4
        if n % 5 < 3:                                     # every second to fifth word replaced
            own = [rng.choice(words) if k % every == every - 1 else w for k, w in enumerate(own)]
        elif n % 5 == 3:                                  # dropped, at random
            own = [w for w in own if rng.random() > 0.2]
        else:                                             # added
            own = [x for w in own for x in ([w, rng.choice(words)] if rng.random() < 0.3 else [w])]
        at = rng.randrange(len(body) + 1)
        docs.append(body[:at] + own + body[at:])
    block = D.Block([(k, D.plain_words(" ".join(i))) for k, i in enumerate(items)])
    hashed = [D.plain_words(" ".join(d)) for d in docs]
    every = np.concatenate(hashed)
    block.choose_seeds(np.array([(every == w).sum() for w in block.vocabulary.keys]), len(every), len(docs))
    over = 0
    for words in hashed:
        want = [k for k, i in enumerate(block.words) if D.align(i, [words])[0] >= D.LEAST_SCORE * D.MATCH * len(i)]
        over += len(want)
        assert D._best(block, words)["items"] == want
    assert over > 200


def test_every_third_word_replaced_is_found(spark, docs_of):
    item = [f"i{k}" for k in range(18)]
    copy = ["x" if k % 3 == 2 else w for k, w in enumerate(item)]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: tuple(r["leak"])[::2] for r in D.with_leaks(docs_of([(1, " ".join(copy)), (2, "i0 i1 x y")]), bench).collect()}
    assert got[1] == (7, [7]) and got[2][1] == []
