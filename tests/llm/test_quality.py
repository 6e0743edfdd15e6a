import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import cotraining as C
from tillroll.llm import tree_rules as R

GOOD = "The words of this text are plain and each of them stands for something."


def junk(k):
    return [" ".join(f"w{j}$$$ v{j}###" for j in range(20 + k % 9)), "spam " * (60 + k % 9), "BUY!! NOW!! " * 20][k % 3]


def rows(n=240):
    rng = random.Random(3)
    words = GOOD.split() + [f"word{k}" for k in range(60)]
    out = []
    for k in range(n):
        out.append((k, junk(k) if k % 4 == 0 else " ".join(rng.choice(words) for _ in range(60 + k % 50)) + "."))
    return out


def labels(spark, found, share=2, column="quality"):
    data = [(k, 0 if k % 4 == 0 else 1, 0) for k, _ in found if k % 4 == 0 and k % (4 * share) == 0 or k % 4 and k % share]
    return spark.createDataFrame([*data, (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def test_cotraining_finds_junk_and_scores_every_row(docs_of, spark):
    found = rows()
    docs = docs_of([*found, (None, None), (900, ""), (901, "x" * 300_000), (3, found[3][1])], quality=F.lit("clash"))
    model = C.fit(docs, labels(spark, found))
    assert len(model.handed) == C.ROUNDS and all(sum(h) > 0 for h in model.handed[:1])
    got = C.with_quality(docs, model, into="verdict").collect()
    assert len(got) == len(found) + 4 and got[0]["quality"] == "clash"
    right = [r["verdict"]["kept"] == bool(r["doc_id"] % 4) for r in got if r["doc_id"] is not None and r["doc_id"] < 900]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r["verdict"]["score"] <= 1 for r in got)
    kept = C.good_documents(docs, labels(spark, found))
    assert kept.columns == docs.columns


def test_cotraining_without_labels_or_rows(docs_of, spark):
    docs = docs_of([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["quality"]["score"] for r in C.with_quality(docs, C.fit(docs, none)).collect()] == [0.5, 0.5]
    assert C.good_documents(docs, none).count() == 2
    assert C.good_documents(docs.limit(0), none).count() == 0


def test_pseudo_labels_go_to_the_other_view():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    wide, flat = rng.normal(y[:, None] * 3, 1, (400, 3)), rng.normal(y[:, None] * 3, 1, (400, 2))
    model = C.train(wide[:80], flat[:80], y[:80], wide[80:], flat[80:])
    assert all(a > 0 and b > 0 for a, b in model.handed[:2])
    text, meta, both = model.scores(wide, flat)
    assert ((both > 0.5) == y).mean() >= max(((text > 0.5) == y).mean(), ((meta > 0.5) == y).mean()) - 0.01


def brute(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = Counter(windows)
    spots = {k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(spots),
            len(words) < 50 or 100 * len(spots) > 50 * len(words))


def test_base_counts_equal_brute_force(docs_of, spark):
    rng = random.Random(8)
    texts = ["", None, " \n\t", "a", "a a a a", "a b c a b c", "é ü x\x0by\x0cz", "x\n\nx\n x\nx\r\nx", "#*$%&|<> a", "  a b"]
    texts += ["".join(rng.choice("ab #\n\t|é") for _ in range(rng.randrange(400))) for _ in range(150)]
    texts += [" ".join(rng.choice("abc") for _ in range(5000))]
    docs = docs_of(list(enumerate(texts)), rules=F.lit(1), score=F.lit(2))
    forest = R.train(np.zeros((0, len(R.FEATURES))), np.zeros(0))
    got = R.with_rules(docs, forest, into="out", keep=["doc_id"]).select("doc_id", "out.*").collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_trees_follow_their_directions_and_find_junk(docs_of, spark):
    found = rows(600)
    docs = docs_of(found)
    forest = R.fit(docs, labels(spark, found))
    got = {r["doc_id"]: r["rules"] for r in R.with_rules(docs, forest).collect()}
    right = [(got[k]["score"] >= 0.5) == bool(k % 4) for k, _ in found]
    assert sum(right) / len(right) > 0.97
    rng = np.random.default_rng(2)
    x = np.array([R.measure(t).features for _, t in found])
    for name, way in R.DIRECTIONS.items():
        if not way:
            continue
        f = R.FEATURES.index(name)
        base = x[rng.integers(0, len(x), 50)]
        grid = np.linspace(0, 1, 41)
        scores = []
        for v in grid:
            base[:, f] = v
            scores.append(forest.scores(base))
        assert (way * np.diff(np.array(scores), axis=0) >= -1e-12).all()


def test_flat_arrays_equal_walking_the_trees():
    rng = np.random.default_rng(4)
    x = rng.random((500, len(R.FEATURES)))
    y = (x[:, 4] + x[:, 9] > 1).astype(float)
    forest = R.train(x, y)

    def walk(row):
        total = forest.base
        for t in range(len(forest.feature)):
            k = 0
            while forest.left[t, k] != k:
                k = (forest.right if row[forest.feature[t, k]] > forest.threshold[t, k] else forest.left)[t, k]
            total += forest.value[t, k]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.scores(x[:40]), [walk(r) for r in x[:40]])


def test_rules_without_labels_or_rows(docs_of, spark):
    docs = docs_of([(1, "word " * 5), (2, " ".join(f"w{k}" for k in range(60)))])
    forest = R.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["doc_id"]: r["rules"]["kept"] for r in R.with_rules(docs, forest).collect()} == {1: False, 2: True}
    assert R.with_rules(docs.limit(0), forest).count() == 0


def test_every_unlabelled_document_can_be_handed_over(docs_of, spark):
    found = rows(6000)
    docs = docs_of([(k, t if k < 3000 else " ".join(t.split()[:25])) for k, t in found])
    known = spark.createDataFrame([(k, int(k % 4 > 0)) for k in random.Random(6).sample(range(300), 240)], "doc_id long, quality int")
    model = C.fit(docs, known)
    # a tenth of all 5,760 is more than a tenth of a sample of 4,000
    assert model.handed[0][0] >= 500 and model.handed[0][1] >= 500
    got = C.with_quality(docs, model).collect()
    assert sum(r["quality"]["kept"] == bool(r["doc_id"] % 4) for r in got) / len(got) > 0.97


def test_thresholds_take_the_surest_of_the_counts():
    counts = np.zeros(C.BINS, int)
    counts[[5, 40, 2000, 3000, 4000]] = [30, 30, 500, 30, 30]
    low, high = C.thresholds(counts, 0.5, 80)
    assert counts[: low + 1].sum() == 60 and counts[high:].sum() == 60
    low, high = C.thresholds(counts, 0.5, 60)
    assert counts[: low + 1].sum() == 30 and counts[high:].sum() == 30
    low, high = C.thresholds(counts, 0.5, 1000)
    assert counts[: low + 1].sum() == 60 == counts[high:].sum()


def test_summed_slopes_reach_the_fit_on_all_pseudo_labels():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 900)
    views = [rng.normal(y[:, None] * 1.5, 1, (900, n)) for n in (4, 3)]
    views[0][:, 3] = (np.arange(900) >= 300) * (rng.random(900) < 0.05)      # a kind that no labelled row has
    known, pool = [v[:300] for v in views], tuple(v[300:] for v in views)
    linear = [C.Linear(1e-3).fit(x, y[:300], np.ones(300)) for x in known]
    history = [[(m.weights, 1900, 2200)] for m in linear]
    total = lambda f, h, w: f(pool, h, w)
    for _ in range(8):
        C._refine(linear, known, y[:300], history, 0.5, total)
    for k, label in enumerate(C.told(pool, history)[::-1]):
        rows = np.vstack([known[k], pool[k][label >= 0]])
        both = np.concatenate([y[:300], label[label >= 0]])
        best = C.Linear(1e-3).fit(rows, both, np.append(np.ones(300), np.full((label >= 0).sum(), 0.5)), 5000)
        assert np.abs(linear[k].weights - best.weights).max() < 0.1
