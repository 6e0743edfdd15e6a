import random
from itertools import combinations

from pyspark.sql import functions as F

from tillroll.llm.near_dups import components, near_duplicates, one_of_each


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    width = min(width, len(words))
    return frozenset(zip(*(words[k:] for k in range(width)))) if words else frozenset()


def brute(rows, width):
    sets = {d: shingle_set(t, width) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(80)]
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(9)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own))
    rows += ["One two", "one\ttwo ", "one", "ONE", "", None, " \n", "É x", "é x"]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(40)]
    rows.append(" ".join(rng.choice(vocabulary) for _ in range(30_000)))
    return list(enumerate(rows, 10))


def test_equals_brute_force(docs_of):
    rows = corpus()
    for width in (2, 5):
        got = near_duplicates(docs_of(rows), words=width).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute(rows, width)


def test_nulls_repeats_extra_columns_and_empty_tables(docs_of, spark):
    text = " ".join(f"x{k}" for k in range(30))
    rows = [(5, text), (5, text), (None, text), (None, None), (9, text), (7, None)]
    clash = {c: F.lit(1) for c in ("node", "sig", "bucket", "a", "b", "turn", "component_id", "kept")}
    docs = docs_of(rows, **clash)
    got = sorted(near_duplicates(docs).collect(), key=str)
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] == 5] == [(5, True)] * 2
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] == 9] == [(5, False)]
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)] * 2
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 5, 7]
    assert near_duplicates(docs.limit(0)).count() == 0 == one_of_each(docs.limit(0)).count()


def test_rows_that_share_an_id_but_not_a_text_stay(docs_of):
    one, two = (" ".join(f"{c}{k}" for k in range(20)) for c in "xy")
    docs = docs_of([(1, one), (1, two), (2, one), (3, two + " z"), (4, ""), (4, "")])
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (4, 4, True)]
    assert sorted(r["text"] for r in one_of_each(docs).collect()) == ["", "", one, two]


def test_one_edit_that_many_copies_share(docs_of):
    """Each copy has the words ``hot pair`` in another place, and changes of its own."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(300):
        own = list(base)
        for _ in range(rng.randrange(1, 6)):
            own[rng.randrange(60)] = f"own{rng.randrange(200)}"
        at = rng.randrange(50)
        own[at : at + 2] = ["hot", "pair"]
        rows.append((k, " ".join(own)))
    got = near_duplicates(docs_of(rows), words=2).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute(rows, 2)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 200)] + [(7, 7)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 200)}
