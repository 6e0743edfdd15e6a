"""The manifest against a plain recursive version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tillroll.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root of the nodes and for each its path of (left, right)."""
    paths, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        upper, above = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(H(*run))
            above.append([x for o in owners[at : at + 16] for x in o])
        nodes, owners = upper, above
    return nodes[0], paths


def plain(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for row in rows:
        doc = row[0]
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        text = row[4].translate(low) if hit and row[4] is not None else row[4]
        groups[row[1]].append((doc, H(*map(field, row)), H(*map(field, (*row[:4], text)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for name in names:
        leaves = sorted(groups[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made[name] = (leaves, *tree([x[1] for x in leaves]))
    root, tops = tree([made[n][1] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        leaves, subroot, paths = made[name]
        for (doc, leaf, now), path in zip(leaves, paths, strict=True):
            fold = now
            for left, right in path + top:
                fold = H(left, fold, right)
            proof = H(*[left + right for left, right in path + top])
            out.append((doc, leaf, subroot, root, proof, fold, fold == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, rank int, g string, kids string"


def run(spark, rows, parts=4):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    return [tuple(r) for r in merkle.manifest(docs).collect()]


def documents(counts, seed=1):
    rng, rows = random.Random(seed), []
    for source, n in counts:
        for _ in range(n):
            text = rng.choice(["Some Text É", "lower only", "", None, "x:1"])
            rows.append((len(rows) * 3, source, rng.choice(["en", None]), rng.choice([None, 5, 17]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("counts", [
    [("a", 1)], [("a", 2), (None, 1)], [("hot", 300), ("b", 17), ("é", 16), ("z", 1), (None, 5), ("", 2)],
    [(f"s{k:03d}", 1 + k % 3) for k in range(40)]])
def test_equals_plain_version(spark, counts):
    rows = documents(counts)
    assert sorted(run(spark, rows), key=repr) == sorted(plain(rows), key=repr)


def test_more_tiers(spark, monkeypatch):
    """Blocks of 16 leaves: a source and the sources take several tiers."""
    monkeypatch.setattr(merkle, "DIGITS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = documents([("hot", 700), *[(f"s{k}", 1) for k in range(20)]])
    assert sorted(run(spark, rows), key=repr) == sorted(plain(rows), key=repr)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(7, "a", "en", 1, "T")] * 40 + [(7, "a", "en", 1, "U"), (None, "a", "", 0, "")]
    assert sorted(run(spark, rows), key=repr) == sorted(plain(rows), key=repr)


def test_tampering_is_found(spark):
    rows = [(k, "s", "en", 3, "Abc" if k % 2 else "abc") for k in range(60)]
    for doc, *_, verified in run(spark, rows):
        assert verified != (doc % 2 == 1 and zlib.crc32(str(doc).encode()) % 5 == 0)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_no_python_worker_and_no_join_of_proofs(spark, sf):
    text = merkle.manifest(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in text and "ArrowEval" not in text and "Join" not in text
