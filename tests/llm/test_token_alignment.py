"""Alignment against overlaps taken pair by pair on whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillroll.llm import token_alignment as T

FILES = f"{T.FOLDER}/{T.BYTE_BPE}", f"{T.FOLDER}/{T.PIECE_BPE}"


@pytest.fixture(scope="module")
def tokenizers():
    return T.Tokenizers(*FILES)


def tokens(tokenizers, text):
    """(id, start, end) of A and B over the whole text, without units; None where bytes differ."""
    if not text:
        return None
    (a,), (b,) = tokenizers.encode([text])
    out = []
    for ids, known in ((a, tokenizers.bytes_a), (b, tokenizers.bytes_b)):
        at, rows = 0, []
        for i in ids:
            rows.append((i, at, at + len(known[i])))
            at = rows[-1][2]
        if b"".join(known[i] for i in ids) != b" " + text.encode():
            return None
        out.append(rows)
    return out


def brute_force(tokenizers, texts):
    told, links, documents = [], [], Counter()
    for text in texts:
        both = tokens(tokenizers, text)
        if both is None:
            told.append((0, 0, 0, ""))
            links.append([])
            continue
        a, b = both
        met = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in rows if low <= s and e <= end) for rows in (a, b)))
            low = end
        told.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(met)
        documents.update(set(met))
    highest = defaultdict(int)
    for (a, _), n in documents.items():
        highest[a] = max(highest[a], n)
    return [(*t[:3], len(m), sum(documents[p] == highest[p[0]] for p in m), sum(documents[p] for p in m), t[3])
            for t, m in zip(told, links, strict=True)]


ODD = [
    None, "", " ", "  a  b ", "x", "naïve café 東京 is  far", "<|endoftext|> </s> <s>", "a\tb\nc d\r\n\ne",
    "nb  sp  x  y", "tri▁cky ▁ x", "0x00 \x00 \x1c \x1f z", "👩‍👩‍👧 fam", "it's they'll 'tis", "a" * 300,
    "same words same words same words", "same words same words same words", "ﬁ ｱ é é",
]


def test_equals_brute_force(spark, tokenizers):
    rows = [(k % 7 or None, t, "x") for k, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    got = [tuple(r) for r in T.alignment(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    want = [(r[0], *w) for r, w in zip(rows, brute_force(tokenizers, ODD), strict=True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_given_documents(spark, tokenizers, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("n_chars < 3000").limit(60).select("doc_id", "text")
    rows = docs.collect()
    docs = spark.createDataFrame([tuple(r) for r in rows], docs.schema)
    got = {r.doc_id: tuple(r)[1:] for r in T.alignment(docs).collect()}
    want = brute_force(tokenizers, [r.text for r in rows])
    assert got == {r.doc_id: w for r, w in zip(rows, want, strict=True)}


def test_units_and_pieces_change_nothing(tokenizers, monkeypatch):
    text = " ".join(f"word{k} it's\n  {k}  Straße" for k in range(400))
    whole = T.Aligner(tokenizers).align([text])[0]
    monkeypatch.setattr(T, "PIECE", 100)
    monkeypatch.setattr(T, "CACHED_UNITS", 20)
    pieces = T.Aligner(tokenizers).align([text])[0]
    monkeypatch.setattr(tokenizers, "cuttable", False)
    uncut = T.Aligner(tokenizers).align([text])[0]
    for other in (pieces, uncut):
        assert other[:4] == whole[:4]
        assert np.array_equal(other[4], whole[4]) and np.array_equal(other[5], whole[5])


def test_texts_that_share_units(tokenizers):
    texts = ["", None, "one two", "two one", "x" * 9, "bad \u2581 one", "one"]
    got = T.Aligner(tokenizers).align(texts)
    assert [g[:4] for g in got] == [T.Aligner(tokenizers).align([t])[0][:4] for t in texts]
    assert got[5][:4] == (0, 0, 0, "") and got[6][0] == 1


def test_long_chain_is_one_group():
    ends_a = np.array([*range(2, 200_000, 2), 200_001])
    ends_b = np.array([*range(1, 200_000, 2), 200_001])
    of_a, of_b = T.jump(ends_a, ends_b)
    assert set(of_a) | set(of_b) == {len(ends_a) + len(ends_b) - 1}
    x, y = T.overlaps(ends_a, ends_b)
    assert len(x) == len(ends_a) + len(ends_b) - 1 and len(set(zip(x.tolist(), y.tolist()))) == len(x)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, pairs int, N_A int")
    assert T.alignment(none).collect() == []


class Counted:
    """Tokenizers that count the texts they are given."""

    def __init__(self, tokenizers):
        self.under, self.texts = tokenizers, []
        self.bytes_a, self.bytes_b, self.cuttable = tokenizers.bytes_a, tokenizers.bytes_b, tokenizers.cuttable

    def encode(self, units):
        self.texts += units
        return self.under.encode(units)


def test_new_units_are_encoded_in_runs(tokenizers):
    counted = Counted(tokenizers)
    aligner = T.Aligner(counted)
    texts = [" ".join(f"w{k}" for k in range(1000)), "\n½ cup  of “tea” ﬁne ", " ".join(f"x{k}" for k in range(100))]
    found = aligner.align(texts)
    assert len(counted.texts) < 200            # 1,100 plain units, one run that does not hold
    assert [f[:4] for f in found] == [f[:3] + (f[6],) for f in brute_force(tokenizers, texts)]


def test_units_that_come_again_stay_when_the_store_is_full(tokenizers, monkeypatch):
    monkeypatch.setattr(T, "CACHED_UNITS", 50)
    monkeypatch.setattr(T, "CACHED_CHARS", 1000)
    monkeypatch.setattr(T, "PIECE", 10)
    counted = Counted(tokenizers)
    aligner = T.Aligner(counted)
    texts = [f"again and{k}" for k in range(200)]
    found = aligner.align(texts)
    assert sum("again" in t.split(" ") for t in counted.texts) == 1
    assert len(aligner.spelled) <= 60
    assert [f[:4] for f in found] == [f[:3] + (f[6],) for f in brute_force(tokenizers, texts)]
