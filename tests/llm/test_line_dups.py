"""Line dedup against a plain version, and its edge cases."""

import random
from collections import defaultdict

from tillroll.llm.line_dups import MARGIN, UPPER, LOWER, with_lines

TO_LOWER = str.maketrans(UPPER, LOWER)


def key(line):
    return line.strip(MARGIN).translate(TO_LOWER)


def plain(rows, least_chars=40, least_docs=5):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (
            len(holders.get(key(x), ())) >= least_docs and (doc is None or doc != max(holders[key(x)])))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(docs, **settings):
    return [(r.doc_id, r.lines.n_lines, r.lines.n_dropped, r.lines.kept) for r in with_lines(docs, **settings).collect()]


def test_equals_plain_version(spark):
    rng = random.Random(3)
    pool = [f"{'  ' * (k % 2)}Shared line number {k} in which some Äpfel are long enough\t" for k in range(40)]
    pool += [x.upper() for x in pool[:10]] + ["short"] * 5 + [""] * 5
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randrange(0, 12)))) for k in range(80)]
    rows += [(None, pool[0]), (3, pool[1]), (3, pool[1]), (200, None), (201, ""), (202, "\n"), (202, "\n\n" + pool[2])]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(run(docs), key=repr) == sorted(plain(rows), key=repr)


def test_margin_length_and_threshold(spark):
    edge = "x" * 40
    rows = [(k, f"a\n\x0b {edge.upper() if k % 2 else edge} \x0c\nb") for k in range(5)]
    rows += [(k, " " + "y" * 38 + "\n" + "z" * 39) for k in range(10, 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {d: (n, gone, kept) for d, n, gone, kept in run(docs)}
    assert all(got[k] == (3, 1, "a\nb") for k in range(4)) and got[4][1] == 0
    assert all(got[k][1] == 0 for k in range(10, 16))
    assert all(gone == 0 for _, _, gone, _ in run(docs.filter("doc_id <> 0"))), "four documents are under the threshold"


def test_whole_text_goes_and_repeats_inside_the_holder_stay(spark):
    line = "the very same sentence stands in every one of these"
    rows = [(k, f"{line}\n{line}") for k in range(6)]
    got = {d: (gone, kept) for d, _, gone, kept in run(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[5] == (0, f"{line}\n{line}") and all(got[k] == (2, "") for k in range(5))


def test_many_lines(spark):
    many = "\n".join(f"line {k} of a text that is long enough to be seen" for k in range(50_000))
    rows = [(k, many if k < 2 else many[: 40_000]) for k in range(5)]
    got = {d: (gone, kept) for d, _, gone, kept in run(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert {d: (gone, kept) for d, _, gone, kept in plain(rows)} == got


def test_empty_table_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert run(none) == []
    named = spark.createDataFrame([(1, "a\nb", "p", 2)], "doc_id long, text string, lines string, pos int")
    row = with_lines(named).first()
    assert row["lines"] == "p" and row["pos"] == 2 and row["lines_"].n_lines == 2
