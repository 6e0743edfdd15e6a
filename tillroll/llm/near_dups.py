"""Near-duplicate documents by MinHash bands and connected components.

1. Each text becomes its set of word shingles.  Equal sets are one class, found by a 128-bit
   digest with map-side combining, so thousands of copies cost one representative.
2. A representative gets ``bands * rows`` minima of universal hashes; equal values in one band
   are a bucket.  A pair of similarity 0.8 misses all 32 bands of 4 rows with probability 5e-8.
3. In a bucket everything is compared with its most central member (the one with most bucket
   mates), not with each other, so a large group costs a star.  Members that are then in
   another component than that member are paired with those members of the bucket that
   share enough of what sets them apart from it; this loses no link (see
   ``_candidates_by_difference``) and does not pair all with all.
4. A pair is first weighed by its signatures, then confirmed on the full sets of words.
5. Links become components by alternating large-star and small-star steps, each written to
   the shared folder.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tillroll.llm.common import SPACES, extend, fresh, mix, shingles, text_bytes, word_hashes
from tillroll.session import materialize

BANDS, ROWS = 32, 4
# A pair at the limit of 0.8 agrees on 102 of 128 minima on average, deviation 4.5: five are allowed.
AGREE_MARGIN = 5.0


def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(19971215)
    return (rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, count, dtype=np.uint64))


def _minima(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each multiply-shift hash over a set, in slices that fit the cache."""
    low = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), 256):
        part = found[at : at + 256, None] * a
        part += b
        low = np.minimum(low, part.min(axis=0) >> np.uint64(32))
    return low.astype(np.uint32)


def signatures(docs: DataFrame, words: int, hashes: int) -> DataFrame:
    """doc_id, print, n_shingles, two digest halves (d1, d2), and the signature (null for no words)."""

    def compute(batch: pa.RecordBatch) -> list:
        a, b = _universal(hashes)
        sizes, first, second, signed = [], [], [], []
        for value in batch.column(1):
            found = shingles(word_hashes(text_bytes(value).lower()), words)
            sizes.append(len(found))
            first.append(int(mix(found).sum(dtype=np.uint64).astype(np.int64)))
            second.append(int(mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))
            signed.append(_minima(found, a, b).tobytes() if len(found) else None)
        return [sizes, first, second, signed]

    return extend(docs.select("doc_id", "text", "print"), "n_shingles long, d1 long, d2 long, sig binary",
                  compute, keep=["doc_id", "print"])


def _buckets(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """node, bucket: one row per band; the band number is part of the bucket's hash."""

    def run(batches):
        for batch in batches:
            sig = np.stack([np.frombuffer(v, np.uint32) for v in batch.column(1).to_pylist()]) \
                if batch.num_rows else np.zeros((0, bands * rows), np.uint32)
            part = sig.reshape(-1, bands, rows).astype(np.uint64)
            key = np.tile(np.arange(bands, dtype=np.uint64), (len(part), 1))
            for k in range(rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(key.reshape(-1).view(np.int64))], names=["node", "bucket"])

    return reps.select("node", "sig").mapInArrow(run, "node long, bucket long")


def _alike(pairs: DataFrame, reps: DataFrame, percent: int, hashes: int) -> DataFrame:
    """Pairs whose sizes allow the limit and whose signatures come near it."""
    least = hashes * (percent / 100) - AGREE_MARGIN * (hashes * percent / 100 * (1 - percent / 100)) ** 0.5

    def side(name: str) -> DataFrame:
        return reps.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n{name}"),
                           F.col("sig").alias(f"s{name}"))

    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(fits).select("a", "b", "sa", "sb")

    def compute(batch: pa.RecordBatch) -> list:
        return [[int((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).sum())
                 for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]]

    weighed = extend(both, "agree int", compute, keep=["a", "b"])
    return weighed.filter(F.col("agree") >= least).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full sets of word shingles reach the limit."""
    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"t{name}"))

    def whole(value: pa.Scalar) -> set:
        found = text_bytes(value).lower().split()
        width = min(words, len(found))
        return set(zip(*(found[k:] for k in range(width)))) if found else set()

    def compute(batch: pa.RecordBatch) -> list:
        kept, last, own = [], None, set()
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            key = text_bytes(x)
            if key != last:
                last, own = key, whole(x)
            other = whole(y)
            shared = len(own & other)
            kept.append(bool(other) and 100 * shared >= percent * (len(own) + len(other) - shared))
        return [kept]

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return extend(both, "linked boolean", compute, keep=["a", "b"]).filter("linked").select("a", "b").distinct()


def _candidates_by_difference(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of members (a, b) of one central member that may be linked, one of them astray.

    ``pairs`` has a (central), b (member), its component, and whether it is astray: in another
    component than the central member, hence not linked with it.

    Let D(x) be the symmetric difference of x and the central set c.  The symmetric difference of x
    and y has |D(x)| + |D(y)| - 2 |D(x) & D(y)| elements, and x and y are linked if that is at most
    r (|x| + |y|), r = (100 - percent) / (100 + percent).  For an astray x, |D(x)| > r (|x| + |c|), so a
    linked y shares more than (|D(y)| + r (|c| - |y|)) / 2 elements of its D with it.  By the prefix
    principle one of them is among the first of D(y) in any fixed order.  The order is by the number of
    the hub's members that have the element in their D, rarest first.  Elements of one member alone take
    the first places and meet nobody; one that many members add or lack comes last and falls
    out of the prefixes.  So no link is lost, and copies of a hub that differ from each other, or
    share an edit, are not paired all with all although they share a bucket.
    """
    r = (100 - percent) / (100 + percent)

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"t{name}"))

    def compute(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], [], [], []]
        last, hub = None, np.zeros(0, np.uint64)
        for x, y in zip(batch.column(4), batch.column(5), strict=True):
            key = text_bytes(x)
            if key != last:
                last, hub = key, shingles(word_hashes(key.lower()), words)
            own = shingles(word_hashes(text_bytes(y).lower()), words)
            added = np.setdiff1d(own, hub, assume_unique=True)
            removed = np.setdiff1d(hub, own, assume_unique=True)
            order = np.concatenate([added, removed])
            n, c, size = len(order), len(hub), len(own)
            as_member = n - max(0, math.floor((n + r * (c - size)) / 2 - 1e-9))
            as_astray = n - max(1, math.ceil((n - r * (size + c) + (1 - r)) / 2 - 1e-9)) + 1
            for found, value in zip(out, (size, order.view(np.int64), as_member, as_astray), strict=True):
                found.append(value)
        return out

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "component", "astray", "ta", "tb")
    told = materialize(extend(both, "size int, d array<long>, as_member int, as_astray int", compute,
                              keep=["a", "b", "component", "astray"]), "differences")
    each = told.select("a", "b", "component", "astray", "size", "as_member", "as_astray", F.size("d").alias("n_d"),
                       F.explode("d").alias("e"))
    several = each.groupBy("a", "e").agg(F.count("*").alias("members")).filter("members > 1")
    held = each.join(several, ["a", "e"])
    member = Window.partitionBy("a", "b")
    # elements of this member alone stand before its first shared one
    place = F.col("n_d") - F.count("*").over(member) + F.row_number().over(member.orderBy("members", "e")) - 1
    placed = held.withColumn("place", place).filter(F.col("place") < F.greatest(
        F.col("as_member"), F.when(F.col("astray"), F.col("as_astray")).otherwise(0)))
    placed = materialize(placed.drop("members"), "prefixes")

    def spread(part: str, rows: DataFrame, first: str) -> DataFrame:
        return rows.filter(F.col("place") < F.col(first)).select(
            F.col("a").alias(f"a{part}"), F.col("b").alias(part), F.col("component").alias(f"c{part}"),
            F.col("size").alias(f"n{part}"), F.col("n_d").alias(f"d{part}"), F.col("place").alias(f"p{part}"),
            F.col("e").alias(f"e{part}"))

    x = spread("x", placed.filter("astray"), "as_astray")
    y = spread("y", placed, "as_member")
    # what the two can still share from here on must reach what they have to share
    left = F.least(F.col("dx") - F.col("px"), F.col("dy") - F.col("py"))
    enough = 2 * left * (100 + percent) >= (F.col("dx") + F.col("dy")) * (100 + percent) - (
        F.col("nx") + F.col("ny")) * (100 - percent)
    same = (F.col("ax") == F.col("ay")) & (F.col("ex") == F.col("ey")) & (F.col("cx") != F.col("cy")) & enough
    return x.join(y, same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u")
    return moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _downward(links: DataFrame) -> DataFrame:
    """Links (a, b) as edges from the larger to the smaller node."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _step(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """One large star and one small star, written; and a print of the edges, taken by the writing tasks."""
    seen = Observation("edges")
    stars = _small_star(_large_star(edges)).observe(
        seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
    return materialize(stars, "stars"), (seen.get["n"], seen.get["x"])


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for each end of ``links`` (a, b); ends may repeat.

    Alternates large-star and small-star until the edges stay as they are.  Each step is
    written to the shared folder, so a lost executor repeats one step, and no neighbour list
    is collected: a hub's group is a minimum and a join.
    """
    edges, last = materialize(_downward(links), "links"), None
    while True:
        edges, now = _step(edges)
        if now == last or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        last = now


def _text_digest(docs: DataFrame) -> Column:
    """64 bits that tell apart the texts of rows with one doc_id."""
    return F.xxhash64(docs["text"].cast("string"))


def _grouped(docs: DataFrame, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, print (of the text), n_shingles, component (null without shingles or doc_id), component_id.

    A node is a set of shingles, numbered when the sets are written; documents come in again at the end.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       _text_digest(docs).alias("print"))
    hashes = bands * rows
    sets = materialize(signatures(base, words, hashes), "sets")
    digest = ["n_shingles", "d1", "d2"]
    # equal sets have equal signatures, so any one serves
    classes = sets.filter("n_shingles > 0 and doc_id is not null").groupBy(*digest).agg(
        F.min(F.struct("doc_id", "print")).alias("lead"), F.first("sig").alias("sig"))
    reps = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "representatives")

    cells = _buckets(reps, bands, rows)
    sizes = cells.groupBy("bucket").agg(F.count("*").alias("mates")).filter("mates > 1")
    shared = materialize(cells.join(sizes, "bucket"), "buckets")
    weight = shared.groupBy("node").agg(F.sum("mates").alias("weight"))
    central = shared.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("less"))).alias("best"))
    central = central.select("bucket", (-F.col("best.less")).alias("a"))
    members = shared.select("bucket", F.col("node").alias("b")).join(central, "bucket").filter("a <> b")
    members = materialize(members.select("a", "b").distinct(), "members")
    asked = reps.join(shared.select("node").distinct(), "node", "left_semi")
    asked = asked.select("node", F.col("lead.doc_id").alias("doc_id"), F.col("lead.print").alias("print"))
    texts = materialize(
        base.join(asked, ["doc_id", "print"]).groupBy("node").agg(F.first("text").alias("text")), "candidates")
    links = materialize(
        _confirmed(_alike(members, reps, percent, hashes), texts, words, percent), "star-links")

    # One step joins most of what hangs together; where it does not, a pair is only looked at in vain.
    edges, _ = _step(_downward(links))
    own = edges.groupBy(F.col("u").alias("b")).agg(F.min("v").alias("cb"))
    lead = own.select(F.col("b").alias("a"), F.col("cb").alias("ca"))
    placed = members.join(own, "b", "left").join(lead, "a", "left").select(
        "a", "b", F.coalesce("cb", "b").alias("component"),
        (F.coalesce("ca", "a") != F.coalesce("cb", "b")).alias("astray"))
    placed = materialize(placed, "placed")
    unsettled = placed.groupBy("a").agg(F.max("astray").alias("any"), F.count("*").alias("n"))
    pairs = placed.join(unsettled.filter("any and n > 1").select("a"), "a", "left_semi")
    rest = _candidates_by_difference(pairs, texts, words, percent)
    more = _confirmed(rest, texts, words, percent)
    group = components(edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(more))

    whole = reps.select(*digest, "node", "lead.doc_id").join(group, "node", "left").select(
        *digest, F.col("doc_id").alias("first"), F.coalesce("component", "node").alias("component"))
    named = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    return sets.drop("sig").join(whole.drop("first").join(named, "component"), digest, "left").select(
        "doc_id", "print", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the smallest doc_id of its component) per row of ``docs``.

    Sets of ``words``-word shingles over ``[^\\x20\\x09-\\x0D]+`` words, A-Z lower-cased; a pair is
    linked if 100 * intersection >= percent * union.  A text with fewer words is one shingle; a
    null or empty one has none and is linked with nothing.  A null doc_id is linked with
    nothing, its component is null and it is kept.  Rows that repeat a doc_id are judged by
    their own texts and may be in different components.  Further columns are ignored.
    """
    found = _grouped(docs, words, percent, bands, rows)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``docs`` with one row of each near-duplicate component; the same columns.

    The row of the component's smallest doc_id stays; of several such rows one, by its text and its plain
    columns.  Rows whose texts are not linked stay even if they share a doc_id.  So do rows
    without a doc_id and rows without a word.
    """
    found = _grouped(docs, words, percent, bands, rows).filter("component is not null")
    best = found.groupBy("component").agg(F.min(F.struct("doc_id", "print")).alias("best"))
    best = best.select("component", F.col("best.doc_id").alias("best_doc"), F.col("best.print").alias("best_print"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    alone = docs["doc_id"].isNull() | (F.btrim(text, F.lit(SPACES.decode())) == "")
    plain = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and isinstance(f.dataType, AtomicType)]
    marks = [fresh(docs, c) for c in ("print", "group", "turn")]
    named = best.toDF(marks[1], "best_doc", "best_print")
    said = docs.filter(~alone).withColumn(marks[0], _text_digest(docs))
    same = (said["doc_id"].cast("long") == named["best_doc"]) & (said[marks[0]] == named["best_print"])
    order = Window.partitionBy(marks[1]).orderBy("text", *plain)
    chosen = said.join(named, same).withColumn(marks[2], F.row_number().over(order)).filter(F.col(marks[2]) == 1)
    return chosen.select(*[said[c] for c in docs.columns]).unionByName(docs.filter(alone))
