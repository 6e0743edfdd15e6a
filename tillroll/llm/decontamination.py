"""Documents that contain benchmark items, also edited ones: rare n-gram seeds, then Smith-Waterman.

One pass counts, over the whole corpus, the words that benchmark items use.  From these shares
follows how often a run of words would turn up in a document by chance; runs below ``chance``
are rare and serve as seeds.  That measure stays low for an item that has leaked into a third
of all documents, where a plain document count would call its runs common.

A second pass joins the seeds to the n-grams of every document (a hash join whose build side is
the seeds), and aligns each seeded item with the words around its seeds.  A rare run of three words
is enough; pairs of neighbouring words count together, so that a copy in which every third word is
replaced is found too.  The benchmark is taken in blocks of a stated number of words, counted and
chosen one after the other, and every item is compared with every document.  No row of the corpus
is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import extend, fresh, grams, word_hashes

SEED_WORDS = 3                # run of words that seeds an alignment
CHANCE = 1e-3                 # a rarer run is expected in fewer than this many random documents
PAIR_CHANCE = 1e-2            # the same for pairs of neighbours that seed together
MATCH, MISMATCH, GAP = 2, -1, -2
LEAST_SCORE = 0.5             # of the score of an exact copy
BLOCK_WORDS = 2_000_000       # benchmark words sent to a task at once, about 100 MB
BATCH_CELLS = 1 << 20         # cells of the alignments computed together
# ASCII characters other than letters and digits stand between words.
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text, without ASCII punctuation; a null has none."""
    return word_hashes((text or "").lower().encode("utf-8", "replace").translate(_PLAIN))


class _Lookup:
    """Places of 64-bit keys in a sorted array, behind a bit table that rejects most others."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - min(26, max(10, int(np.ceil(np.log2(64 * len(keys) + 1))))))
        self.seen = np.zeros(1 << int(64 - self.shift), bool)
        self.seen[keys >> self.shift] = True

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``asked`` that are keys, and their places."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.seen[asked >> self.shift])
        place = np.minimum(np.searchsorted(self.keys, asked[at]), len(self.keys) - 1)
        good = self.keys[place] == asked[at]
        return at[good], place[good]


class _Seeds:
    """Hashed runs of item words, and where in which items they stand."""

    def __init__(self, key: np.ndarray, item: np.ndarray, at: np.ndarray):
        order = np.argsort(key, kind="stable")
        key, self.item, self.at = key[order], item[order], at[order]
        self.lookup = _Lookup(np.unique(key))
        self.first = np.searchsorted(key, self.lookup.keys)
        self.last = np.searchsorted(key, self.lookup.keys, side="right")

    def hits(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, where the item would start, place in the item) of each run of a document that is a seed."""
        position, place = self.lookup.find(asked)
        times = self.last[place] - self.first[place]
        each = np.repeat(np.arange(len(position)), times)
        row = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times) + self.first[place][each]
        return self.item[row], position[each] - self.at[row], self.at[row]


def needed_pairs(size: int) -> int:
    """Neighbouring item words that any alignment with a score over the limit takes over as neighbours.

    With M matches, m replaced, d dropped and i added words the score is 2M - m - 2d - 2i, at least
    ``LEAST_SCORE`` * 2 * size, and M + m + d <= size.  Each edit breaks at most one pair of matches,
    so at least M - 1 - m - d - i pairs are left, which is least with replaced words alone.
    """
    return int(np.ceil(size * (4 * LEAST_SCORE - 1) / 3 - 1 - 1e-9))


class Block:
    """Items of one block with their seeds; sent to the tasks."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.sizes = np.array([len(w) for _, w in items], np.int64)
        self.vocabulary = _Lookup(np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words])))
        self.widths: list[int] = []

    def choose_seeds(self, counts: np.ndarray, total: int, documents: int) -> None:
        """Rare runs of each item, one of which is enough, and pairs of neighbours, which count together.

        An item without a rare run, or shorter than a run, gets its rarest.  Of its pairs the common
        ones are left out, but fewer than ``needed_pairs``: an alignment over the limit then still has
        ``least`` of the others, so it is found however common the words are.
        """
        share = np.maximum(counts, 1) / max(total, 1)
        length = np.log(max(total / max(documents, 1), 1))
        runs, pairs = [], []
        self.least = np.ones(len(self.words), np.int64)
        for item, words in enumerate(self.words):
            width = min(SEED_WORDS, len(words))
            if not width:
                continue
            p = np.log(share[np.searchsorted(self.vocabulary.keys, words)])
            odds = sum(p[k : len(p) - width + 1 + k] for k in range(width)) + length
            pick = np.flatnonzero(odds <= max(np.log(CHANCE), np.sort(odds)[min(2, len(odds) - 1)]))
            runs.append((grams(words, width)[pick], np.full(len(pick), item), pick, np.full(len(pick), width)))
            need = needed_pairs(len(words))
            if need < 1:
                continue
            odds = p[:-1] + p[1:] + length
            by_odds = np.argsort(odds, kind="stable")
            out = min(need - 1, int((odds > np.log(PAIR_CHANCE)).sum()))
            pick = np.sort(by_odds[: len(odds) - out])
            self.least[item] = need - out
            pairs.append((grams(words, 2)[pick], np.full(len(pick), item), pick))
        if runs:
            *parts, width = (np.concatenate(x) for x in zip(*runs, strict=True))
            self.runs, self.widths = _Seeds(*parts), sorted(set(width.tolist()))
        self.pairs = _Seeds(*(np.concatenate(x) for x in zip(*pairs, strict=True))) if pairs else None

    def windows(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end): the stretches of a document that its seeds point to.

        A seed says where its item would start; starts that differ by at most half an item
        belong to one stretch, which reaches half an item (three words at least) beyond them.
        No alignment over the limit wanders farther.  A stretch counts if it has a rare run or
        ``least`` different pairs of the item.
        """
        found = [(*self.runs.hits(grams(words, width)), True) for width in self.widths]
        if self.widths and self.pairs is not None:
            found.append((*self.pairs.hits(grams(words, 2)), False))
        item, start, place = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in range(3))
        if not len(item):
            return []
        single = np.concatenate([np.full(len(f[0]), f[3]) for f in found])
        order = np.lexsort((start, item))
        item, start, place, single = item[order], start[order], place[order], single[order]
        opens = np.ones(len(item), bool)
        opens[1:] = (item[1:] != item[:-1]) | (start[1:] - start[:-1] > self.sizes[item[1:]] // 2)
        stretch = np.cumsum(opens) - 1
        heads = np.flatnonzero(opens)
        span = int(self.sizes.max())
        pairs = np.unique(stretch[~single] * span + place[~single]) // span
        enough = np.bincount(pairs, minlength=len(heads)) >= self.least[item[heads]]
        good = np.flatnonzero(enough | np.logical_or.reduceat(single, heads))
        tails = np.append(heads[1:], len(item))[good] - 1
        item, first, last = item[heads[good]], start[heads[good]], start[tails]
        reach = np.maximum(3, self.sizes[item] // 2)
        begin, end = np.maximum(0, first - reach), np.minimum(len(words), last + self.sizes[item] + reach)
        return list(zip(item.tolist(), begin.tolist(), end.tolist(), strict=True))


def align(item: np.ndarray, stretches: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score (Smith-Waterman, linear gaps) of an item with each stretch.

    All stretches are computed together, one item word at a time.  A gap along the stretch is a
    running maximum: H[j] = max over k <= j of T[k] + GAP * (j - k).
    """
    width = max(map(len, stretches))
    words = np.zeros((len(stretches), width), np.uint64)
    real = np.zeros((len(stretches), width), bool)
    for row, s in enumerate(stretches):
        words[row, : len(s)], real[row, : len(s)] = s, True
    slope = (GAP * np.arange(width)).astype(np.int32)
    above = np.zeros((len(stretches), width + 1), np.int32)
    best = np.zeros(len(stretches), np.int32)
    for w in item:
        here = np.where((words == w) & real, MATCH, MISMATCH).astype(np.int32)
        top = np.maximum(np.maximum(above[:, :-1] + here, above[:, 1:] + GAP), 0)
        top = np.maximum.accumulate(top - slope, axis=1) + slope
        above[:, 1:] = top
        best = np.maximum(best, top.max(axis=1, initial=0))
    return best


def _best(block: Block, words: np.ndarray) -> dict:
    """The item with the highest score (then the smallest id, a null one last), that score, and the items found."""
    best, named, leaked = (0.0, False, 0), set(), False
    groups: dict[int, list[np.ndarray]] = {}
    for item, start, end in block.windows(words):
        groups.setdefault(item, []).append(words[start:end])
    for item, stretches in groups.items():
        number, whole = block.ids[item], MATCH * len(block.words[item])
        step = max(1, BATCH_CELLS // (2 * len(block.words[item]) + max(map(len, stretches))))
        for at in range(0, len(stretches), step):
            score = float(align(block.words[item], stretches[at : at + step]).max()) / whole
            best = max(best, (score, number is not None, -(number or 0)))
            if score >= LEAST_SCORE:
                leaked = True
                named |= set() if number is None else {number}
    return {"item_id": -best[2] if best[1] else None, "score": best[0], "items": sorted(named), "contaminated": leaked}


def benchmark_blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The items, dealt into blocks of about ``BLOCK_WORDS`` words by a hash; one block is read at a time.

    Rows that repeat an id are one item each, and so are those without an id; a null text is left out.
    """
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    known = known.filter("text is not null")
    size = known.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = -(-size // (4 * BLOCK_WORDS))       # a word and its gap take four bytes at least on average
    for k in range(parts):
        part = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        rows = part.distinct().orderBy("item_id", "text").collect()
        block = Block([(r["item_id"], plain_words(r["text"])) for r in rows])
        if any(map(len, block.words)):
            yield block


def _count_words(docs: DataFrame, block: Block) -> None:
    """Share of each word of the block among all words of all documents, and the seeds that follow; one pass."""
    size = len(block.vocabulary.keys)
    sent = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches):
        counts, total, documents = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = plain_words(text)
                total, documents = total + len(words), documents + 1
                np.add.at(counts, sent.value.find(words)[1], 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *some.tolist()], pa.int64()),
             pa.array([documents, total, *counts[some].tolist()], pa.int64())], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    sent.destroy()
    block.choose_seeds(np.array([found.get(w, 0) for w in range(size)]), found.get(-1, 0), found.get(-2, 0))


def with_leaks(docs: DataFrame, benchmark: DataFrame, into: str = "leak", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column: item_id, score (0 to 1, 1 is a whole exact copy), items, contaminated.

    ``item_id`` is the best aligned item, null if no seed of any item occurs or it has no id; of equal
    scores the smallest id.  ``items`` lists the ids of all with a score of at least ``LEAST_SCORE``;
    items without an id count in ``contaminated`` alone.  Every copy that aligns with such a score is
    found, but items of up to three words only as their whole run: half of one is a word or two.
    Null and empty texts, and an empty benchmark, give score 0 and no item.  Words are compared without
    case and ASCII punctuation.  Repeated rows are judged one by one.

    The driver holds one block at a time; a task's workers hold those of the benchmark side by side.
    """
    place = docs.columns.index("text")
    texts = docs.select(F.col("text").cast("string").alias("text"))
    kind = "struct<item_id: bigint, score: double, items: array<bigint>, contaminated: boolean>"
    names, out = [], docs.withColumn("text", F.col("text").cast("string"))
    for block in benchmark_blocks(benchmark):
        _count_words(texts, block)
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def compute(batch: pa.RecordBatch, sent=sent) -> list:
            return [[_best(sent.value, plain_words(text)) for text in batch.column(place).to_pylist()]]

        names.append(fresh(out, f"block{len(names)}"))
        out = extend(out, f"`{names[-1]}` {kind}", compute)
    if not names:
        none = F.struct(F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("score"),
                        F.array().cast("array<bigint>").alias("items"), F.lit(False).alias("contaminated"))
        result = none
    else:
        result = reduce(_merged, map(F.col, names))
    kept = docs.columns if keep is None else keep
    return out.select(*kept, result.alias(into))


def _merged(a, b):
    named = b["item_id"].isNotNull() & (a["item_id"].isNull() | (b["item_id"] < a["item_id"]))
    better = (b["score"] > a["score"]) | ((b["score"] == a["score"]) & F.coalesce(named, F.lit(False)))
    return F.struct(
        F.when(better, b["item_id"]).otherwise(a["item_id"]).alias("item_id"),
        F.greatest(a["score"], b["score"]).alias("score"),
        F.array_sort(F.array_union(a["items"], b["items"])).alias("items"),
        (a["contaminated"] | b["contaminated"]).alias("contaminated"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; the same columns."""
    mark = fresh(docs, "leak")
    return with_leaks(docs, benchmark, mark).filter(~F.col(mark)["contaminated"]).select(*docs.columns)
