"""Document quality by rules on statistics, with gradient-boosted trees as the verdict.

Each whole text becomes a row of statistics: the four base counts, and shares made from them and
from kinds of characters.  Small trees are boosted on the logistic loss over binned statistics.
For chosen statistics the trees may only go one way: more symbols, more repeated lines or more
repeated words never raise the score.  A split that would break this is not taken, and the
values below a split stay on their side of its middle.

The trees are flattened into arrays (feature, threshold, left, right, value) and all rows of a batch
walk all trees together.  Fitting takes a bounded sample of labelled documents, about ``SAMPLE``
chosen by a hash of doc_id (all, if there are fewer); the model has ``TREES`` * 15 nodes.
Every document is measured and scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import extend, fresh, sampled, sigmoid

SAMPLE = 8_000
TREES, DEPTH, BINS, RATE, PENALTY, LEAST_ROWS = 60, 3, 64, 0.2, 1.0, 10
KEEP_AT = 0.5                  # of the probability of good quality
LEAST_WORDS, MOST_REPEATED = 50, 50

FEATURES = ("n_words", "word_length", "symbols", "dup_lines", "repeated", "upper", "digits", "marks",
            "beyond_ascii", "line_words", "distinct", "same_as_before", "symbol_ends")
# -1: a higher value never raises the score; 0: free
DIRECTIONS = dict.fromkeys(FEATURES, 0) | {"symbols": -1, "dup_lines": -1, "repeated": -1, "same_as_before": -1}
_SYMBOLS = "#*$%&|<>"
_GAPS = " \t\n\x0b\x0c\r"


@dataclass
class Stats:
    """Base counts of a text and the features made from them."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: list[float]

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    total, until = 0, 0
    for at, window in enumerate(windows):
        if count[window] > 1:
            total += at + 3 - max(at, until)
            until = at + 3
    return total


def measure(text: str | None) -> Stats:
    """Statistics of a whole text; a null text has no words."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    chars = len(text) - sum(text.count(c) for c in _GAPS)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    dup = len(lines) - len(set(lines))
    again = repeated_words(words)
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower, digits = int(kinds[65:91].sum()), int(kinds[97:123].sum()), int(kinds[48:58].sum())
    marks = int(kinds[33:127].sum()) - upper - lower - digits
    one, wide = max(1, chars), max(1, n)
    ends = sum(w[-1] in b"#*$%&|!" for w in words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return Stats(n, chars, symbols, dup, again, [
        n, chars / wide, symbols / one, dup / max(1, len(lines)), again / wide, upper / max(1, upper + lower),
        digits / one, marks / one, int(kinds[128:].sum()) / max(1, len(data)), n / max(1, len(lines)),
        len(set(words)) / wide, same / wide, ends / wide])


@dataclass
class Forest:
    """Flattened trees: children of node k of tree t; a leaf is its own child."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of good quality; rows walk all trees together, a level at a time."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            right = x[rows, self.feature[trees, at]] > self.threshold[trees, at]
            at = np.where(right, self.right[trees, at], self.left[trees, at])
        return sigmoid(self.base + self.value[trees, at].sum(axis=1))


def _tree(code: np.ndarray, slope: np.ndarray, curve: np.ndarray, cuts: list[np.ndarray], ways: list[int]) -> dict:
    """One tree as lists of node arrays; grown level by level on binned features."""
    out: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}

    def value(g: float, h: float, low: float, high: float) -> float:
        return min(high, max(low, -g / (h + PENALTY)))

    def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        node = len(out["value"])
        g, h = slope[rows].sum(), curve[rows].sum()
        for name, x in (("feature", 0), ("threshold", np.inf), ("left", node), ("right", node),
                        ("value", RATE * value(g, h, low, high))):
            out[name].append(x)
        best = (1e-6, None)
        for f, way in enumerate(ways if depth < DEPTH and len(rows) >= 2 * LEAST_ROWS else []):
            n = len(cuts[f]) + 1
            gs = np.bincount(code[rows, f], slope[rows], n).cumsum()[:-1]
            hs = np.bincount(code[rows, f], curve[rows], n).cumsum()[:-1]
            ns = np.bincount(code[rows, f], minlength=n).cumsum()[:-1]
            lv = np.clip(-gs / (hs + PENALTY), low, high)
            rv = np.clip(-(g - gs) / (h - hs + PENALTY), low, high)
            # gain of the bounded values: what the loss falls by, to second order
            fall = lambda v, a, b: -(a * v + 0.5 * (b + PENALTY) * v * v)      # noqa: E731
            gain = fall(lv, gs, hs) + fall(rv, g - gs, h - hs) - fall(value(g, h, low, high), g, h)
            fits = (ns >= LEAST_ROWS) & (len(rows) - ns >= LEAST_ROWS)
            if way:
                fits &= way * (rv - lv) >= 0
            gain = np.where(fits, gain, -1)
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), (f, k, float(lv[k]), float(rv[k])))
        if best[1] is None:
            return node
        f, k, lv, rv = best[1]
        middle = (lv + rv) / 2
        sides = [(low, high), (low, high)]
        if ways[f] < 0:
            sides = [(max(low, middle), high), (low, min(high, middle))]
        elif ways[f] > 0:
            sides = [(low, min(high, middle)), (max(low, middle), high)]
        goes = code[rows, f] > k
        out["feature"][node], out["threshold"][node] = f, float(cuts[f][k])
        out["left"][node] = grow(rows[~goes], depth + 1, *sides[0])
        out["right"][node] = grow(rows[goes], depth + 1, *sides[1])
        return node

    grow(np.arange(len(code)), 0, -np.inf, np.inf)
    return out


def train(x: np.ndarray, y: np.ndarray, directions: dict[str, int] = DIRECTIONS) -> Forest:
    """Boosted trees for P(y = 1); without both classes only the prior is learnt."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    nodes = 2 ** (DEPTH + 1) - 1
    grown = []
    if len(set(y.tolist())) == 2:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        raw = np.full(len(x), base)
        for _ in range(TREES):
            p = sigmoid(raw)
            tree = _tree(code, p - y, p * (1 - p), cuts, [directions[f] for f in FEATURES])
            one = _flat(0.0, [tree], nodes)
            score = one.scores(x)
            raw += np.log(score / (1 - score))
            grown.append(tree)
    return _flat(base, grown, nodes)


def _flat(base: float, trees: list[dict], nodes: int) -> Forest:
    shape = (max(1, len(trees)), nodes)
    arrays = {"feature": np.zeros(shape, np.int64), "threshold": np.full(shape, np.inf),
              "left": np.zeros(shape, np.int64), "right": np.zeros(shape, np.int64), "value": np.zeros(shape)}
    for t, tree in enumerate(trees):
        for name, found in tree.items():
            arrays[name][t, : len(found)] = found
    return Forest(base, **arrays)


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """A forest from ``labels`` (doc_id, quality 0/1; nulls are left out)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def compute(batch: pa.RecordBatch) -> list:
        return [[measure(t).features for t in batch.column(1).to_pylist()]]

    rows = texts.join(sampled(known, "doc_id", SAMPLE), "doc_id")
    found = extend(rows, "x array<double>", compute, keep=["doc_id", "quality"]).collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    return train(np.array([r["x"] for r in found]).reshape(-1, len(FEATURES)),
                 np.array([r["quality"] for r in found], float))


def with_rules(docs: DataFrame, forest: Forest, into: str = "rules", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score (0 to 1), kept.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A null or empty text has no words and fails the base rules.
    ``kept`` is false where those fail, else it is the verdict of the trees.  Repeated rows get equal
    results; other columns are passed on.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)
    place = docs.columns.index("text")
    typed = docs.withColumn("text", F.col("text").cast("string"))
    mark = fresh(docs, "marks")

    def compute(batch: pa.RecordBatch) -> list:
        found = [measure(t) for t in batch.column(place).to_pylist()]
        score = sent.value.scores(np.array([s.features for s in found]).reshape(-1, len(FEATURES)))
        return [[{"n_words": s.n_words, "word_chars": s.word_chars, "n_symbols": s.n_symbols,
                  "n_dup_lines": s.n_dup_lines, "n_repeat_words": s.n_repeat_words, "base_failed": s.base_failed,
                  "score": float(p), "kept": bool(not s.base_failed and p >= KEEP_AT)}
                 for s, p in zip(found, score, strict=True)]]

    kind = ("struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, "
            "n_repeat_words: bigint, base_failed: boolean, score: double, kept: boolean>")
    kept = docs.columns if keep is None else keep
    return extend(typed, f"`{mark}` {kind}", compute, keep=kept).withColumnRenamed(mark, into)
