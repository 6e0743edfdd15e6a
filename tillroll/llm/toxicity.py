"""Toxicity of documents by a factorization machine over hashed terms.

score = sigmoid(w0 + sum of w[t] x[t] + sum over pairs of terms of <v[s], v[t]> x[s] x[t]), over the
terms of a whole text.  The pair part learns that two terms together weigh more than each alone,
such as an insult next to the mention of a group; it costs one pass over the terms, since the sum
over pairs is half of |sum v x|^2 - sum |v x|^2.

A term is a word or the first 4 to 7 bytes of a longer word, as insults are inflected and
compounded.  Each has two hashed places: its share of the words (per hundred, three at most) and
whether it occurs twice.

Fitting takes a bounded sample of labelled documents, about ``SAMPLE`` of them chosen by a hash of
doc_id (all, if there are fewer).  Most terms are noise, so the machine is fitted on terms that a lasso
chooses, and on terms that change how those are to be read: their meetings go with errors
beyond chance.  All other terms keep the weight 0.  Rows whose crc32(doc_id as text) mod 3 is 1
are never learnt from.  Every document is scored in one pass without a shuffle; the model sent to
the tasks has 2^18 * (1 + FACTORS) numbers, about 10 MB.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import extend, fresh, sampled, sigmoid, word_and_prefix_hashes

SAMPLE = 4_000
LEAST_DOCS = 8
BITS, FACTORS = 18, 4
PREFIXES = (4, 5, 6, 7)
MOST_SHARE = 3.0
LASSO, MARGINAL_STEPS = 0.3, 80        # the lasso limit is LASSO / sqrt(documents)
PARTNER_SIGMAS = 5.0
STEPS, RATE = 300, 0.3
PENALTY, PAIR_PENALTY = 1e-4, 1e-3
PREDICT_AT = 0.7
_TWICE = np.int32(0x15A5A)             # the second place of a term differs in these bits
# ASCII characters other than letters and digits stand between words.
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct places of the terms of a text, and their values; a null has none.

    ``active`` marks the places that matter; terms without one are left out early.
    """
    data = (text or "").lower().encode("utf-8", "replace").translate(_PLAIN)
    words, found = word_and_prefix_hashes(data, PREFIXES)
    places = (found >> np.uint64(64 - BITS)).astype(np.int32)
    if active is not None:
        places = places[active[places] | active[places ^ _TWICE]]
    places, count = np.unique(places, return_counts=True)
    share = np.minimum(100.0 * count / max(words, 1), MOST_SHARE)
    twice = places[count >= 2] ^ _TWICE
    # a place can be the first of one term and the second of another: their values add up
    both = np.concatenate([places, twice])
    value = np.concatenate([share, np.ones(len(twice))])
    both, spot = np.unique(both, return_inverse=True)
    value = np.bincount(spot, value, len(both))
    if active is not None:
        both, value = both[active[both]], value[active[both]]
    return both.astype(np.int32), value.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Sparse:
    """Rows of terms as one list of places and values, with the row of each."""

    rows: int
    row: np.ndarray
    place: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, found: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        row = np.repeat(np.arange(len(found), dtype=np.int32), [len(p) for p, _ in found])
        return cls(len(found), row, np.concatenate([np.zeros(0, np.int32), *[p for p, _ in found]]),
                   np.concatenate([np.zeros(0, np.float32), *[v for _, v in found]]).astype(np.float64))

    def only(self, keep: np.ndarray) -> Sparse:
        some = keep[self.place]
        return Sparse(self.rows, self.row[some], self.place[some], self.value[some])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.place] * self.value, self.rows)

    def back(self, errors: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.place, errors[self.row] * self.value, size)


@dataclass
class Machine:
    """Weights of a factorization machine; ``active`` marks the places that have any."""

    bias: float
    weights: np.ndarray            # one per place
    factors: np.ndarray            # FACTORS per place
    active: np.ndarray

    def raw(self, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the summed factors of each row."""
        v = self.factors[x.place] * x.value[:, None]
        sums = np.stack([np.bincount(x.row, v[:, k], x.rows) for k in range(v.shape[1])], axis=1)
        squares = np.bincount(x.row, (v * v).sum(axis=1), x.rows)
        return self.bias + x.times(self.weights) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def scores(self, texts: list) -> np.ndarray:
        """Probabilities of being toxic."""
        return sigmoid(self.raw(Sparse.of([terms(t, self.active) for t in texts]))[0])


def _marginal(x: Sparse, y: np.ndarray, bias: float, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear logistic model under a lasso penalty, by accelerated proximal steps."""
    heavy = np.bincount(x.place, x.value ** 2, size)
    reach = np.bincount(x.row, np.ones(len(x.row)), x.rows)
    # a step per term by how much it weighs keeps the common terms from slowing the rare ones
    step = 4.0 * len(y) / (np.maximum(heavy, 1.0) * max(1.0, reach.mean()) ** 0.5)
    limit = LASSO / len(y) ** 0.5
    w, ahead = np.zeros(size), np.zeros(size)
    for k in range(MARGINAL_STEPS):
        wrong = sigmoid(bias + x.times(ahead)) - y
        moved = ahead - step * 0.25 * x.back(wrong, size) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * 0.25 * limit, 0)
        ahead, w = new + 0.5 * k / (k + 3) * (new - w), new
        bias -= wrong.mean()
    return w, bias


def _partners(x: Sparse, wrong: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
    """The chosen terms, and terms whose meeting with one goes with errors beyond chance.

    Such a meeting must also explain as much error as the lasso asks of a term of its own.
    """
    found = []
    least = LASSO * len(wrong) ** 0.5          # the summed error that the lasso asks of a term
    for term in chosen:
        has = np.zeros(x.rows, bool)
        has[x.row[x.place == term]] = True
        if has.sum() < LEAST_DOCS:
            continue
        some = has[x.row]
        place, off = x.place[some], wrong[x.row[some]]
        met, spread = np.bincount(place, minlength=size), np.bincount(place, off * off, size)
        # the error that all rows of the term share is the term's own
        pull = np.bincount(place, off, size) - met * wrong[has].mean()
        found.append(np.flatnonzero((met >= LEAST_DOCS) & (np.abs(pull) > np.maximum(least, PARTNER_SIGMAS * np.sqrt(spread)))))
    return np.unique(np.concatenate([chosen, *found]))


def train(found: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 3) -> Machine:
    """Choose terms by a lasso and by their errors in pairs, then fit the machine on them.

    Without both classes, or without a term that tells, only the prior is learnt.
    """
    size = 1 << BITS
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    machine = Machine(bias, np.zeros(size), np.zeros((size, FACTORS)), np.zeros(size, bool))
    if len(set(y.tolist())) < 2:
        return machine
    x = Sparse.of(found)
    x = x.only(np.bincount(x.place, minlength=size) >= LEAST_DOCS)
    linear, bias = _marginal(x, y, bias, size)
    chosen = np.flatnonzero(linear)
    if not len(chosen):
        return machine
    chosen = _partners(x, sigmoid(bias + x.times(linear)) - y, chosen, size)
    machine.active[chosen] = True
    x = x.only(machine.active)
    machine.bias, machine.weights[chosen] = bias, linear[chosen]
    machine.factors[chosen] = np.random.default_rng(seed).normal(0, 0.1, (len(chosen), FACTORS))
    spot = np.searchsorted(chosen, x.place)
    seen_w, seen_v, seen_b = np.full(len(chosen), 1e-8), np.full((len(chosen), FACTORS), 1e-8), 1e-8
    for _ in range(STEPS):
        raw, sums = machine.raw(x)
        off = (sigmoid(raw) - y) / len(y)
        slope = np.bincount(spot, off[x.row] * x.value, len(chosen)) + PENALTY * machine.weights[chosen]
        v = machine.factors[chosen]
        pull = (off[x.row] * x.value)[:, None] * (sums[x.row] - v[spot] * x.value[:, None])
        steep = np.stack([np.bincount(spot, pull[:, k], len(chosen)) for k in range(FACTORS)], axis=1)
        steep += PAIR_PENALTY * v
        seen_b, seen_w, seen_v = seen_b + off.sum() ** 2, seen_w + slope ** 2, seen_v + steep ** 2
        machine.bias -= RATE * off.sum() / seen_b ** 0.5
        machine.weights[chosen] -= RATE * slope / np.sqrt(seen_w)
        machine.factors[chosen] = v - 0.2 * RATE * steep / np.sqrt(seen_v)
    return machine


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine from ``labels`` (doc_id, toxic 0/1; nulls are left out); never from held-out rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def compute(batch: pa.RecordBatch) -> list:
        found = [terms(t) for t in batch.column(1).to_pylist()]
        return [[p.tobytes() for p, _ in found], [v.tobytes() for _, v in found]]

    rows = texts.join(sampled(known, "doc_id", SAMPLE), "doc_id")
    got = extend(rows, "places binary, shares binary", compute, keep=["doc_id", "toxic"]).collect()
    got.sort(key=lambda r: (r["doc_id"], r["places"]))
    return train([(np.frombuffer(r["places"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in got],
                 np.array([r["toxic"] for r in got], float))


def with_toxicity(docs: DataFrame, machine: Machine, into: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column: score (0 to 1, higher: rather toxic), predicted (1 from ``PREDICT_AT``).

    Null and empty texts have no terms and get the bias alone.  Only the text is looked at;
    other columns are passed on, and repeated rows get equal scores.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    place = docs.columns.index("text")
    typed = docs.withColumn("text", F.col("text").cast("string"))
    mark = fresh(docs, "marks")

    def compute(batch: pa.RecordBatch) -> list:
        out: list[float] = []
        for at in range(0, batch.num_rows, 256):
            out += sent.value.scores(batch.column(place).slice(at, 256).to_pylist()).tolist()
        return [[{"score": s, "predicted": int(s >= PREDICT_AT)} for s in out]]

    kept = docs.columns if keep is None else keep
    return extend(typed, f"`{mark}` struct<score: double, predicted: int>", compute, keep=kept).withColumnRenamed(mark, into)
