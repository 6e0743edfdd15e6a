"""Document quality by co-training: a text view and a page-metadata view teach each other.

The text view sees what is written: hashed byte trigrams and how words repeat.  The metadata
view sees the page from outside: source, language, length, line layout, shares of kinds of
characters.  Both are logistic models.  In each round either view labels the unlabelled documents
it is surest of, and the *other* view learns them.  Finally each view is calibrated on labelled
documents that it has not learnt from, and a third logistic model joins the calibrated views.

Only the labelled rows are a sample: about ``LABELLED`` of them (all, if there are fewer),
chosen by a hash of doc_id, one row each.  All documents outside the sample take part in the exchange.
Their views are staged once, as halves of 16 bits, by the tasks that read them: the sampled ids are
few and are sent to all of them, so nothing is shuffled.  In each round one pass counts their scores in ``BINS`` bins, which give
the thresholds of the surest ones, and ``REFINE`` passes sum up the slopes of the loss over the
pseudo-labels.  Tasks add up their sums in ``BRANCHES`` heaps, so what reaches the driver does not grow with
them.  The driver corrects the fit on the labelled rows by these sums, so it holds no unlabelled document.  Every document is then scored in one pass without a shuffle.  The model is
about 10 kB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import extend, fresh, one_per_key, sampled, sigmoid
from tillroll.session import materialize, scratch_scope

LABELLED = 4_000
ROUNDS, SHARE = 4, 0.1         # per round each view hands over the surest tenth of the unlabelled documents
REFINE, STEPS = 3, 40          # per round: passes over the pseudo-labels, and driver's steps after each
PSEUDO = 0.5                   # weight of a pseudo-label; more than LABELLED documents share what so many have
BRANCHES = 64                  # heaps in which the sums of tasks are added up before the driver gets them
BINS, FAR = 4_096, 32.0        # of raw scores from -FAR to FAR; a threshold is the edge of a bin
SURE = 0.95                    # and only where it is at least this sure
KEEP_AT = 0.5                  # of the probability of good quality
BUCKETS = 512                  # hashed trigrams
SOURCES = 64                   # hashed source names
LANGUAGES = 16

INPUTS = ("text", "lang", "source")
_KINDS = np.zeros((256, 6), np.float64)        # lower, upper, digit, space, other ASCII, beyond ASCII
for _c in range(256):
    _KINDS[_c, 5 if _c > 127 else 0 if 97 <= _c < 123 else 1 if 65 <= _c < 91 else
           2 if 48 <= _c < 58 else 3 if _c in b" \t\n\x0b\x0c\r" else 4] = 1


def text_view(data: bytes) -> np.ndarray:
    """Square roots of the shares of hashed trigrams, then four figures of repetition."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = np.zeros(BUCKETS + 4)
    if len(raw) >= 3:
        code = (raw[:-2] * np.uint32(65536) + raw[1:-1] * np.uint32(256) + raw[2:]) * np.uint32(2654435761)
        out[:BUCKETS] = np.sqrt(np.bincount(code >> np.uint32(23), minlength=BUCKETS) / len(code))
    words = data.lower().split()
    if words:
        pairs = list(zip(words, words[1:], strict=False))
        out[BUCKETS:] = (
            sum(a == b for a, b in pairs) / len(words),
            1 - len(set(pairs)) / max(1, len(pairs)),
            len(set(words)) / len(words) ** 0.9,
            np.log1p(len(words)) / 10)
    return out


def _slot(name: str | None, size: int) -> int:
    """A place for a name by its bytes; a null has the place 0."""
    if name is None:
        return 0
    h = 2166136261
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return 1 + h % (size - 1)


def metadata_view(data: bytes, lang: str | None, source: str | None) -> np.ndarray:
    """One-hot language and source, length, line layout and shares of kinds of characters."""
    out = np.zeros(LANGUAGES + SOURCES + 12)
    out[_slot(lang, LANGUAGES)] = 1
    out[LANGUAGES + _slot(source, SOURCES)] = 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _KINDS / max(1, len(data))
    sizes = np.array([len(x) for x in lines] or [0])
    out[LANGUAGES + SOURCES :] = [
        *(np.sqrt(kinds) * 3), np.log1p(len(data)) / 10, np.log1p(len(lines)) / 5,
        np.log1p(sizes.mean()) / 5, np.log1p(sizes.std()) / 5,
        1 - len(set(lines)) / max(1, len(lines)), float(not lines)]
    return out


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in INPUTS)
    data = [(t or "").encode("utf-8", "replace") for t in text]
    wide, flat = np.zeros((len(data), BUCKETS + 4)), np.zeros((len(data), LANGUAGES + SOURCES + 12))
    for k, d in enumerate(data):
        wide[k], flat[k] = text_view(d), metadata_view(d, lang[k], source[k])
    # as staged, so a document has the same views in every pass
    return wide.astype(np.float16).astype(np.float64), flat.astype(np.float16).astype(np.float64)


@dataclass
class Linear:
    """A logistic model, fitted by accelerated gradient steps on all rows.

    ``fit`` starts anew, or from ``start``; ``lean`` is added to the slope, and ``brake`` is a
    further curvature of each weight around the start.
    """

    penalty: float
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fit(self, x: np.ndarray, y: np.ndarray, sure: np.ndarray, steps: int = 100,
            start: np.ndarray | None = None, lean: np.ndarray | None = None, brake: np.ndarray | None = None) -> Linear:
        x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
        y, sure = y.astype(np.float32), sure.astype(np.float32)
        # the greatest curvature of the loss bounds the step
        v = np.ones(x.shape[1], np.float32)
        for _ in range(8):
            v = x.T @ (sure * (x @ v))
            v /= max(np.linalg.norm(v), 1e-12)
        total = np.float32(max(sure.sum(), 1e-9))
        first, lean, brake = (np.zeros(x.shape[1], np.float32) if a is None else a.astype(np.float32)
                              for a in (start, lean, brake))
        step = np.float32(1 / (0.25 * float(v @ (x.T @ (sure * (x @ v)))) / total + self.penalty + float(brake.max())))
        w, ahead = first, first
        for k in range(steps):
            slope = x.T @ (sure * (sigmoid(x @ ahead) - y) / total) + np.float32(self.penalty) * ahead
            slope += lean + brake * (ahead - first)
            new = ahead - step * slope
            ahead = new + np.float32(k / (k + 3)) * (new - w)
            w = new
        self.weights = w.astype(np.float64)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]


@dataclass
class Model:
    """The two views and the joint model of their calibrated odds; ``prior`` where nothing could be learnt."""

    prior: float
    text: Linear | None = None
    meta: Linear | None = None
    scales: tuple = ()
    joint: Linear | None = None
    handed: list = field(default_factory=list)      # pseudo-labels handed over per round, for a report

    def scores(self, wide: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: text view, metadata view, both."""
        if self.joint is None:
            same = np.full(len(wide), self.prior)
            return same, same, same
        odds = np.stack([s.raw(m.raw(x)[:, None]) for m, x, s in
                         ((self.text, wide, self.scales[0]), (self.meta, flat, self.scales[1]))], axis=1)
        return sigmoid(odds[:, 0]), sigmoid(odds[:, 1]), sigmoid(self.joint.raw(odds))


def _bins(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + FAR) * (BINS / (2 * FAR))), 0, BINS - 1).astype(int)


def told(views: tuple, history: list) -> list[np.ndarray]:
    """Labels that each view has given, -1 for none: those of the first round in which it was sure.

    ``history`` has, per view, (weights, last bin of class 0, first bin of class 1) of its rounds.
    """
    out = []
    for x, rounds in zip(views, history, strict=True):
        label = np.full(len(x), -1)
        for weights, low, high in rounds:
            bins = _bins(x @ weights[:-1] + weights[-1])
            free = label < 0
            label[free & (bins >= high)] = 1
            label[free & (bins <= low)] = 0
        out.append(label)
    return out


def score_counts(views: tuple, history: list, weights: list) -> np.ndarray:
    """Per view the documents that it has not labelled yet, counted by the bin of their score."""
    return np.stack([np.bincount(_bins(x @ w[:-1] + w[-1])[label < 0], minlength=BINS)
                     for x, w, label in zip(views, weights, told(views, history), strict=True)])


def slopes(views: tuple, history: list, weights: list) -> np.ndarray:
    """Sums over the labels that each view has from the other: loss, rows, slopes, own curvatures."""
    out = []
    for x, w, label in zip(views, weights, told(views, history)[::-1], strict=True):
        x, y = np.hstack([x[label >= 0], np.ones(((label >= 0).sum(), 1))]), label[label >= 0]
        raw = x @ w
        p = sigmoid(raw)
        out += [[_loss(raw, y).sum(), len(y)], x.T @ (p - y), (x * x).T @ (p * (1 - p))]
    return np.concatenate(out)


def _loss(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, raw) - y * raw


def thresholds(counts: np.ndarray, positive: float, wanted: int) -> tuple[int, int]:
    """Last bin of class 0 and first bin of class 1: the surest ``wanted``, by the labels' shares of the classes.

    The bin in which the number is reached is taken whole, and no bin below ``SURE`` is.
    """
    sure = int(_bins(np.array([np.log(SURE / (1 - SURE))]))[0]) + 1
    above = np.cumsum(counts[::-1])
    high = BINS - 1 - int(np.searchsorted(above, max(1, round(wanted * positive))))
    low = int(np.searchsorted(np.cumsum(counts), max(1, round(wanted * (1 - positive)))))
    return min(low, BINS - 1 - sure), max(high, sure)


Total = Callable[[Callable, list, list], np.ndarray]   # sum of a function of (views, history, weights) over all documents


def cotrain(wide: np.ndarray, flat: np.ndarray, y: np.ndarray, pool: int, total: Total) -> Model:
    """Co-train on labelled rows (every fourth is kept for calibration) and ``pool`` unlabelled documents."""
    prior = float(y.mean()) if len(y) else 0.5
    held = np.arange(len(y)) % 4 == 3
    if min(len(set(y[held].tolist())), len(set(y[~held].tolist()))) < 2:
        return Model(prior)
    known = [x[~held] for x in (wide, flat)]
    given, ones = y[~held], np.ones((~held).sum())
    views = [Linear(1e-5).fit(x, given, ones) for x in known]
    model = Model(prior)
    history: list = [[], []]
    weight = PSEUDO * min(1, LABELLED / max(1, pool))
    for _ in range(ROUNDS if pool else 0):
        weights = [v.weights for v in views]
        counts = total(score_counts, history, weights).reshape(2, BINS)
        cuts = [thresholds(c, prior, round(SHARE * pool)) for c in counts]
        for k in (0, 1):
            history[k].append((weights[k], *cuts[k]))
        model.handed.append([int(c[: low + 1].sum() + c[high:].sum()) for c, (low, high) in zip(counts, cuts, strict=True)])
        _refine(views, known, given, history, weight, total)
    model.text, model.meta = views
    raws = [m.raw(x[held])[:, None] for m, x in ((model.text, wide), (model.meta, flat))]
    ones = np.ones(held.sum())
    model.scales = tuple(Linear(1e-4).fit(r, y[held], ones, 400) for r in raws)
    odds = np.stack([s.raw(r) for s, r in zip(model.scales, raws, strict=True)], axis=1)
    model.joint = Linear(1e-3).fit(odds, y[held], ones, 400)
    return model


def _refine(views: list, known: list, given: np.ndarray, history: list, weight: float, total: Total) -> None:
    """Fit both views to the labelled rows and all pseudo-labels.

    Each pass sums up the slopes of the pseudo-labels' loss.  The driver then descends on the
    labelled rows' loss, leaned so that its slope at the start is that of the whole loss, with the
    pseudo-labels' curvatures as a brake.  A step that made the whole loss worse is halved.
    """
    best: list = [(np.inf, v.weights) for v in views]
    ones = np.ones(len(given))
    for turn in range(REFINE + 1):
        sums, at = total(slopes, history, [v.weights for v in views]), 0
        for k, (view, x) in enumerate(zip(views, known, strict=True)):
            n = len(view.weights)
            (loss, rows), slope, curve = sums[at : at + 2], sums[at + 2 : at + 2 + n], sums[at + 2 + n : at + 2 + 2 * n]
            at += 2 + 2 * n
            raw = view.raw(x)
            own = np.append(x.T @ (sigmoid(raw) - given), (sigmoid(raw) - given).sum())
            size = len(given) + weight * rows
            whole = (_loss(raw, given).sum() + weight * loss) / size + view.penalty / 2 * (view.weights @ view.weights)
            if whole > best[k][0]:
                view.weights = best[k][1] if turn == REFINE else (view.weights + best[k][1]) / 2
                continue
            best[k] = whole, view.weights
            if turn < REFINE:
                lean = (own + weight * slope) / size - own / len(given)
                view.fit(x, given, ones, STEPS, view.weights, lean, weight * curve / size)


def train(wide: np.ndarray, flat: np.ndarray, y: np.ndarray, pool_wide: np.ndarray, pool_flat: np.ndarray) -> Model:
    """``cotrain`` on arrays."""
    return cotrain(wide, flat, y, len(pool_wide), lambda f, history, weights: f((pool_wide, pool_flat), history, weights))


def _staged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the column ``views``: both views of a document, as halves of 16 bits."""
    def compute(batch: pa.RecordBatch) -> list:
        out = []
        for at in range(0, batch.num_rows, 512):
            rows = np.hstack(_views(batch.slice(at, 512))).astype(np.float16)
            out += [r.tobytes() for r in rows]
        return [out]

    return extend(docs, "views binary", compute, keep=keep)


def _read(found: list) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(found), np.float16).reshape(-1, BUCKETS + 4 + LANGUAGES + SOURCES + 12)
    return rows[:, : BUCKETS + 4].astype(np.float64), rows[:, BUCKETS + 4 :].astype(np.float64)


def _total(staged: DataFrame) -> Total:
    """Sums over all staged documents: by task, then by heap of tasks, then on the driver; always in one order."""
    def run(f: Callable, history: list, weights: list) -> np.ndarray:
        sent = staged.sparkSession.sparkContext.broadcast((history, weights))

        def compute(batches):
            sums = None
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    found = f(_read(batch.column(0).slice(at, 1024).to_pylist()), *sent.value).ravel().astype(np.float64)
                    sums = found if sums is None else sums + found
            if sums is not None:
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task % BRANCHES], pa.int32()), pa.array([task], pa.int32()),
                     pa.array([sums.tobytes()], pa.binary())], names=["heap", "task", "sums"])

        def add_up(batches):
            heaps: dict[int, np.ndarray] = {}
            for batch in batches:
                for heap, value in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    found = np.frombuffer(value, np.float64)
                    heaps[heap] = heaps[heap] + found if heap in heaps else found
            for heap, sums in heaps.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([heap], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["heap", "sums"])

        tasks = staged.select("views").mapInArrow(compute, "heap int, task int, sums binary")
        heaps = tasks.repartition("heap").sortWithinPartitions("heap", "task").mapInArrow(add_up, "heap int, sums binary")
        out = f(_read([]), history, weights).ravel().astype(np.float64)
        for r in sorted(heaps.collect(), key=lambda r: r["heap"]):
            out += np.frombuffer(r["sums"], np.float64)
        sent.destroy()
        return out

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``labels`` (doc_id, quality 0/1; nulls are left out) and all documents outside the sample.

    Of rows that repeat a sampled doc_id the least is fitted on; the others are left out of the exchange too.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in INPUTS])
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    with scratch_scope(docs.sparkSession):
        chosen = materialize(sampled(known, "doc_id", LABELLED).coalesce(1), "sample")     # about LABELLED ids
        rows = one_per_key(base.join(F.broadcast(chosen), "doc_id"), "doc_id")
        rows = _staged(rows, ["doc_id", "quality"]).collect()
        rows.sort(key=lambda r: r["doc_id"])
        wide, flat = _read([r["views"] for r in rows])
        y = np.array([r["quality"] for r in rows], int)
        rest = base.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
        staged = materialize(_staged(rest, []), "views")
        return cotrain(wide, flat, y, staged.count(), _total(staged))


def with_quality(docs: DataFrame, model: Model, into: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column: text_score, metadata_score, score (0 to 1), kept.

    Null and empty texts, languages and sources are ordinary inputs with a place of their own.
    Without usable labels every score is the share of good ones (0.5 without any).  Repeated
    rows get equal scores.  Other columns are passed on.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    typed = docs.withColumns({c: F.col(c).cast("string") for c in INPUTS})
    mark = fresh(docs, "marks")

    def compute(batch: pa.RecordBatch) -> list:
        rows = []
        for at in range(0, batch.num_rows, 512):
            scored = sent.value.scores(*_views(batch.slice(at, 512)))
            rows += [{"text_score": float(t), "metadata_score": float(m), "score": float(b), "kept": bool(b >= KEEP_AT)}
                     for t, m, b in zip(*scored, strict=True)]
        return [rows]

    kind = "struct<text_score: double, metadata_score: double, score: double, kept: boolean>"
    kept = docs.columns if keep is None else keep
    return extend(typed, f"`{mark}` {kind}", compute, keep=kept).withColumnRenamed(mark, into)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the joint model keeps; the same columns."""
    mark = fresh(docs, "quality")
    return with_quality(docs, fit(docs, labels), mark).filter(F.col(mark)["kept"]).select(*docs.columns)
