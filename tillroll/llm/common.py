"""Helpers of the text operators: hashed words, added columns, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A space or one of tab, line feed, vertical tab, form feed, carriage return ends a word.
SPACES = b" \t\n\x0b\x0c\r"
CHUNK = 1 << 20
_RANDOM = np.random.default_rng(20240131)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_GAP = np.zeros(256, bool)
_GAP[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: each input bit reaches all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        n = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def _hash_words(data: bytes, prefixes: tuple[int, ...]) -> list[np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    edge = np.empty(len(raw) + 2, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = _GAP[raw]
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = turns[::2], turns[1::2]
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    out = [mix((sums[ends] - sums[starts]) * down[starts])]
    for size in prefixes:
        longer = starts[ends - starts > size]
        out.append(mix((sums[longer + size] - sums[longer]) * down[longer] + np.uint64(size)))
    return out


def _pieces(data: bytes):
    """A long text in pieces that end between words, so memory does not follow its length."""
    at = 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 ``data``, in order; the same on every machine."""
    if len(data) <= CHUNK:
        return _hash_words(data, ())[0]
    return np.concatenate([_hash_words(x, ())[0] for x in _pieces(data)])


def word_and_prefix_hashes(data: bytes, prefixes: tuple[int, ...]) -> tuple[int, np.ndarray]:
    """The number of words, and the hashes of all words and of the longer words' first bytes."""
    found = [_hash_words(x, prefixes) for x in _pieces(data)]
    if not found:
        return 0, np.zeros(0, np.uint64)
    return sum(len(f[0]) for f in found), np.concatenate([x for f in found for x in f])


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words make one run."""
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(_BASE) + words[k : len(words) - width + 1 + k])
    return np.unique(total)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the run of ``width`` words that starts at each word; empty for a shorter text."""
    if len(words) < width:
        return words[:0]
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(_BASE) + words[k : len(words) - width + 1 + k])
    return total


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any spelling of case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def extend(
    df: DataFrame, added: str, compute: Callable[[pa.RecordBatch], list], keep: list[str] | None = None
) -> DataFrame:
    """``df`` with columns that ``compute`` makes from each Arrow batch.

    ``added`` is a DDL list of the new columns; ``keep`` names the input columns that stay
    (all by default).  Rows stay in their partition and order; nothing is shuffled.
    """
    new = T.StructType.fromDDL(added)
    names = df.columns if keep is None else keep
    schema = T.StructType([df.schema[n] for n in names] + new.fields)
    places = [df.columns.index(n) for n in names]
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)
                    for c, f in zip(compute(batch), list(out)[len(places):], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(p) for p in places] + made, names=out.names)

    return df.mapInArrow(run, schema)


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def sampled(df: DataFrame, key: str, rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``: all rows if there are no more.

    The share is ``rows`` over the count, so the sample is bounded whatever the input, needs
    no sort and no shuffle, and is the same after a task is run again.  Null keys are left out.
    """
    known = df.filter(F.col(key).isNotNull())
    total = known.count()
    if total <= rows:
        return known
    share = int(rows / total * (1 << 40))
    return known.filter(F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 24) < share)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the least by its other columns, in their order; repeated keys are combined in the tasks."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_least")).select(key, "_least.*")


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def text_bytes(value: pa.Scalar) -> bytes:
    """UTF-8 bytes of an Arrow string scalar; a null is empty."""
    return value.as_buffer().to_pybytes() if value.is_valid else b""
