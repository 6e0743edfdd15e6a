"""Tokens of two tokenizers aligned by the bytes they cover, and how often their ids meet.

Both tokenizers cover the same bytes.  Tokens whose byte ranges overlap hang together; the
components are the groups between byte offsets where tokens of both end.  They are found by
pointer jumping: every token points to the farthest-right token it overlaps, and ``next =
next[next]`` over whole arrays doubles the jumps until each token points to the terminal token of its
component, which is the group's label.

A text is aligned in units: runs that end at a single space between two other characters.
Neither vocabulary has a token that goes on after such a space (this is looked up when the
vocabularies are loaded; else a text is one unit), so a unit's tokens are those it has within the text.
Units repeat as words do; a worker keeps those it has aligned, up to a stated size, and beyond it those
that have come again.  New units are encoded in runs joined by single spaces, since a call for each costs more.

Links are counted in Spark: distinct id pairs per document, then documents per pair with
map-side combining.  The counts have at most |A| x |B| rows and come back to the documents by a
join that is a broadcast only while they are small.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import extend
from tillroll.session import materialize

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
UNIT_END = re.compile(r"(?<=\S) (?=\S)")
PIECE = 1 << 19               # characters that are aligned at a time
CACHED_UNITS, CACHED_CHARS = 250_000, 4 << 20
RUN = 64                      # units that are encoded as one text


def jump(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label (its component's terminal token) of each A token and each B token.

    Tokens are given by their end offsets; both sequences cover the same bytes from 0, no token is
    empty.  Nodes are A tokens, then B tokens.  An A token points to the B token over its last byte.
    A B token points to the A token over its last byte if that ends farther right, else to itself:
    then both end there and it is terminal.
    """
    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)
    to_a = np.searchsorted(ends_a, ends_b)
    own = np.arange(len(ends_b)) + n
    after = np.concatenate([to_b + n, np.where(ends_a[to_a] > ends_b, to_a, own)])
    while True:
        farther = after[after]
        if np.array_equal(farther, after):
            return after[:n], after[n:]
        after = farther


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (A, B) of all overlapping tokens: one pair per stretch between neighbouring ends of either."""
    cuts = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")      # two sorted runs are merged
    cuts = cuts[np.flatnonzero(np.diff(cuts, prepend=-1))]
    return np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary: visible Latin-1 as itself, the rest from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Tokenizer A (byte-level) and B (pieces), and the bytes that each id stands for."""

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        byte = _byte_alphabet()
        found = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(found.values()) + 1)
        for token, i in found.items():
            known = all(c in byte for c in token)
            self.bytes_a[i] = bytes(byte[c] for c in token) if known else token.encode()
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        crossing = re.compile(rb"[^\s] ")
        vocabulary = [b for b in (*self.bytes_a, *self.bytes_b) if b" " in b]
        # NBSP is white space to the pattern, and a text is not cut next to white space
        self.cuttable = not any(crossing.search(b.replace(b"\xc2\xa0", b" ")) for b in vocabulary)

    def encode(self, units: list[str]) -> tuple[list, list]:
        """Ids of each unit with a space in front; B adds that space itself."""
        a = self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(units, num_threads=1)


def vocabulary_sizes(file_a: str, file_b: str) -> tuple[int, int]:
    found = loaded(file_a, file_b).tokenizers
    return len(found.bytes_a), len(found.bytes_b)


class _Side:
    """Lengths of one tokenizer's ids, and their decimals with what follows inside and at the end of a group."""

    def __init__(self, known: list[bytes], last: str):
        self.known = known
        self.sizes = np.array([len(b) for b in known], np.int64)
        self.empty = {i for i, b in enumerate(known) if not b}
        self.inside = np.array([f"{i}," for i in range(len(known))], object)
        self.last = np.array([f"{i}{last}" for i in range(len(known))], object)
        self.digits = np.array([len(t) for t in self.last], np.int64)

    def holds(self, ids: list[int], raw: bytes) -> bool:
        """Do the tokens give back these bytes, none of them empty?"""
        return b"".join(map(self.known.__getitem__, ids)) == raw and self.empty.isdisjoint(ids)


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, sum(map(len, ids)))


class _Growing:
    """An array that is appended to in place, twice as large whenever it is full."""

    def __init__(self, *shape: int):
        self.room, self.n = np.zeros((1024, *shape), np.int64), 0

    def append(self, rows: np.ndarray) -> None:
        need = self.n + len(rows)
        if need > len(self.room):
            larger = np.zeros((max(need, 2 * len(self.room)), *self.room.shape[1:]), np.int64)
            larger[: self.n] = self.room[: self.n]
            self.room = larger
        self.room[self.n : need] = rows
        self.n = need


class Aligner:
    """Aligned units of a worker, and the alignment of whole texts from them."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.width = len(tokenizers.bytes_b)
        self.side_a, self.side_b = _Side(tokenizers.bytes_a, "|"), _Side(tokenizers.bytes_b, ";")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.spelled: list[str] = []                        # "a1,a2|b1;a3|b2;" of each unit
        self.sizes = _Growing(6)                            # tokens A, B, groups, does it hold, first pair, pairs
        self.pairs = _Growing()
        self.uses = _Growing()                              # texts that held the unit, halved by ``_room``

    def _encoded(self, units: list[str], raw: list[bytes]) -> tuple[list, list, np.ndarray]:
        """Token ids of A and of B, a list for each of ``units`` or of their runs, and which units hold.

        Units are cut where the vocabularies allow it, so those of a run have the tokens that they have
        alone.  A run whose bytes do not come back is encoded again unit by unit.
        """
        found_a, found_b, holds = [], [], []
        runs = [(k, min(k + RUN, len(units))) for k in range(0, len(units), RUN)]
        joined = [" ".join(units[x:y]) for x, y in runs]
        for (x, y), a, b in zip(runs, *self.tokenizers.encode(joined), strict=True):
            whole = b"".join(raw[x:y])
            if self.side_a.holds(a, whole) and self.side_b.holds(b, whole):
                found_a.append(a)
                found_b.append(b)
                holds += [True] * (y - x)
            else:
                for part, kept in zip((found_a, found_b, holds), self._alone(units[x:y], raw[x:y]), strict=True):
                    part += kept
        return found_a, found_b, holds

    def _alone(self, units: list[str], raw: list[bytes]) -> tuple[list, list, list[bool]]:
        """The same unit by unit; one that does not hold has no ids."""
        found = list(zip(*self.tokenizers.encode(units), raw, strict=True)) if units else []
        holds = [self.side_a.holds(a, u) and self.side_b.holds(b, u) for a, b, u in found]
        return ([f[0] for f, h in zip(found, holds, strict=True) if h],
                [f[1] for f, h in zip(found, holds, strict=True) if h], holds)

    def add(self, units: Iterable[str]) -> None:
        """Align the units that are not known yet, all at once: their bytes stand one behind the other."""
        new = [u for u in dict.fromkeys(units) if u not in self.index]
        if not new:
            return
        # white space at an end, as only the ends of a text have it, would make another cut of a run
        edged = [u for u in new if not u or u[0].isspace() or u[-1].isspace()]
        if edged or not self.tokenizers.cuttable:
            aside = set(edged) if self.tokenizers.cuttable else set(new)
            new = [u for u in new if u not in aside] + [u for u in new if u in aside]
            split = len(new) - len(aside)
        else:
            split = len(new)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.chars += sum(map(len, new))
        raw = [b" " + u.encode() for u in new]
        ids_a, ids_b, holds = self._encoded(new[:split], raw[:split])
        for part, more in zip((ids_a, ids_b, holds), self._alone(new[split:], raw[split:]), strict=True):
            part += more
        flat_a, flat_b, holds = _flat(ids_a), _flat(ids_b), np.array(holds, bool)
        ends_a, ends_b = np.cumsum(self.side_a.sizes[flat_a]), np.cumsum(self.side_b.sizes[flat_b])
        of_a, of_b = jump(ends_a, ends_b)
        turns = np.diff(of_b, prepend=-1) != 0
        labels = of_b[turns]                                # terminal tokens, in the order of the text
        cut_a, cut_b = np.searchsorted(of_a, labels, side="right"), np.searchsorted(of_b, labels, side="right")
        x, y = overlaps(ends_a, ends_b)

        # a group's A tokens, then its B tokens
        group_a, group_b = np.repeat(np.arange(len(labels)), np.diff(cut_a, prepend=0)), np.cumsum(turns) - 1
        told = np.empty(len(flat_a) + len(flat_b), object)
        letters = np.zeros(len(told), np.int64)
        first_b = np.concatenate([[0], cut_b])
        for side, flat, at, cut in ((self.side_a, flat_a, np.arange(len(flat_a)) + first_b[group_a], cut_a),
                                    (self.side_b, flat_b, np.arange(len(flat_b)) + cut_a[group_b], cut_b)):
            told[at] = side.inside[flat]
            told[at[cut - 1]] = side.last[flat[cut - 1]]
            letters[at] = side.digits[flat]

        # each unit ends with a token of either, a group and a link; one that does not hold has no bytes here
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) * holds)
        to_a, to_b = np.searchsorted(ends_a, ends, side="right"), np.searchsorted(ends_b, ends, side="right")
        sizes = np.zeros((len(new), 6), np.int64)
        sizes[:, 0], sizes[:, 1] = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        sizes[:, 2] = np.diff(np.searchsorted(cut_a, to_a, side="right"), prepend=0)
        sizes[:, 3] = holds
        links = np.searchsorted(x, to_a - 1, side="right")
        sizes[:, 5] = np.diff(links, prepend=0)
        sizes[:, 4] = self.pairs.n + links - sizes[:, 5]
        text, at = "".join(told.tolist()), 0
        for end in np.concatenate([[0], np.cumsum(letters)])[to_a + to_b].tolist():
            self.spelled.append(text[at:end])
            at = end
        self.sizes.append(sizes)
        self.uses.append(np.zeros(len(new), np.int64))
        self.pairs.append(flat_a[x] * self.width + flat_b[y])

    def _pairs(self, sizes: np.ndarray) -> np.ndarray:
        """The pairs of the given units, one unit's behind the other's."""
        first, lengths = sizes[:, 4], sizes[:, 5]
        at = np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        return self.pairs.room[at]

    def _linked(self, sizes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of the given units, and how often each stands there."""
        lengths = sizes[:, 5]
        pairs = self._pairs(sizes)
        order = np.argsort(pairs)
        pairs, times = pairs[order], np.repeat(times, lengths)[order]
        starts = np.flatnonzero(np.diff(pairs, prepend=-1))
        return pairs[starts], np.add.reduceat(times, starts)

    def _units(self, text: str) -> Iterator[list[str]]:
        """The units of a text; a long one in pieces that end where a unit does, so memory does not follow its length."""
        if not self.tokenizers.cuttable:
            yield [text]
            return
        at = 0
        while at < len(text):
            found = UNIT_END.search(text, at + PIECE) if at + PIECE < len(text) else None
            end = found.start() if found else len(text)
            yield UNIT_END.split(text[at:end] if at or found else text)
            at = end + 1

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text: tokens A and B, groups, digest of the groups, distinct id pairs, how often each."""
        out, short, chars = [], [], 0
        for text in texts:
            if text and len(text) > PIECE:
                out += self._short(short)
                short, chars = [], 0
                out.append(self._long(text))
                continue
            short.append(text)
            chars += len(text or "")
            if chars > PIECE:
                out += self._short(short)
                short, chars = [], 0
        return out + self._short(short)

    def _room(self) -> None:
        """Beyond the stated size only units that have come again stay, the most used ones, up to half of it."""
        if len(self.spelled) <= CACHED_UNITS and self.chars <= CACHED_CHARS:
            return
        units, spelled = list(self.index), self.spelled
        lengths, least = np.fromiter(map(len, units), np.int64, len(units)), 2
        kept = np.flatnonzero(self.uses.room[: self.uses.n] >= least)
        while len(kept) > CACHED_UNITS // 2 or lengths[kept].sum() > CACHED_CHARS // 2:
            least *= 2
            kept = kept[self.uses.room[kept] >= least]
        names, chars = [units[k] for k in kept.tolist()], int(lengths[kept].sum())
        sizes, uses = self.sizes.room[kept], self.uses.room[kept]
        pairs = self._pairs(sizes)
        self.forget()
        sizes[:, 4] = np.cumsum(sizes[:, 5]) - sizes[:, 5]
        self.index, self.chars = dict(zip(names, range(len(names)))), chars
        self.spelled = [spelled[k] for k in kept.tolist()]
        self.sizes.append(sizes)
        self.uses.append(uses // 2)
        self.pairs.append(pairs)

    def _short(self, texts: list[str | None]) -> list[tuple]:
        """Texts whose new units are aligned together."""
        self._room()
        units = [next(self._units(t)) if t else [] for t in texts]
        self.add(itertools.chain.from_iterable(units))
        out = []
        for own in units:
            places, (used, sizes, times) = self._found(own)
            if not own or not sizes[:, 3].all():
                out.append(NOTHING)
                continue
            spelled = "".join(map(self.spelled.__getitem__, places))
            counts = times @ sizes[:, :3]
            out.append((*counts.tolist(), hashlib.sha256(spelled[:-1].encode()).hexdigest(),
                        *self._linked(sizes, times)))
        return out

    def _found(self, units: list[str]) -> tuple:
        places = list(map(self.index.__getitem__, units))
        used, times = np.unique(np.asarray(places, np.int64), return_counts=True)
        self.uses.room[used] += 1
        return places, (used, self.sizes.room[used], times)

    def _long(self, text: str) -> tuple:
        """A text piece by piece."""
        total, digest, links, last = np.zeros(3, np.int64), hashlib.sha256(), [], ""
        for units in self._units(text):
            self._room()
            self.add(units)
            places, (used, sizes, times) = self._found(units)
            if not sizes[:, 3].all():
                return NOTHING
            total += times @ sizes[:, :3]
            spelled = last + "".join(map(self.spelled.__getitem__, places))
            digest.update(spelled[:-1].encode())
            last = spelled[-1]
            links.append(self._linked(sizes, times))
        pairs, place = np.unique(np.concatenate([f[0] for f in links]), return_inverse=True)
        times = np.bincount(place, np.concatenate([f[1] for f in links])).astype(np.int64)
        return (*total.tolist(), digest.hexdigest(), pairs, times)


NOTHING = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


@lru_cache(maxsize=1)
def loaded(file_a: str, file_b: str) -> Aligner:
    """The aligner of this process; a worker keeps it from task to task."""
    return Aligner(Tokenizers(file_a, file_b))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()).cast(kind))


def aligned(docs: DataFrame, keep: list[str], folder: str = FOLDER) -> DataFrame:
    """``keep`` and n_a, n_b, n_groups, groups_sha256, pairs (A id x |B| + B id), times per row of ``docs``.

    A is encoded from a space and the text, B from the text, both without special tokens.  Null and
    empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens.
    """
    files = f"{folder}/{BYTE_BPE}", f"{folder}/{PIECE_BPE}"
    many, few = vocabulary_sizes(*files)
    kind = "int" if many * few < 2**31 else "long"

    def compute(batch: pa.RecordBatch) -> list:
        rows = loaded(*files).align(batch.column(batch.num_columns - 1).to_pylist())
        a, b, groups, digests, pairs, times = map(list, zip(*rows)) if rows else ([],) * 6
        arrow = pa.int32() if kind == "int" else pa.int64()
        return [a, b, groups, digests, _lists(pairs, arrow), _lists(times, pa.int32())]

    narrow = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    return extend(narrow, f"n_a long, n_b long, n_groups long, groups_sha256 string, "
                  f"pairs array<{kind}>, times array<int>", compute, keep=keep)


def pair_counts(found: DataFrame, n_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id is in more documents)."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    same = Window.partitionBy(F.expr(f"pair div {n_b}"))     # at most |B| rows
    return counts.withColumn("best", F.col("n") == F.max("n").over(same))


def alignment(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``.

    A pair of ids counts the rows that hold it linked; ``n_best`` are a row's links whose count is the
    highest of their A id, ties included, ``count_sum`` adds up the counts of its links.  A row is a
    document of its own: repeated and null doc_ids count as they stand.  Rows without tokens have zeros and ''.
    Further columns are ignored.
    """
    n_b = vocabulary_sizes(f"{folder}/{BYTE_BPE}", f"{folder}/{PIECE_BPE}")[1]
    rows = docs.select("doc_id", "text")
    own = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    found = materialize(
        aligned(rows, ["doc_id"], folder).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialize(pair_counts(found, n_b), "pair-counts")
    # only numbers travel with a link; what else a row has comes in again at the end
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    times = F.col("times").cast("long")
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(times).alias("n_links"), F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"),
        F.sum(times * F.col("n")).alias("count_sum"))
    told = found.select("row", *own).join(sums, "row", "left").fillna(0, ["n_links", "n_best", "count_sum"])
    return told.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
