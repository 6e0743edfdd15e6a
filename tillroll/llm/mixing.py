"""Interleaving sources to target weights by Pfair scheduling.

The documents of a source, in the order of a hash, are cut into blocks of ``block_bytes``.  A
source of weight w releases its j-th block at floor((j-1) / w), due at ceil(j / w), where w is
the exact share of the given weights, never rounded.  Earliest deadline first over the released
blocks then takes one block per slot, and after any number of slots a source is less than one
block away from its share.  The schedule repeats after as many slots as the weights have as
common denominator: one such period is computed, or less if a source runs out before its end.
So the driver takes one step per slot at most, and the executors get 28 bytes per slot (13 MB
for 30 GB).

When a source has no blocks left, the weights of the others grow in proportion and a new phase
begins; so no document is dropped or repeated, and the bound holds within each phase.

A source may hold a third of all documents: it is cut into ranges of the hash, each range is
ordered by itself, and the bytes before a range come from a small table of range totals.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, utf8_size

BLOCK_BYTES = 1 << 16
RANGE_BYTES = 1 << 23          # bytes of a source that one task orders
PERIOD = 1000                  # of ``units``; the schedule's period follows from the weights
CHUNK = 256                    # blocks whose slots are one row of the table of blocks
BROADCAST_SLOTS = 1 << 21      # up to so many slots that table goes to every executor whole
MAX_SOURCES = 10_000           # sources are a configuration; more are refused


def units(weights: dict, period: int) -> dict:
    """Whole shares that add up to ``period``: at least one each, then by the largest remainder.

    Rounded, so for callers who want a short period; ``phases`` uses ``exact_units``.
    """
    total = sum(weights.values())
    spare = period - len(weights)
    exact = {s: Fraction(w) / Fraction(total) * spare for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    by_rest = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], repr(s)))
    for s in by_rest[: period - sum(out.values())]:
        out[s] += 1
    return out


def exact_units(weights: dict) -> tuple[dict, int]:
    """The least whole numbers in the proportion of the weights, and their sum."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    return {s: e // common for s, e in whole.items()}, sum(whole.values()) // common


def one_period(shares: dict, period: int, blocks: dict | None = None) -> dict:
    """Slots of each source in one period, by earliest deadline first over the released blocks.

    With ``blocks`` it ends early, with the slot that takes the last block of a source.
    """
    release = lambda e, j: (j - 1) * period // e            # noqa: E731
    due = lambda e, j: -(-j * period // e)                  # noqa: E731
    waiting = [(0, repr(s), s, 1) for s in shares]
    ready: list = []
    out: dict = {s: array("q") for s in shares}
    heapq.heapify(waiting)
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, name, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due(shares[s], j), name, s, j))
        deadline, name, s, j = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a block missed its deadline")
        out[s].append(slot)
        if blocks is not None and j == blocks[s]:
            break
        if j < shares[s]:
            heapq.heappush(waiting, (release(shares[s], j + 1), name, s, j + 1))
    return out


def phases(blocks: dict, weights: dict, period: int = PERIOD) -> dict:
    """Per source its phases: (first block, end block, first slot, share, period, slots of one period).

    ``blocks`` counts the blocks of each source.  There are at most as many phases as sources.
    Share over period is the exact weight among the sources left; of a period that does not end
    within the phase only the slots used are listed.  ``period`` is ignored: weights are not rounded.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    out: dict = {s: [] for s in blocks}
    base = 0
    while left:
        shares, span = exact_units({s: weights[s] for s in left})
        plan = one_period(shares, span, left)
        ends = [(left[s] - 1) // shares[s] * span + plan[s][(left[s] - 1) % shares[s]]
                for s in left if (left[s] - 1) % shares[s] < len(plan[s])]
        last = min(ends)
        rounds, rest = divmod(last + 1, span)
        for s in list(left):
            got = rounds * shares[s] + bisect_left(plan[s], rest)
            if got:
                out[s].append((done[s], done[s] + got, base, shares[s], span, plan[s]))
            done[s] += got
            left[s] -= got
            if not left[s]:
                del left[s]
        base += last + 1
    return out


def root_weights(sizes: dict) -> dict:
    """Target weights by the square root of the size: large sources shrink, small ones grow."""
    return {s: Fraction(max(1, int(n ** 0.5 * 1000))) for s, n in sizes.items()}


def block_table(plan: dict) -> pa.Table:
    """Rows of up to CHUNK blocks of a source, the k-th of ``plan``: phase, release, deadline and slot of each."""
    ids, chunks = [], []
    parts: dict = {c: [] for c in ("phases", "releases", "deadlines", "slots")}
    ends = [0]
    for k, found in enumerate(plan.values()):
        rows: dict = {c: [] for c in parts}
        for number, (first, end, base, share, span, offsets) in enumerate(found):
            # exact beyond 64 bits too: weights may have any denominator
            j = np.arange(end - first, dtype=np.int64 if (end - first + 1) * span < 1 << 62 else object)
            rows["phases"].append(np.full(len(j), number, np.int32))
            rows["releases"].append((base + j * span // share).astype(np.int64))
            rows["deadlines"].append((base - -(j + 1) * span // share).astype(np.int64))
            slots = np.frombuffer(offsets, np.int64)
            rows["slots"].append((base + j // share * span).astype(np.int64) + slots[(j % share).astype(np.int64)])
        for c, arrays in rows.items():
            parts[c] += arrays
        n = sum(map(len, rows["slots"]))
        for chunk, at in enumerate(range(0, n, CHUNK)):
            ids.append(k)
            chunks.append(chunk)
            ends.append(ends[-1] + min(CHUNK, n - at))
    kinds = {c: pa.int32() if c == "phases" else pa.int64() for c in parts}
    flat = {c: pa.array(np.concatenate(a) if a else [], kinds[c]) for c, a in parts.items()}
    return pa.table({
        "mix_of": pa.array(ids, pa.int32()), "mix_chunk": pa.array(chunks, pa.int64()),
        **{f"mix_{c}": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), a) for c, a in flat.items()}})


def mixed(
    docs: DataFrame, weights: dict | None = None, block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES, period: int = PERIOD, into: str = "mix",
) -> DataFrame:
    """``docs`` with a struct column: block, phase, release, deadline, slot, before, slots.

    ``before`` is the number of bytes of the source before the document, so (slot, before,
    doc_id) is the mixed order; ``block`` counts the blocks of the source; ``slots`` is the
    number of all slots.  A block holds the documents that begin in it, so a document of
    more than one block leaves the blocks it covers empty.  ``weights`` maps each source to
    a positive number, taken exactly; sources without one are refused; None takes the root of
    the size.  ``phase`` counts the phases of the source.  ``period`` is ignored.
    A null source is a source.  Sizes are UTF-8 bytes plus 1, so empty and null texts count.
    Equal rows keep their number; their order among themselves is free.  An empty table gives
    no rows.
    """
    size, spot, part, nth = (fresh(docs, n) for n in ("size", "spot", "part", "total"))
    # 31 bits of a hash: order within the source, and its range by multiplication
    sized = docs.withColumns({
        size: utf8_size(F.col("text").cast("string")),
        spot: F.shiftrightunsigned(F.xxhash64(F.lit(5), F.col("doc_id").cast("long")), 33)})
    found = sized.groupBy("source").agg(F.sum(size).alias(nth)).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["source"]: r[nth] for r in found}
    chosen = root_weights(sizes) if weights is None else weights
    if missing := [s for s in sizes if not chosen.get(s, 0) > 0]:
        raise ValueError(f"no positive weight for {missing[:5]}")
    plan = phases({s: -(-n // block_bytes) for s, n in sizes.items()},
                  {s: Fraction(chosen[s]) for s in sizes}, period)
    slots = sum(end - first for p in plan.values() for first, end, *_ in p)
    spark = docs.sparkSession
    rules = spark.createDataFrame(
        [(s, -(-n // range_bytes), k) for k, (s, n) in enumerate(sizes.items())],
        f"mix_source {docs.schema['source'].dataType.simpleString()}, mix_parts long, mix_id int")
    blocks = spark.createDataFrame(block_table({s: plan[s] for s in sizes}))

    ranged = sized.join(rules.select("mix_source", "mix_parts"), F.col("source").eqNullSafe(F.col("mix_source")))
    ranged = ranged.withColumn(part, F.shiftright(F.col(spot) * F.col("mix_parts"), 31)).drop("mix_source", "mix_parts")
    totals = ranged.groupBy("source", part).agg(F.sum(size).alias(nth))
    earlier = Window.partitionBy("source").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("mix_source"), F.col(part).alias("mix_part"),
                           F.coalesce(F.sum(nth).over(earlier), F.lit(0)).alias("mix_start"))
    inside = Window.partitionBy("source", part).orderBy(spot, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn(nth, F.coalesce(F.sum(size).over(inside), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("mix_source")) & (F.col(part) == F.col("mix_part")))
    placed = placed.withColumn(nth, F.col(nth) + F.col("mix_start")).drop("mix_source", "mix_part", "mix_start")
    placed = placed.join(rules.select("mix_source", "mix_id"), F.col("source").eqNullSafe(F.col("mix_source")))

    placed = placed.withColumn(part, F.floor(F.col(nth) / block_bytes).cast("long"))
    chunk = F.expr(f"`{part}` div {CHUNK}")
    placed = placed.join(F.broadcast(blocks) if slots <= BROADCAST_SLOTS else blocks,
                         (F.col("mix_id") == F.col("mix_of")) & (chunk == F.col("mix_chunk")))
    at = F.pmod(F.col(part), F.lit(CHUNK)).cast("int")
    mix = F.struct(
        F.col(part).alias("block"), F.get("mix_phases", at).alias("phase"), F.get("mix_releases", at).alias("release"),
        F.get("mix_deadlines", at).alias("deadline"), F.get("mix_slots", at).alias("slot"), F.col(nth).alias("before"),
        F.lit(slots).cast("long").alias("slots"))
    return placed.select(*docs.columns, mix.alias(into))


def in_mixed_order(docs: DataFrame, partition_bytes: int = 1 << 27, **settings) -> DataFrame:
    """The rows of ``docs`` laid out in mixed order: written files, read by part number and row, keep it.

    Each partition holds an equal stretch of slots, that is about equal bytes; rows go there by
    that number in one exchange.
    """
    mark, part = fresh(docs, "mix"), fresh(docs, "mix_part")
    rows = mixed(docs, into=mark, **settings)
    first = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    size = docs.agg(F.sum(utf8_size(F.col("text").cast("string"))).alias("n")).first()["n"] or 0
    parts = max(int(first), -(-size // partition_bytes))
    spread = F.floor(F.col(mark)["slot"] * parts / F.greatest(F.col(mark)["slots"], F.lit(1))).cast("int")
    laid = rows.withColumn(part, F.least(spread, F.lit(parts - 1))).repartitionById(parts, F.col(part))
    return laid.sortWithinPartitions(F.col(mark)["slot"], F.col(mark)["before"], "doc_id").select(*docs.columns)
