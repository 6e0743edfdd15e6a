"""Shards of near-equal bytes by histogram sort, in DataFrame functions only.

Rows are ordered by a key of two longs.  Each round counts the exact bytes and rows between
candidate key boundaries (probes) over all partitions, keeps for every wanted splitter the one
interval that holds it, and probes that interval more finely, until the bytes below a
splitter are within the tolerance of its target or the interval is a single key.  Only counts
per interval reach the driver.  Then rows are exchanged once, by the part their key belongs to.

Each shard is cut into parts of about ``part_bytes`` by the same rounds, so a shard of any size is
ordered by many tasks; the exact row counts of the last round give the first slot of each part.

The default key is a hash of the text, then doc_id: equal texts lie together, and a group of
copies that holds a third of all rows is still split where the bytes ask for it.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, utf8_size
from tillroll.session import materialize

SHARDS = 16
TOLERANCE = 0.001              # of a part, by which the bytes below a splitter may miss its target
PART_BYTES = 1 << 29
PROBES = 16                    # per interval and round
LEAST = -(1 << 63)
Key = tuple[int, int]


def text_key() -> tuple[Column, Column]:
    """Equal texts together, their copies by doc_id; a null doc_id comes first."""
    return (F.xxhash64(F.col("text").cast("string")),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)))


def _interval(key: Column, bounds: list[Key]) -> Column:
    """How many of the ascending ``bounds`` are at or below the key; two levels of comparisons."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[at : at + width] for at in range(0, len(bounds), width)]
    kind = "array<array<struct<h: bigint, i: bigint>>>"
    table = F.from_json(F.lit(json.dumps([[{"h": h, "i": i} for h, i in g] for g in groups])), kind)
    whole = F.size(F.filter(table, lambda g: g[0] <= key))
    inside = F.size(F.filter(F.get(table, whole - 1), lambda b: b <= key))
    return F.when(whole == 0, 0).otherwise((whole - 1) * width + inside)


@dataclass
class Interval:
    """Keys from ``low`` to ``high`` that occur, with what lies before and inside."""

    low: Key
    high: Key
    before: int
    size: int
    rows_before: int
    rows: int
    start: Key | None          # the probe the interval begins with; None for the first

    def probes(self, count: int) -> list[Key]:
        """Up to ``count`` boundaries evenly between the outer keys; each side keeps a key."""
        (h0, i0), (h1, i1) = self.low, self.high
        first, last = (h0, h1) if h0 != h1 else (i0, i1)
        steps = sorted({first + max(1, (last - first) * k // count) for k in range(1, count + 1)})
        return [(s, LEAST) if h0 != h1 else (h0, s) for s in steps]


@dataclass
class Splitters:
    """Ascending part boundaries with the rows before each, and the shard each part belongs to."""

    bounds: list[Key]
    rows_before: list[int]     # of each part
    shards: list[int]          # of each part
    bytes_before: list[int]
    rounds: int


def find_splitters(
    keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
    part_bytes: int = PART_BYTES, probes: int = PROBES,
) -> Splitters:
    """Splitters of ``keys`` (h, i, size); rows with equal keys are never separated."""
    key = F.struct("h", "i")

    def count(bounds: list[Key]) -> list[Interval]:
        found = keys.groupBy(_interval(key, bounds).alias("n")).agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.sum("size").alias("size"),
            F.count("*").alias("rows")).collect()
        out, size, rows = [], 0, 0
        for r in sorted(found, key=lambda r: r["n"]):
            out.append(Interval(tuple(r["low"]), tuple(r["high"]), size, r["size"], rows, r["rows"],
                                bounds[r["n"] - 1] if r["n"] else None))
            size, rows = size + r["size"], rows + r["rows"]
        return out

    now = count([])
    total = sum(x.size for x in now)
    parts = shards * max(1, -(-total // (shards * part_bytes)))
    targets = [total * k / parts for k in range(1, parts)]
    slack = tolerance * total / parts
    rounds, settled = 0, {}
    while now:
        # the interval that holds each target; a side within the tolerance, or of a single key, settles it
        wanted, at = {}, 0
        for t, target in enumerate(targets):
            if t in settled:
                continue
            while at + 1 < len(now) and now[at + 1].before <= target:
                at += 1
            x = now[at]
            near = min(((abs(x.before - target), x.start or x.low, x.before, x.rows_before),
                        (abs(x.before + x.size - target), now[at + 1].start if at + 1 < len(now) else None,
                         x.before + x.size, x.rows_before + x.rows)), key=lambda n: n[0])
            if near[0] <= slack or x.low == x.high:
                settled[t] = near[1:]
            else:
                wanted[at] = x
        if not wanted:
            break
        rounds += 1
        held = [s[0] for s in settled.values() if s[0] is not None]
        bounds = {b for x in wanted.values() for b in x.probes(probes)} | {x.start for x in wanted.values() if x.start}
        ends = {now[a + 1].start for a in wanted if a + 1 < len(now)}
        now = count(sorted(bounds | ends | set(held)))
    made = [settled[t] for t in sorted(settled)]
    # targets beyond the last key share the end: their parts are empty
    real = [(b, size, rows, t) for t, (b, size, rows) in enumerate(made) if b is not None]
    out = Splitters([], [0], [0], [0], rounds)
    for b, size, rows, t in real:
        shard = (t + 1) * shards // parts
        if out.bounds and out.bounds[-1] == b:      # nothing between two targets: the part before is empty
            out.shards[-1] = shard
            continue
        out.bounds.append(b)
        out.bytes_before.append(size)
        out.rows_before.append(rows)
        out.shards.append(shard)
    return out


def _placed(rows: DataFrame, keys: DataFrame, names: dict, settings: dict) -> tuple[DataFrame, Column, Column]:
    """``rows`` exchanged by part and numbered inside it; the shard and the slot as columns."""
    found = find_splitters(keys, **settings)
    pair = F.struct(F.col(names["h"]).alias("h"), F.col(names["i"]).alias("i"))
    inside = Window.partitionBy(names["part"]).orderBy(names["h"], names["i"])
    placed = rows.withColumn(names["part"], _interval(pair, found.bounds))
    placed = placed.withColumn(names["nth"], F.row_number().over(inside).cast("long"))
    starts: dict[int, int] = {}
    for shard, before in zip(found.shards, found.rows_before, strict=True):
        starts.setdefault(shard, before)
    table = [{"s": s, "b": b - starts[s]} for s, b in zip(found.shards, found.rows_before, strict=True)]
    part = F.get(F.from_json(F.lit(json.dumps(table)), "array<struct<s: int, b: bigint>>"), F.col(names["part"]))
    return placed, part["s"], part["b"] + F.col(names["nth"]) - 1


def sharded(docs: DataFrame, key: tuple[Column, Column] | None = None, **settings) -> DataFrame:
    """``docs``, exchanged by part and ordered inside it, with the columns shard and slot.

    The size of a row is the UTF-8 bytes of its text plus 1 (a null text has none).  Shards
    follow the order of ``key`` (two longs without nulls; by default the hash of the text, then
    doc_id) and differ in bytes by the tolerance or by one key.  ``slot`` numbers the rows of a
    shard from 0 in the order of the key.  Rows with equal keys, such as exact repeats, stay
    together and are numbered in any order.  With fewer keys than shards some shards are empty;
    an empty table gives no rows.  Columns of these two names in ``docs`` are replaced.
    """
    h, i = key or text_key()
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    names = {n: fresh(docs, n) for n in ("h", "i", "part", "nth")}
    rows = docs.withColumns({names["h"]: h, names["i"]: i})
    keys = rows.select(F.col(names["h"]).alias("h"), F.col(names["i"]).alias("i"),
                       utf8_size(F.col("text").cast("string")).alias("size"))
    placed, shard, slot = _placed(rows, materialize(keys, "keys"), names, settings)
    return placed.select(*kept, shard.alias("shard"), slot.alias("slot"))


def shard_table(docs: DataFrame, key: tuple[Column, Column] | None = None, **settings) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``.

    As ``sharded``, but without the texts: they are read once, and only numbers are exchanged.
    The law is ``bytes``: shard sizes are near equal.
    """
    h, i = key or text_key()
    text = F.col("text").cast("string")
    small = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), h.alias("h"), i.alias("i"), utf8_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")), "keys")
    placed, shard, slot = _placed(small, small, {n: n for n in ("h", "i", "part", "nth")}, settings)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard.alias("shard"),
                         slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
