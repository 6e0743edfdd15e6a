"""A Merkle manifest of a dataset: a leaf per row, a subroot per group, one root, a proof per row.

A nested-struct rollup.  The rank of a row in its group has base-16 digits; within a block of
16^3 ranks the digits are grouped away one after the other: sixteen structs at most become the
``kids`` of the next struct, which carries their joint digest.  Blocks are rows again, ranked by
their number, and are rolled up the same way until each group is one block; the subroots, ranked
by group, are rolled up to the root.  On the way back each block meets the steps above it in a
grouping by block number (no join), and ``transform`` and ``inline`` unfold the structs into one
row per leaf with all siblings on its path.

Nothing grows with a group: a block holds at most 4,096 leaves, whatever its group, so a hot
group is many blocks, and each tier has 1/4,096 of the rows of the one below.  A rank costs no
window over the group: rows are dealt by ranges of (group, order), numbered within each
range, and the ranges' counts are added up.  Functions only, no Python in the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize

BITS = 4                      # digit of a rank: 16 children
DIGITS = 3                    # digits nested in one block
FAN, BLOCK = 1 << BITS, 1 << BITS * DIGITS
WIDTH = 64                    # characters of a digest
_PATH = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """A value as ``byte count:value``, a null as ``-``; so no two rows read the same."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in its group ``g`` by ``order``) and ``total`` (rows of the group).

    A range of rows is sorted and numbered by the task that writes it.  Rows equal in ``g`` and
    ``order`` are spread by their number in the table, so that repeated rows are no hot range.
    """
    tie = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    keys = ["g", *order, "_tie"]
    dealt = materialize(tie, "merkle-rows").repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    placed = materialize(dealt.drop("_tie").withColumns({
        "_part": F.shiftright(at, 33), "_at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "merkle-ranges")
    counts = placed.groupBy("_part", "g").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    group = Window.partitionBy("g")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = materialize(counts.select(
        F.col("_part").alias("p"), F.col("g").alias("og"),
        (F.sum("n").over(before) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(group).alias("total")), "merkle-counts")
    same = (placed["_part"] == ranges["p"]) & placed["g"].eqNullSafe(ranges["og"])
    return placed.join(ranges, same).withColumn("rank", F.col("_at") + F.col("shift")).drop(
        "_part", "_at", "p", "og", "shift")


def _tier(rows: DataFrame, load: Sequence[str]) -> DataFrame:
    """g, block, total, h, kids: blocks of ``rows`` (g, rank, total, h and ``load``), rolled up digit by digit.

    ``total`` counts the blocks' own rows.  A level is there while it has more than one node; a lone
    node passes its digest on.
    """
    digits = [F.shiftright("rank", BITS * k).bitwiseAND(F.lit(FAN - 1)).alias(f"d{k}") for k in range(DIGITS)]
    level = rows.select("g", F.shiftright("rank", BITS * DIGITS).alias("block"), "total", "h", *load, *digits)
    level = level.repartition("g", "block")
    inner = list(load)
    for k in range(DIGITS):
        upper = [f"d{j}" for j in range(k + 1, DIGITS)]
        kids = F.array_sort(F.collect_list(F.struct(f"d{k}", "h", *inner)))
        level = level.groupBy("g", "block", *upper).agg(kids.alias("kids"), F.first("total").alias("total"))
        joint = F.sha2(F.array_join(F.col("kids.h"), ""), 256)
        digest = F.when(F.col("total") > FAN**k, joint).otherwise(F.col("kids")[0]["h"])
        level, inner = level.withColumn("h", digest), ["kids"]
    return level


def _tiers(rows: DataFrame, load: Sequence[str]) -> list[DataFrame]:
    """Tiers of blocks from ``rows`` up, each written; in the last each group is one block."""
    tiers = []
    while True:
        tiers.append(materialize(_tier(rows, load), "merkle-blocks"))
        highest = tiers[-1].agg(F.max("block")).first()[0]
        if not highest:
            return tiers
        rows, load = tiers[-1].select(
            "g", F.col("block").alias("rank"), F.ceil(F.col("total") / BLOCK).alias("total"), "h"), ()


def _unfold(blocks: DataFrame, load: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """One row per row of a tier: g, rank, h, ``load``, ``carried`` and its ``path`` of siblings, lowest first."""
    rows = blocks.withColumn("rank", F.col("block"))
    for k in reversed(range(DIGITS)):
        rows = rows.withColumn("_all", F.array_join(F.col("kids.h"), ""))
        inner = ("kids",) if k else tuple(load)
        parts = ", ".join([f"x.d{k} as _d", "i as _i", "x.h as h", *[f"x.`{c}` as `{c}`" for c in inner]])
        child = F.expr(f"transform(kids, (x, i) -> struct({parts}))")
        rows = rows.select("g", "total", "rank", "path", *carried, "_all", F.inline(child))
        step = F.struct(F.substring("_all", F.lit(1), F.col("_i") * WIDTH).alias("left"),
                        F.substring("_all", (F.col("_i") + 1) * WIDTH + 1, F.lit(FAN * WIDTH)).alias("right"))
        longer = F.when(F.col("total") > FAN**k, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        rows = rows.select("g", "total", (F.shiftleft("rank", BITS) + F.col("_d")).alias("rank"), "h",
                           longer.alias("path"), *carried, *inner)
    return rows.drop("total")


def _meet(blocks: DataFrame, above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Blocks with the path and the columns ``carried`` of the row ``above`` that stands for them."""
    own = blocks.select("g", "block", "total", "kids", F.lit(None).cast(_PATH).alias("path"),
                        *[F.lit(None).cast("string").alias(c) for c in carried])
    top = above.select("g", F.col("rank").alias("block"), F.lit(None).cast("long").alias("total"),
                       F.lit(None).cast(blocks.schema["kids"].dataType).alias("kids"), "path", *carried)
    both = own.unionByName(top)
    names = ["total", "kids", "path", *carried]
    return both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def with_proofs(leaves: DataFrame, load: Sequence[str] = (), order: Sequence[str] = ("id",)) -> DataFrame:
    """Each leaf with its subroot, the root and its path of siblings.

    ``leaves`` has g (the group, a string), h (the digest), the columns ``order`` and ``load``.
    Leaves ascend by ``order`` (nulls first), then by digest; groups ascend by their UTF-8 bytes, null first.
    Every 16 consecutive nodes (the last run: fewer) become the digest of their joined digests
    while there is more than one node; a lone leaf is its group's subroot.  Returns g, rank, h, ``load``,
    subroot, root, path (left and right siblings, lowest level first).  An empty table has no rows.
    """
    asked = leaves.select("g", "h", *order, *[c for c in load if c not in order])
    bottom = _tiers(_ranked(asked, [*order, "h"]), load)
    groups = bottom[-1].select(F.lit(0).alias("g"), F.col("g").alias("group"), "h")
    upper = _tiers(_ranked(groups, ["group"]), ["group"])

    rows = upper[-1].withColumns({"path": F.array().cast(_PATH), "root": F.col("h")})
    for tier in reversed(upper[:-1]):
        rows = _meet(tier, _unfold(rows, (), ["root"]), ["root"])
    rows = _unfold(rows, ["group"], ["root"]).select(
        F.col("group").alias("g"), F.lit(0).cast("long").alias("rank"), "path", "root", F.col("h").alias("subroot"))
    for k, tier in reversed(list(enumerate(bottom))):
        rows = _unfold(_meet(tier, rows, ["root", "subroot"]), () if k else load, ["root", "subroot"])
    return rows


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row of ``docs``.

    A leaf covers doc_id, source, lang, n_chars and text, nulls included; further columns are ignored.
    Groups are sources; a null source is a group of its own.  Repeated rows are leaves like any
    other.  Where 5 divides the CRC-32 of the decimal doc_id the check runs on a tampered leaf, whose
    text has A-Z in lower case: it is verified only if that changes nothing.  A null doc_id is not tampered with.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    values = {c: F.col(c) for c in FIELDS}
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    tampered = leaf_digest(list((values | {"text": F.translate("text", upper, lower)}).values()))
    leaves = docs.select(
        F.col("source").cast("string").alias("g"), "doc_id", leaf_digest(list(values.values())).alias("h"),
        F.when(hit, tampered).alias("now"))
    found = with_proofs(leaves, load=("doc_id", "now"), order=("doc_id",))
    folds = found.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", "path",
                         folded(F.coalesce("now", "h"), F.col("path")).alias("folded_root"))
    return folds.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
