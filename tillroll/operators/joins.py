"""Joins that hold up when one key carries a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE_ROWS = 1_000_000   # rows of one key that one task should join


def hot_keys(df: DataFrame, key: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(key, _pieces) of every key with more than ``piece_rows`` rows, NULL among them.

    ``_pieces`` is the number of tasks its rows need.  There are fewer such keys than rows /
    piece_rows, which bounds the list whatever the keys.  Counting combines on the map
    side, so finding a hot key is not itself skewed.
    """
    counted = df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > piece_rows)
    return counted.select(key, F.ceil(F.col("_rows") / piece_rows).cast("int").alias("_pieces"))


def _salted(
    left: DataFrame, right: DataFrame, key: str, spread_by: Column | str, piece_rows: int,
    profile: DataFrame | None,
) -> tuple[DataFrame, DataFrame]:
    """Left rows with ``_salt``, and right rows with ``_right_key`` and ``_right_salt``, one copy per piece of a hot key."""
    hot = hot_keys(left if profile is None else profile, key, piece_rows)
    hot = hot.withColumnRenamed(key, "_hot_key")
    pieces = F.coalesce("_pieces", F.lit(1))
    spread = (
        left.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
        .drop("_hot_key", "_pieces")
    )
    copied = (
        right.withColumnRenamed(key, "_right_key")
        .join(F.broadcast(hot), F.col("_right_key") == F.col("_hot_key"), "left")
        .withColumn("_right_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_hot_key", "_pieces")
    )
    return spread, copied


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column | str,
    how: str = "left",
    piece_rows: int = PIECE_ROWS,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Join on ``key`` in which the left rows of a hot key are split into pieces.

    A key gets as many pieces as it has times ``piece_rows``.  The piece is a hash of
    ``spread_by`` (a column of the left row), so a re-run task sends each row to the same
    one.  Right rows of a hot key are copied once per piece; all other right rows are sent
    once.  NULL keys match nothing and are spread as well.  The list of hot keys is sent
    to all tasks: it is shorter than rows / piece_rows, about 2 MB for 100 billion rows.
    How the sides then meet is left to adaptive execution, which knows their bytes.
    ``profile`` may name a cheaper
    frame with the same keys to count instead of ``left`` (its base table).
    """
    spread, copied = _salted(left, right, key, spread_by, piece_rows, profile)
    condition = (F.col(key) == F.col("_right_key")) & (F.col("_salt") == F.col("_right_salt"))
    met = spread.join(copied, condition, how).drop("_salt", "_right_salt", "_right_key")
    return met.select(key, *[c for c in met.columns if c != key])


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column | str,
    piece_rows: int = PIECE_ROWS,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Left join to a lookup table that has one row per key, with hot left keys spread.

    One plan at every size: adaptive execution broadcasts a lookup side of few bytes.
    """
    return spread_join(left, right, key, spread_by, piece_rows=piece_rows, profile=profile)


def explode_items(orders: DataFrame, items: str = "items") -> DataFrame:
    """One row per order line; an order without lines gives no row."""
    rest = [c for c in orders.columns if c != items]
    return orders.select(*rest, F.inline(F.col(items)))


def orphans(
    child: DataFrame, col: str, parent: DataFrame, ref: str, unknown: str | None = None
) -> DataFrame:
    """(value, rows) of child values that the parent lacks; NULL and ``unknown`` are allowed.

    Child rows are counted per value before the join, so a hot value travels as one row.
    """
    values = child.filter(F.col(col).isNotNull())
    if unknown is not None:
        values = values.filter(F.col(col) != unknown)
    counted = values.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(F.col(ref).alias("value")), "value", "left_anti")


def fk_integrity(
    child: DataFrame,
    col: str,
    parent: DataFrame,
    ref: str,
    unknown: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Report of broken references, one line per child row, at most ``limit`` lines.

    The limit is that of the report; ``orphans`` gives every broken value with its rows.
    """
    broken = orphans(child, col, parent, ref, unknown)
    times = F.least(F.col("rows"), F.lit(limit)).cast("int")
    lines = broken.select(F.col("value").alias(col), F.explode(F.sequence(F.lit(1), times)))
    return lines.select(col).orderBy(col).limit(limit)


def join_versions(
    facts: DataFrame, versions: DataFrame, key: str, ts: str, spread_by: Column | str,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Left join to the version that was valid at ``ts`` (from inclusive, to exclusive).

    Facts and versions are one stream per key, in time order, and each fact takes the last version
    before it (``last`` without NULLs): a key with F facts and V versions costs F + V rows, where a join
    on the key alone would meet F * V.  Facts of a hot key are split into pieces, each with a copy of its
    versions; a key has at most one version per delivery.  Facts without a key or time, or in a
    gap of the history, get NULLs.  Of overlapping versions the one that began last is looked at.
    """
    spread, copied = _salted(facts, versions, key, spread_by, piece_rows, None)
    told = [c for c in versions.columns if c != key]
    version = F.struct(*told)
    kind = copied.select(version.alias("v")).schema["v"].dataType
    row = spread.select(F.struct(*facts.columns).alias("v")).schema["v"].dataType
    events = spread.select(
        F.col(key).alias("_key"), "_salt", F.col(ts).alias("_at"), F.lit(1).alias("_turn"),
        F.struct(*facts.columns).alias("_fact"), F.lit(None).cast(kind).alias("_version"),
    ).unionByName(copied.filter("_right_key is not null and _valid_from is not null").select(
        F.col("_right_key").alias("_key"), F.col("_right_salt").alias("_salt"), F.col("_valid_from").alias("_at"),
        F.lit(0).alias("_turn"), F.lit(None).cast(row).alias("_fact"), version.alias("_version")))
    so_far = Window.partitionBy("_key", "_salt").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    met = events.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter("_fact is not null")
    ends = F.col("_version")["_valid_to"]
    valid = ends.isNull() | (F.col("_at") < ends)
    rest = [c for c in facts.columns if c != key]
    return met.withColumn("_version", F.when(valid, F.col("_version"))).select(
        F.col("_fact")[key].alias(key), *[F.col("_fact")[c].alias(c) for c in rest],
        *[F.col("_version")[c].alias(c) for c in told])
