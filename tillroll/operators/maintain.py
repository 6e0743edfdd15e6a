"""Keeping tables up to date: merges and dimension history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.expressions import instant
from tillroll.operators.dedup import top1_by
from tillroll.session import FAST, materialize, scratch_scope
from tillroll.sources.key_index import KeyIndex
from tillroll.sources.ledger import moment
from tillroll.sources.writers import write_partitioned

SCD_COLUMNS = ("_valid_from", "_valid_to", "_is_current")
_TOO_EARLY = "a delivery older than the stored history needs the times of all deliveries"


def merge_upsert(target: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """Target with the source rows put in place of rows of the same key, or added."""
    kept = target.join(src.select(key), key, "left_anti")
    return kept.unionByName(src.select(*target.columns))


def _partition_filter(target: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Target rows in the touched partitions.

    Partition values are table metadata, at most one row per folder.  The values of each
    partition column become a literal list, which skips the other folders without listing
    their files, however many are touched; a semi join then selects the exact combinations.
    """
    for c in parts:
        values = [r[c] for r in touched.select(c).distinct().collect()]
        known = [v for v in values if v is not None]
        listed = F.col(c).isin(known) if known else F.lit(False)
        target = target.filter(listed | F.col(c).isNull() if len(known) < len(values) else listed)
    same = reduce(lambda a, b: a & b, [target[c].eqNullSafe(touched[c]) for c in parts])
    return target.join(touched, same, "left_semi")


def merge_into_table(
    spark: SparkSession, path: str, src: DataFrame, key: str, partition_cols: Sequence[str],
    order: Sequence[Column] | None = None, follow_moves: bool = True,
    sort_by: Sequence[str] = (), gone: str | None = None, gone_to: str | None = None,
    index: KeyIndex | None = None, restage: bool = True,
) -> int:
    """Merge ``src`` into a partitioned Parquet table, rewriting only the partitions it meets.

    Without ``order`` source rows replace stored rows of the same key; with it the first row
    per key under that order stays, so a late or repeated run cannot bring back an older
    version.  A key may turn up in another partition than before: its old partition is then
    rewritten too.  ``index`` tells where keys may be, and only the buckets of the source's keys
    are read; the index is built when it is not there yet.  Without it the key column of the
    whole table is looked at.  Leave both out with ``follow_moves=False`` where the partition
    is a function of the key.

    ``gone`` names a boolean column of ``src``: where it is true the row takes part in the
    choice and then leaves no row; the keys that end so are written to ``gone_to``.
    ``sort_by`` orders the rows of each partition.

    The source and the result are staged in the shared folder first: a path is never overwritten
    while it is being read.  ``restage=False`` leaves the source where it is: for one that reads
    only what has been staged and costs little more than its scan, which is then made several times.  A merge that fails half-way can be run again with the same source: it
    finds the keys wherever they are and ends in the same table.  Returns the number of
    source rows that are in the table afterwards.  What it has staged is deleted at its end.
    """
    with scratch_scope(spark):
        return _merge_into_table(
            spark, path, src, key, partition_cols, order, follow_moves, sort_by, gone, gone_to, index, restage)


def _merge_into_table(
    spark: SparkSession, path: str, src: DataFrame, key: str, partition_cols: Sequence[str],
    order: Sequence[Column] | None, follow_moves: bool, sort_by: Sequence[str], gone: str | None,
    gone_to: str | None, index: KeyIndex | None, restage: bool,
) -> int:
    parts = list(partition_cols)
    staged = (materialize(src, "merge-source", FAST) if restage else src).withColumn("_new", F.lit(True))
    target = spark.read.parquet(path).withColumn("_new", F.lit(False))
    touched, listed = staged.select(*parts), None
    if follow_moves and index is not None:
        index.ensure(target)
        listed = materialize(index.entries(staged), "merge-keys")
        touched = touched.unionByName(index.partitions(listed, staged))
    elif follow_moves:
        touched = touched.unionByName(
            target.select(key, *parts).join(staged.select(key), key, "left_semi").select(*parts))
    touched = materialize(touched.distinct(), "merge-partitions")
    stored = _partition_filter(target, touched, parts)
    kept = stored if gone is None else stored.withColumn(gone, F.lit(False))
    if order is None:
        merged = merge_upsert(kept, staged, key)
    else:
        merged = top1_by(kept.unionByName(staged.select(*kept.columns)), key, [*order, F.col("_new").desc()])
    result = materialize(merged, "merge-result", FAST)
    if gone is not None:
        if gone_to is not None:
            result.filter(gone).select(key).write.mode("overwrite").parquet(gone_to)
        result = result.filter(~F.col(gone)).drop(gone)
    if listed is not None:
        index.add(result.filter("_new"), listed)
    write_partitioned(result.drop("_new"), path, parts, sort_by)
    if follow_moves or gone is not None:
        _drop_partitions(spark, path, touched.exceptAll(result.select(*parts).distinct()), parts)
    return result.filter("_new").count()


def _drop_partitions(
    spark: SparkSession, path: str, emptied: DataFrame, parts: Sequence[str]
) -> None:
    """Remove the folders of partitions that have lost their last row; one row per folder."""
    for row in emptied.toLocalIterator():
        names = [
            f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in parts
        ]
        folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *names]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _opened(rows: DataFrame, now: Column) -> DataFrame:
    return rows.withColumns({
        "_valid_from": now,
        "_valid_to": F.lit(None).cast("timestamp"),
        "_is_current": F.lit(True),
    })


def _late(
    target: DataFrame, new: DataFrame, key: str, check_cols: Sequence[str], now: Column, after,
    invalidate_hard_deletes: bool,
) -> DataFrame:
    """The history with a delivery of the time ``now`` put in; the next one came at ``after`` (None: none).

    The delivery tells the state of its keys from ``now`` until ``after``; what held at ``after`` holds
    again from there.  Only keys whose state at ``now`` differs are rebuilt, from their change points:
    the stored starts and ends, the delivery, and the state at ``after``.  Points that say what the
    point before them says drop out (``lag``), and each of the rest ends at the next (``lead``).
    A delivery of a time that is known replaces the one before.
    """
    attrs = new.columns

    def standing(rows: DataFrame, at: Column) -> DataFrame:
        return rows.filter((F.col("_valid_from") <= at) & (F.col("_valid_to").isNull() | (at < F.col("_valid_to"))))

    said = F.struct(*check_cols)
    was = standing(target, now).select(F.col(key).alias("_k"), said.alias("_was"))
    pairs = was.join(new.select(F.col(key).alias("_key"), said.alias("_said")), F.col("_k") == F.col("_key"), "full_outer")
    differs = ~F.col("_was").eqNullSafe(F.col("_said"))
    if not invalidate_hard_deletes:
        differs = differs & F.col("_key").isNotNull()
    touched = materialize(
        pairs.filter(differs).select(F.coalesce("_key", "_k").alias(key)).distinct(), "history-touched")

    def points(rows: DataFrame, at: Column, there: bool, rank: int) -> DataFrame:
        kept = [F.col(c) if there or c == key else F.lit(None).cast(new.schema[c].dataType).alias(c) for c in attrs]
        return rows.select(*kept, at.alias("_valid_from"), F.lit(there).alias("_there"), F.lit(rank).alias("_rank"))

    stored = target.join(touched, key, "left_semi")
    told = new.join(touched, key, "left_semi")
    found = [points(stored, F.col("_valid_from"), True, 1),
             points(stored.filter("_valid_to is not null"), F.col("_valid_to"), False, 2), points(told, now, True, 0)]
    if invalidate_hard_deletes:
        found.append(points(touched.join(told, key, "left_anti").select(key), now, False, 0))
    if after is not None:
        again = standing(stored, instant(after))
        found += [points(again, instant(after), True, 1),
                  points(touched.join(again, key, "left_anti").select(key), instant(after), False, 2)]
    in_turn = Window.partitionBy(key).orderBy("_valid_from")
    first = Window.partitionBy(key, "_valid_from").orderBy("_rank")
    each = reduce(DataFrame.unionByName, found).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    state = F.struct("_there", F.when(F.col("_there"), F.struct(*check_cols)).alias("_said"))
    nothing = F.struct(F.lit(False).alias("_there"), F.lit(None).alias("_said"))
    turned = each.withColumn("_state", state).withColumn("_before", F.lag("_state").over(in_turn))
    turned = turned.filter(~F.col("_state").eqNullSafe(F.coalesce("_before", nothing.cast(turned.schema["_state"].dataType))))
    closed = turned.withColumn("_valid_to", F.lead("_valid_from").over(in_turn)).filter("_there")
    rebuilt = closed.select(*attrs, "_valid_from", "_valid_to", F.col("_valid_to").isNull().alias("_is_current"))
    rest = target.join(touched, key, "left_anti").select(*rebuilt.columns)
    return rest.unionByName(rebuilt)


def scd2_merge(
    target: DataFrame | None,
    src: DataFrame,
    key: str,
    check_cols: Sequence[str],
    now_ts,
    invalidate_hard_deletes: bool = False,
    deliveries: Sequence | None = None,
) -> DataFrame:
    """Type 2 history of ``src`` on top of ``target``.

    A current row whose checked columns differ (NULL-safe) is closed at ``now_ts`` and a
    new version opens; a new key opens; an unchanged key is left alone.  A key that is
    gone from the source is left open, or closed with ``invalidate_hard_deletes``.  The
    source holds one row per key.

    ``deliveries`` are the times of all earlier runs.  With them runs may come in any order, or
    again: see ``_late``.  Without them ``now_ts`` must be later than what is stored, and a row
    that would end before it begins is an error.

    One full outer join of the current rows tells what happens to each key; the outcome
    is a short list of roles (keep, close, open), and each role becomes one row.  Closed
    versions are passed through without a join.
    """
    now = instant(now_ts)
    attrs = [c for c in src.columns if c not in SCD_COLUMNS]
    new = src.select(*attrs)
    if target is None:
        return _opened(new, now)

    if deliveries and moment(now_ts) <= max(map(moment, deliveries)):
        after = min((t for t in map(moment, deliveries) if t > moment(now_ts)), default=None)
        return _late(target, new, key, check_cols, now, after, invalidate_hard_deletes)

    columns = [*attrs, *SCD_COLUMNS]
    current = target.filter(F.col("_is_current")).select(*columns)
    past = target.filter(~F.col("_is_current")).select(*columns)
    old = current.select(*[F.col(c).alias(f"old_{c}") for c in columns], F.lit(1).alias("_had"))
    new = new.select(*[F.col(c).alias(f"new_{c}") for c in attrs], F.lit(1).alias("_has"))

    pairs = old.join(new, F.col(f"old_{key}") == F.col(f"new_{key}"), "full_outer")
    changed = reduce(
        lambda a, b: a | b,
        [~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in check_cols],
    )
    gone = "close" if invalidate_hard_deletes else "keep"
    roles = (
        F.when(F.col("_had").isNull(), F.array(F.lit("open")))
        .when(F.col("_has").isNull(), F.array(F.lit(gone)))
        .when(changed, F.array(F.lit("close"), F.lit("open")))
        .otherwise(F.array(F.lit("keep")))
    )
    acted = pairs.withColumn("_role", F.explode(roles))
    opens, closes = F.col("_role") == "open", F.col("_role") == "close"
    out = [F.when(opens, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in attrs]
    result = acted.select(
        *out,
        F.when(opens, now).otherwise(F.col("old__valid_from")).alias("_valid_from"),
        F.when(closes & (now <= F.col("old__valid_from")), F.raise_error(F.lit(_TOO_EARLY))).when(closes, now)
        .when(~opens, F.col("old__valid_to")).alias("_valid_to"),
        (~closes).alias("_is_current"),
    )
    return result.unionByName(past)


def snapshot_customers(
    target: DataFrame | None, customers: DataFrame, now_ts, deliveries: Sequence | None = None
) -> DataFrame:
    """Customer history checked on tier, segment and order count; missing customers are closed."""
    return scd2_merge(
        target, customers, "customer_id", ("loyalty_tier", "segment", "total_orders"), now_ts,
        invalidate_hard_deletes=True, deliveries=deliveries,
    )
