"""Lines that stand in many documents are dropped from all of them but one.

Lines are exploded with their position, normalised and hashed; distinct documents are counted
per hash; lines of hashes over the threshold go, but for those in the largest doc_id; the rest
is put together again by position.  Functions only, no Python in the tasks:

* What is shuffled for the count is a 128-bit hash and a doc_id per long line, combined in each
  task and spread by hash and document, so a line that all documents share is no hot key.
* Positions of dropped lines meet their hashes by a join that adaptive execution broadcasts
  where the frequent lines are few and splits where one of them is hot.
* A text travels at most once, to the join with the positions it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import fresh
from tillroll.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARGIN = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 40, 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(MARGIN)), UPPER, LOWER)


def _digest(prefix: str, value: Column) -> list[Column]:
    """128 bits of a string as two columns."""
    return [F.xxhash64(value).alias(f"{prefix}1"), F.xxhash64(F.lit(7), value).alias(f"{prefix}2")]


def _long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc, t1, t2 (digest of its text), pos, k1, k2 (digest of the key) per line long enough to be looked at."""
    exploded = docs.select("doc", *_digest("t", F.coalesce("text", F.lit(""))), F.posexplode(_lines(F.col("text"))))
    keyed = exploded.select("doc", "t1", "t2", "pos", line_key(F.col("col")).alias("key"))
    return keyed.filter(F.length("key") >= least_chars).select("doc", "t1", "t2", "pos", *_digest("k", F.col("key")))


def frequent_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """k1, k2, holder (the largest doc): line hashes found in at least ``least_docs`` documents."""
    counted = lines.groupBy("k1", "k2").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("holder"))
    return counted.filter(F.col("n") >= least_docs).select("k1", "k2", "holder")


def with_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``lines``: n_lines, n_dropped, kept (the text that is left).

    A text is cut at line feeds; null and empty texts are one empty line, and ``kept`` is never
    null.  Keys of at least ``least_chars`` code points found in at least ``least_docs`` distinct
    doc_ids lose all their lines but those in the largest of these doc_ids.  Rows that repeat a
    doc_id are one document for the count and each is stripped by its own text; if they hold the
    largest id, all keep the line.  Rows without a doc_id are not counted and hold no line.
    """
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").alias("doc"),
                       F.col("text").cast("string").alias("text"))
    lines = _long_lines(rows.select("doc", "text"), least_chars)
    frequent = materialize(frequent_lines(lines, least_docs), "frequent-lines")
    gone = lines.join(frequent, ["k1", "k2"]).filter(F.col("doc").isNull() | (F.col("doc") != F.col("holder")))
    gone = gone.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("gone"))
    gone = gone.select(F.col("doc").alias("d"), F.col("t1").alias("g1"), F.col("t2").alias("g2"), "gone")

    own = rows.select("row", "doc", "text", *_digest("t", F.coalesce("text", F.lit(""))))
    same = own.doc.eqNullSafe(gone.d) & (own.t1 == gone.g1) & (own.t2 == gone.g2)
    split = own.join(gone, same, "left").select("row", "text", "gone", _lines(F.col("text")).alias("parts"))
    # a set difference keeps order and is linear, however many lines a text has
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda at: F.get(F.col("parts"), at)), "\n")
    name = fresh(docs.select(*names), "lines")
    return split.select("row.*", F.struct(
        F.size("parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept")).alias(name))
