"""A training corpus from raw documents, as five stages that are written and read again in between.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the
last return the columns of ``documents``; the last adds ``shard`` and ``slot``.

1. Documents that the co-trained quality classifier rejects go.
2. One document of each group of near duplicates stays (shingles of five words, similarity 0.8).
3. Documents that contain a benchmark item, also an edited one, go.
4. Sources are interleaved to target weights; the files hold the documents in that order.
5. Sixteen shards of near-equal bytes are cut from the mixed order by histogram sort.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.cotraining import good_documents
from tillroll.llm.decontamination import without_leaks
from tillroll.llm.mixing import in_mixed_order
from tillroll.llm.near_dups import one_of_each
from tillroll.llm.sharding import sharded
from tillroll.session import configure, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_mixed_order(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards along the stored order: the number of the part file, then the row in it.

    ``docs`` is read from the files of the stage before, whose names begin with part-NNNNN.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)
    order = (F.coalesce(part.try_cast("long"), F.lit(-1)), F.col("_metadata.row_index"))
    return sharded(docs, key=order)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("sharding", sharding),
]

# A trained classifier, alignments and a deadline schedule have no SQL form: the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of ``documents``; each stage but the last is written to the shared folder and read again."""
    configure(spark)
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{k}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
