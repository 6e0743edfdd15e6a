"""Raw (bronze) readers with declared layouts."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tillroll import vocabulary as V

CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return (
        spark.read.schema(f"{ddl}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Order JSON; the text of a line that does not fit the layout is kept in _corrupt_record."""
    return _json(spark, path, V.ORDERS_DDL)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer JSON, bad lines as in ``read_orders``."""
    return _json(spark, path, V.CUSTOMERS_DDL)


def read_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """Click JSON, bad lines as in ``read_orders``."""
    return _json(spark, path, V.CLICKSTREAM_DDL)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is text until it is cast."""
    return spark.read.schema(V.INVENTORY_DDL).option("header", True).csv(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """XML with one <review> element per row; every column is text until it is cast."""
    return spark.read.format("xml").schema(V.REVIEWS_DDL).option("rowTag", "review").load(path)


def split_corrupt(df: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows with all columns).

    The raw frame is parsed once per side; nothing raw is cached.  Both sides keep the data
    columns, because Spark refuses to read the corrupt column alone.
    """
    bad = F.col(corrupt).isNotNull()
    return df.filter(~bad).drop(corrupt), df.filter(bad)


def avro_contract(ddl: str, optional: tuple[str, ...], name: str, namespace: str) -> str:
    """Avro record schema (JSON text) of a flat layout."""
    fields = []
    for field in StructType.fromDDL(ddl):
        plain = "int" if isinstance(field.dataType, IntegerType) else "string"
        if field.name in optional:
            fields.append({"name": field.name, "type": ["null", plain], "default": None})
        else:
            fields.append({"name": field.name, "type": plain})
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})


def clickstream_contract() -> str:
    return avro_contract(
        V.CLICKSTREAM_DDL, V.CLICKSTREAM_OPTIONAL, "ClickstreamEvent", "tillroll.events"
    )


# First bytes of a framed message, by the two usual registries.
UUID_FRAME, NUMBER_FRAME, PLAIN_BODY = "03", "00", "00"


def unframe_avro(df: DataFrame, known: Iterable[str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(messages with ``_schema_id`` and the bare Avro body in ``value``, dead letters with ``_error``).

    A registry writes a header before the body: 03, a compression byte and the 16 bytes of a schema
    version (given back in the form of a UUID), or 00 and the 4 bytes of a schema number (as decimal
    text).  ``known`` holds the ids with a contract.  What is missing, has no such header, is compressed,
    or names another schema is a dead letter with its bytes as they came.
    """
    body, head = F.col(value), F.hex(F.substring(value, 1, 1))
    size = F.coalesce(F.octet_length(value), F.lit(0))
    uuid = F.regexp_replace(F.lower(F.hex(F.substring(value, 3, 16))), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    by_uuid, by_number = (head == UUID_FRAME) & (size >= 18), (head == NUMBER_FRAME) & (size >= 5)
    told = F.when(by_uuid, uuid).when(by_number, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10))
    packed = by_uuid & (F.hex(F.substring(value, 2, 1)) != PLAIN_BODY)
    listed = F.coalesce(F.col("_schema_id").isin(*known), F.lit(False))
    marked = df.withColumn("_schema_id", told).withColumn("_error", F.when(F.col("_schema_id").isNull(), "no_header").when(
        packed, "compressed").when(~listed, "unknown_schema"))
    start = F.when(by_uuid, 19).otherwise(6)
    bare = F.substring(body, start, F.greatest(size - start + 1, F.lit(0)))
    good = marked.filter("_error is null").withColumn(value, bare).drop("_error")
    return good, marked.filter("_error is not null")


def decode_framed(df: DataFrame, contracts: dict[str, str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(decoded records with their ``_schema_id``, dead letters); ``contracts`` are Avro schemas by id."""
    good, letters = unframe_avro(df, contracts, value)
    records = [decode_avro(good.filter(F.col("_schema_id") == i), schema, value).withColumn("_schema_id", F.lit(i))
               for i, schema in contracts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records), letters


def decode_avro(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Columns of an Avro-encoded ``value`` column.  Needs the spark-avro package."""
    from pyspark.errors import PySparkException
    from pyspark.sql.avro.functions import from_avro

    try:
        decoded = df.select(from_avro(F.col(value), schema, {"mode": "PERMISSIVE"}).alias("r"))
        return decoded.select("r.*")
    except (PySparkException, TypeError) as err:
        raise RuntimeError("Avro decoding needs the spark-avro package on the session") from err
