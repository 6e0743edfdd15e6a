"""Topics to date-partitioned files: envelope, dead letters, event-time partitions, counters.

A message is a row with topic, partition, offset, key, value and timestamp, as the Kafka
source gives it.  A file source with the same columns works the same way, which is how it
is tested.  Offsets live in the checkpoint and the file sink commits per micro-batch, so a
restart neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import vocabulary as V

MESSAGE_DDL = (
    "topic string, partition int, offset bigint, key string, value string, timestamp timestamp"
)
PARSE_FAILED = "parse_failed"
CORRUPT = "_misfit"          # text of a message that does not fit its layout


def read_topics(
    spark: SparkSession, fmt: str = "kafka", topics: Sequence[str] = V.TOPICS, **options
) -> DataFrame:
    """Message stream of the topics; ``fmt`` json or parquet reads message files from ``path``."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
        for name, value in options.items():
            reader = reader.option(name, value)
        return reader.load().select(
            "topic", "partition", "offset", F.col("key").cast("string"),
            F.col("value").cast("string"), "timestamp",
        )
    path = options.pop("path")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.schema(MESSAGE_DDL).load(path).filter(F.col("topic").isin(*topics))


def _envelope(consumed_at: Column) -> list[Column]:
    return [
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        consumed_at.alias("_consumed_at"),
    ]


def parse_stream(stream: DataFrame, ddl: str, consumed_at: Column | None = None) -> DataFrame:
    """Payload columns of ``ddl`` plus envelope; ``_error`` and ``_raw`` tell of bad messages.

    Bad is what is no JSON object, and an object with a field that its layout cannot hold
    (such as text in an amount): its columns are NULL and its text is kept.

    The payload comes out of ``explode``, which filters on it are not moved below: they would parse
    each message once more per mention.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    payload = F.from_json("value", f"{ddl}, {CORRUPT} string", options)
    told = stream.select(
        F.explode(F.array(payload)).alias("_payload"), "value",
        F.coalesce(F.ltrim("value").startswith("{"), F.lit(False)).alias("_object"),
        *_envelope(F.current_timestamp() if consumed_at is None else consumed_at),
    )
    ok = F.col("_object") & F.col(f"_payload.{CORRUPT}").isNull() & F.col("_payload").isNotNull()
    columns = [n for n in told.schema["_payload"].dataType.names if n != CORRUPT]
    return told.select(
        *[F.when(ok, F.col(f"_payload.{c}")).alias(c) for c in columns],
        F.when(~ok, PARSE_FAILED).alias("_error"), F.when(~ok, F.col("value")).alias("_raw"),
        "_kafka_topic", "_kafka_partition", "_kafka_offset", "_consumed_at",
    )


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without error columns, dead letters with the raw text and the envelope)."""
    bad = F.col("_error").isNotNull()
    letters = parsed.filter(bad).select(
        "_error", "_raw", "_kafka_topic", "_kafka_partition", "_kafka_offset", "_consumed_at")
    return parsed.filter(~bad).drop("_error", "_raw"), letters


def event_date(parsed: Column, arrived: Column) -> Column:
    """Date of the event inside the parsed payload, else of its arrival."""
    at = F.coalesce(F.try_variant_get(parsed, "$.order_date", "string"),
                    F.try_variant_get(parsed, "$.event_ts", "string"))
    return F.coalesce(at.try_cast("date"), arrived.cast("date"))


def partition_by_event_date(df: DataFrame, ts_col: str, arrived: str = "_consumed_at") -> DataFrame:
    """Add the event-time partition ``date``; the arrival date stays as a column."""
    return df.withColumns({
        "date": F.coalesce(F.col(ts_col).try_cast("date"), F.col(arrived).cast("date")),
        "arrival_date": F.col(arrived).cast("date"),
    })


def landed_lines(stream: DataFrame, consumed_at: Column | None = None) -> DataFrame:
    """(topic, date, value, offset): one JSON line per message with the envelope inside.

    The payload text is kept as it came, so fields outside any layout survive; only line
    breaks, which JSON allows between its parts alone, become spaces.  Each message is
    parsed once.
    """
    at = F.current_timestamp() if consumed_at is None else consumed_at
    text = F.regexp_replace("value", r"[\r\n]+", " ")
    stream = stream.withColumn("_parsed", F.try_parse_json("value"))
    parsed = F.col("_parsed")
    ok = F.coalesce(parsed.isNotNull() & F.ltrim(text).startswith("{"), F.lit(False))
    meta = F.to_json(F.struct(*_envelope(at)))
    wrapped = F.to_json(F.struct(
        F.lit(PARSE_FAILED).alias("_error"), F.coalesce("value", F.lit("")).alias("_raw"),
        *_envelope(at)))
    open_text = F.regexp_replace(text, r"\}\s*$", "")
    comma = F.when(F.trim(open_text) == "{", "").otherwise(",")
    merged = F.concat(open_text, comma, F.substr(meta, F.lit(2)))
    return stream.select(
        F.col("topic"),
        F.when(ok, event_date(parsed, at)).otherwise(at.cast("date")).alias("date"),
        F.when(ok, merged).otherwise(wrapped).alias("value"),
        F.col("offset"),
    )


FILE_ROWS = 1_000_000


def gathered(
    rows: DataFrame, cols: Sequence[str], offset: str, batch_rows: int, file_rows: int = FILE_ROWS
) -> DataFrame:
    """Bring the rows of each partition value of a micro-batch into few tasks.

    Without it every task writes a file for every date it meets; with a fixed number of
    tasks a busy date would be in too few.  ``batch_rows`` is the most a trigger takes in
    (``maxOffsetsPerTrigger``): a date that holds all of them is cut into pieces of about
    ``file_rows``.  The offset decides the piece, so a retry repeats it.
    """
    pieces = max(1, -(-batch_rows // file_rows))
    return rows.repartition(*cols, F.pmod(F.xxhash64(offset), F.lit(pieces)))


def land_stream(
    stream: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
    consumed_at: Column | None = None, batch_rows: int = FILE_ROWS, packing: dict | None = None,
) -> StreamingQuery:
    """Write the messages as JSON lines under topic=/date=, one flush per micro-batch.

    ``packing`` holds options of the text writer, such as ``compression``; a packed file is read by one
    task, so ``maxRecordsPerFile`` belongs with it.
    """
    lines = gathered(landed_lines(stream, consumed_at), ("topic", "date"), "offset", batch_rows)
    writer = lines.drop("offset").writeStream.format("text").options(**(packing or {})).partitionBy("topic", "date")
    return _start(writer, out, checkpoint, trigger)


def land_table(
    rows: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
    partition_cols: Sequence[str] = (), batch_rows: int = FILE_ROWS,
) -> StreamingQuery:
    """Write a typed stream as Parquet files."""
    if not partition_cols:
        return _start(rows.writeStream.format("parquet"), out, checkpoint, trigger)
    whole = gathered(rows, partition_cols, "_kafka_offset", batch_rows)
    writer = whole.writeStream.format("parquet").partitionBy(*partition_cols)
    return _start(writer, out, checkpoint, trigger)


def _start(writer, out: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    when = trigger or {"processingTime": f"{V.FLUSH_SECONDS} seconds"}
    placed = writer.option("path", out).option("checkpointLocation", checkpoint)
    return placed.outputMode("append").trigger(**when).start()


def stream_totals(landed: DataFrame) -> DataFrame:
    """One row: messages consumed and parse errors, over all that a parsed stream has landed.

    The landed table is the record: it holds each message once whatever the number of
    micro-batches and restarts, while a query keeps only its last progress reports.
    """
    return landed.agg(
        F.count("*").alias("consumed"),
        F.count_if(F.col("_error").isNotNull()).alias("parse_errors"),
    )


def observe_stream(stream: DataFrame, name: str) -> DataFrame:
    """The parsed stream with its counters in each progress report of the query, under ``name``."""
    return stream.observe(name, *_counters())


def _counters() -> list[Column]:
    return [F.count(F.lit(1)).alias("consumed"), F.count_if(F.col("_error").isNotNull()).alias("parse_errors")]


def _metrics_path(out: str, number: int) -> str:
    return f"{out}/metrics/batch={number}"


def land_batches(
    parsed: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
    ts: str | None = None, delay: str = "1 hour",
) -> StreamingQuery:
    """Good rows, late rows, dead letters and counters of a parsed stream, each message parsed once.

    A micro-batch is kept on the executors' disks while ``rows``, ``late``, ``letters`` and, last,
    ``metrics`` are written, each under its batch id: a batch that is run again replaces itself, and
    ``read_batches`` goes by those that are whole.  A row is late if its ``ts`` is more than ``delay``
    before the newest one of all earlier batches, which the metrics of the last batch tell; a
    step with state would drop it.  A row without a time is not late.
    """
    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = batch.persist(StorageLevel.DISK_ONLY)
        try:
            mark = None
            if ts is not None and number > 0:
                mark = spark.read.parquet(_metrics_path(out, number - 1)).first()["newest"]
            good, letters = split_bad(part)
            newest = F.lit(mark).cast("timestamp")
            at = F.lit(None).cast("timestamp") if ts is None else F.col(ts)
            late = F.coalesce(at < newest - F.expr(f"interval {delay}"), F.lit(False))
            counted = part.agg(
                *_counters(), F.count_if(late & F.col("_error").isNull()).alias("late"),
                F.greatest(F.max(at), newest).alias("newest"))
            for name, found in (("rows", good.filter(~late)), ("late", good.filter(late)), ("letters", letters)):
                found.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
            counted.coalesce(1).write.mode("overwrite").parquet(_metrics_path(out, number))
        finally:
            part.unpersist()

    return _start_batches(parsed, put, "append", checkpoint, trigger)


def _start_batches(rows: DataFrame, put, mode: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    when = trigger or {"processingTime": f"{V.FLUSH_SECONDS} seconds"}
    writer = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.outputMode(mode).trigger(**when).start()


def read_batches(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``rows``, ``late``, ``letters`` or ``metrics`` of the whole batches, with the column ``batch``."""
    last = spark.read.parquet(f"{out}/metrics").agg(F.max("batch").alias("n")).first()["n"]
    return spark.read.parquet(f"{out}/{name}").filter(F.col("batch") <= last)


def batch_totals(metrics: DataFrame) -> DataFrame:
    """One row: messages consumed, parse errors and late rows, summed over one line per micro-batch."""
    return metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("consumed", "parse_errors", "late")])


def land_changes(
    changes: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the groups of an aggregate that a micro-batch has changed under its batch id.

    What is written follows the changes, not the table.  ``newest_changes`` gives the table.
    """
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _start_batches(changes, put, "update", checkpoint, trigger)


def newest_changes(changes: DataFrame, *keys: str) -> DataFrame:
    """The last state of each key of the landed changes; combined before the shuffle."""
    rest = [c for c in changes.columns if c not in (*keys, "batch")]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_state"))
    return last.select(*keys, "_state.*")
