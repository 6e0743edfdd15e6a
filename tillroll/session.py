"""Session set-up and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # rows per batch do not bound the bytes of long texts
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings that only a new session takes.
STATIC_CONF = {
    # capturing the Python call site of every column costs more than building the plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on (UTC clock, dynamic overwrite, AQE)."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def sizing(shuffled_bytes: int, executor_cores: int, task_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job by the bytes its widest shuffle moves.

    One task per ``task_bytes``, never fewer than two rounds of the cores.  Adaptive
    execution merges what turns out small and splits what turns out skewed.  The driver
    keeps one status per map and reduce task: a job of hundreds of TB is run by date.
    """
    tasks = max(2 * executor_cores, -(-shuffled_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(app: str = "tillroll", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (STATIC_CONF | conf).items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting a single-machine session uses a folder of its application in the
    warehouse, and any other is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    home = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{home}/_scratch/{spark.sparkContext.applicationId}"


_MADE: dict[tuple[str, int], list[str]] = {}     # application and thread -> scratch paths handed out


def _made(spark: SparkSession) -> list[str]:
    """Of this thread only: a job that ends must not delete what one beside it has staged."""
    return _MADE.setdefault((spark.sparkContext.applicationId, threading.get_ident()), [])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made(spark).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete at the end what is staged inside; tables a job has written elsewhere stay.

    When the job fails its staged tables stay as well: they may hold the only copy of
    what a half-done write has replaced.
    """
    made = _made(spark)
    start = len(made)
    yield
    for path in made[start:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    del made[start:]


FAST = "snappy"     # codec for staged rows that are wide and read once or twice


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of executors, and gives the
    planner the real size of the data for its join choices.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
