"""Session settings every job relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only what the results or the skew handling rest on; adaptive execution is on by default, and
# memory, cores and shuffle width belong to whoever starts the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Split a hot join partition even when the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State grows with open orders, so it lives on disk rather than on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Counting a store's rows looks each key up once more before it is written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # The shuffle files of a query go when it ends, not when the driver's heap is next collected: a job is many queries.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# What one task of a batch job takes on at most, so that its sorts and hash maps do not grow with the tables. A cluster's lower
# bounds stay; streams keep the shuffle width they were started with.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 8 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
# Shuffles begin this wide, and adaptive execution joins what is small up to the bytes above.
FIRST_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_WIDTH = 960

# Tables that the engine writes and reads again take a third less room than with snappy.
STORED = "zstd"

_local_scratch: dict[str, str] = {}


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    if int(spark.conf.get(FIRST_WIDTH, None) or 0) < SHUFFLE_WIDTH:
        spark.conf.set(FIRST_WIDTH, str(max(SHUFFLE_WIDTH, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    # Executors of a local-cluster have folders of their own.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tallyloft-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
