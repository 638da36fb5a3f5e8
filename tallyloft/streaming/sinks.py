"""Sinks: topics, hourly archive, dead letters, and versioned upsert tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallyloft.operators.clean import latest_per_key

ARCHIVE_PARTS = ["year", "month", "day", "hour"]


def with_hour_parts(df: DataFrame, when: Column) -> DataFrame:
    return df.withColumns(dict(zip(ARCHIVE_PARTS, [F.year(when), F.month(when), F.dayofmonth(when), F.hour(when)])))


def archive(
    stream: DataFrame, path: str, checkpoint: str, when: Column, trigger: dict | None = None, max_records: int = 1_000_000
) -> DataStreamWriter:
    """Raw messages as snappy Parquet, one folder per UTC hour."""
    return (
        with_hour_parts(stream, when).writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*ARCHIVE_PARTS)
        .trigger(**(trigger or {"processingTime": "40 minutes"}))
    )


def parquet(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def topic(messages: DataFrame, servers: str, name: str, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Needs the Kafka connector on the classpath."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", name)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )


def _newest(spark: SparkSession, path: str, schema: str, by: str):
    """The row with the greatest ``by`` in a table that may not exist yet."""
    rows = _read(spark, path, schema)
    return rows.agg(F.max_by(F.struct(*rows.columns), by)).first()[0] if rows is not None else None


def _read(spark: SparkSession, path: str, schema, base_path: str | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base_path) if base_path else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class UpsertTable:
    """Last write wins per key, on plain Parquet: a base, and the batches written since.

    Every micro-batch goes to its own folder ``run_id=<r>/batch_id=<n>``, below ``since=<base>`` once there is one, and overwrites that
    folder, so a replayed batch leaves the same table behind. A new checkpoint counts batches
    from zero again, hence the run id, which must grow from run to run.

    After ``fold_every`` batches the writer folds them into the next base, bucketed and sorted by key. A read sorts the
    few batches since then by key and merges them with the base, whose rows stay in their buckets; it lists no batch that the base
    holds. The row that names the newest base is written last, so a fold that broke off leaves the table as it was.
    """

    def __init__(
        self, path: str, keys: list[str], partition: str = "store_country", order: str = "event_ts",
        fold_every: int = 16, buckets: int | None = None,
    ):
        self.path, self.keys, self.partition, self.order = path, keys, partition, order
        self.fold_every, self.buckets = fold_every, buckets

    def _base(self, spark: SparkSession):
        """number, run_id, batch_id, buckets of the newest base; it holds all batches up to that one."""
        found = _newest(spark, f"{self.path}/bases", "number int, run_id long, batch_id long, buckets int", "number")
        return found or Row(number=0, run_id=-1, batch_id=-1, buckets=0)

    def _root(self, base) -> str:
        return f"{self.path}/since={base.number}" if base.number else self.path

    def _written(self, spark: SparkSession, base) -> set[tuple[int, int]]:
        """The batches since the base, from the names of their files alone."""
        root = self._root(base)
        rows = _read(spark, f"{root}/run_id=*/batch_id=*", "run_id long", root)
        names = [re.search(r"/run_id=(-?\d+)/batch_id=(-?\d+)/", f) for f in (rows.inputFiles() if rows is not None else [])]
        return {(int(n[1]), int(n[2])) for n in names}

    def write(self, batch: DataFrame, run_id: int, batch_id: int) -> None:
        spark = batch.sparkSession
        base = self._base(spark)
        if (run_id, batch_id) <= (base.run_id, base.batch_id):
            return  # a replay of what the base holds
        newest = [c for c in batch.columns if c not in self.keys]
        # Whole countries per task where they are small, as many tasks as its size asks for where one is heavy.
        (
            latest_per_key(batch, self.keys, [self.order, *[c for c in newest if c != self.order]])
            .hint("rebalance", self.partition)
            .sortWithinPartitions(self.partition, F.desc(self.order))
            .write.mode("overwrite")
            .partitionBy(self.partition)
            .parquet(f"{self._root(base)}/run_id={run_id}/batch_id={batch_id}")
        )
        if len(self._written(spark, base)) >= self.fold_every:
            self.fold(spark, batch.schema)

    def sink(self, run_id: int, prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
        """For ``foreachBatch``."""
        return lambda batch, batch_id: self.write(prepare(batch), run_id, batch_id)

    def _key(self) -> Column:
        """One text per key, no NULL in it, so that buckets and joins are by one plain column."""
        return F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in self.keys])

    def versions(self, spark: SparkSession, row_schema: T.StructType) -> DataFrame:
        """The rows of the batches since the base."""
        schema = T.StructType(row_schema.fields + [
            T.StructField("run_id", T.LongType()), T.StructField("batch_id", T.LongType())])
        root = self._root(self._base(spark))
        rows = _read(spark, f"{root}/run_id=*/batch_id=*", schema, root)
        return spark.createDataFrame([], schema) if rows is None else rows

    def _base_rows(self, spark: SparkSession, row_schema: T.StructType, base) -> DataFrame:
        """The base as a table, which is how Spark knows of its buckets; the catalog entry is made anew where a session lacks it."""
        name = self._table_name(base.number)
        if not spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in row_schema.fields if f.name != self.partition)
            kind = row_schema[self.partition].dataType.simpleString()
            spark.sql(f"CREATE TABLE {name} ({fields}, _key STRING, `{self.partition}` {kind}) USING parquet PARTITIONED BY (`{self.partition}`) "
                      f"CLUSTERED BY (_key) SORTED BY (_key) INTO {base.buckets} BUCKETS LOCATION '{self.path}/base={base.number}'")
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return spark.table(name)

    def _table_name(self, number: int) -> str:
        return f"upserts_{hashlib.md5(self.path.encode()).hexdigest()}_{number}"

    def latest(self, spark: SparkSession, row_schema: T.StructType, countries: list[str] | None = None) -> DataFrame:
        """Current rows; a country list prunes folders before the rows are compared."""
        base = self._base(spark)
        rows = self.versions(spark, row_schema)
        picked = (lambda df: df.where(F.col(self.partition).isin(countries))) if countries else (lambda df: df)
        fresh = latest_per_key(picked(rows), self.keys, ["run_id", "batch_id", self.order]).drop("run_id", "batch_id")
        if not base.number:
            return fresh
        held = picked(self._base_rows(spark, row_schema, base))
        kept = held.join(fresh.select(self._key().alias("_key")), "_key", "left_anti")
        return kept.select(*fresh.columns).unionByName(fresh)

    def fold(self, spark: SparkSession, row_schema: T.StructType) -> None:
        """The current rows as the next base. Its buckets are as many as shuffle partitions, and one task writes a bucket."""
        base = self._base(spark)
        covered = max(self._written(spark, base), default=(base.run_id, base.batch_id))
        buckets, number = self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), base.number + 1
        name, rows = self._table_name(number), self.latest(spark, row_schema).withColumn("_key", self._key())
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # left by a fold that broke off
        (rows.repartition(buckets, "_key").write.format("parquet").mode("overwrite").partitionBy(self.partition)
         .bucketBy(buckets, "_key").sortBy("_key").option("path", f"{self.path}/base={number}").saveAsTable(name))
        done = spark.createDataFrame([(number, *covered, buckets)], "number int, run_id long, batch_id long, buckets int")
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/bases")

    def compact(self, spark: SparkSession, row_schema: T.StructType, path: str) -> UpsertTable:
        """The current rows as the first batch of a new table; the old one is left to its readers."""
        fresh = UpsertTable(path, self.keys, self.partition, self.order, self.fold_every, self.buckets)
        fresh.write(self.latest(spark, row_schema), 0, 0)
        return fresh


def write_dead_letters(rejected: DataFrame, path: str, batch_id: int) -> None:
    rejected.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
