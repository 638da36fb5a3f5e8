"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest. A batch of documents is reduced to one row per digest with
partial aggregation, then a sort-merge anti-join against the index finds the digests that are new, and these are appended. The
bucketed side of the join is never shuffled, so adding a batch costs in proportion to the batch, plus one read of the index.

Defined results: a NULL text counts as the empty text. Of equal texts of a batch, the row with the smallest id stays; a NULL id
comes after all others, and of rows that repeat an id and a text, one stays. An empty batch adds nothing. Columns other than the
id and the text are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloft.llm.common import HOT_SHARE, attach, only, squeezed
from tallyloft.session import scratch_path, stage


def digest(text: Column) -> Column:
    """SHA-256 of the text with each run of ASCII white space as one space."""
    return F.unhex(F.sha2(squeezed(text), 256))


class DigestIndex:
    """Digests seen so far at ``path``; opening an existing path goes on with what is there.

    ``buckets`` must stay the same for one path. Choose it so that one bucket of the final index fits a task, say 200 MB; the default
    is the number of shuffle partitions, so that a shuffle by digest writes one file per task.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.buckets = spark, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or scratch_path(spark, "digests")
        self.name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}, keep_row BIGINT, group_size BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Add a batch; a row per document with id, keep_id, group_size, kept and digest.

        ``keep_id`` is the id of the document that stays for the text and ``group_size`` the number of its copies, both in the
        batch that brought the text first.
        """
        batch = uuid.uuid4().hex
        # Written once: the row number then belongs to the row, also if a task runs again.
        rows = stage(docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"))
                     .withColumn("row", F.monotonically_increasing_id()), "batch-digests")
        groups = stage(rows.groupBy("digest").agg(
            F.min("id").alias("keep_id"), F.coalesce(F.min_by("row", "id"), F.min("row")).alias("keep_row"),
            F.count("*").alias("group_size")), "batch-groups")
        fresh = groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.withColumn("batch", F.lit(batch)).repartition(self.buckets, "digest")
         .select(*self.table().columns).write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)
        total = groups.agg(F.sum("group_size")).first()[0] or 0
        found = attach(rows, self.table(), "digest", groups.filter(F.col("group_size") * HOT_SHARE >= total))
        kept = (F.col("batch") == batch) & (F.col("row") == F.col("keep_row"))
        return found.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "digest")


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = index.add(docs, id_col, text_col).filter("kept").select(F.col(id_col).alias("id"), "digest")
    return only(docs, kept, {"id": F.col(id_col), "digest": digest(F.col(text_col))})
