from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyloft.operators import joins
from tallyloft.operators.keys import dense_key, ntile_of
from tallyloft.session import stage


def test_dense_key_equals_row_number(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("a"), F.col("id").alias("b"))
    got = dense_key(df, ["a", "b"], "sk")
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("a", "b")).cast("bigint"))
    assert got.columns == ["sk", "a", "b"]
    assert got.exceptAll(want.select("sk", "a", "b")).count() == 0
    assert got.selectExpr("min(sk)", "max(sk)", "count(DISTINCT sk)").first() == (1, 5000, 5000)


def test_dense_key_range_plan_uses_no_global_sort(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    numbered = dense_key(df, ["k"], "sk")
    plan = numbered._jdf.queryExecution().toString()
    assert "Window" in plan and "windowspecdefinition(k" not in plan
    small = dense_key(df, ["k"], "sk", rows=1000)
    assert small.exceptAll(numbered).count() == 0


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0).withColumnRenamed("id", "k"), ["k"], "sk").count() == 0


@pytest.mark.parametrize("rows,tiles", [(1, 5), (4, 5), (5, 5), (13, 5), (100, 5), (101, 7)])
def test_ntile(spark, rows, tiles):
    df = spark.range(1, rows + 1).withColumn("want", F.ntile(tiles).over(Window.orderBy("id")))
    assert df.where(ntile_of(F.col("id"), rows, tiles) != F.col("want")).count() == 0


def _skewed(spark):
    return spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 500).alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_all_join_ways_agree(spark, how):
    big = _skewed(spark)
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = big.join(dim, "k", how)
    broadcast = joins.attach(big, dim, "k", how)
    salted = joins.attach(big, dim, "k", how, max_broadcast=0)
    for got in (broadcast, salted):
        assert sorted(got.columns) == sorted(want.columns)
        assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_composite_and_mixed_type_keys(spark):
    big = _skewed(spark).withColumn("c", F.lit("x"))
    dim = spark.range(400).select(F.col("id").alias("k"), F.lit("x").alias("c"), (F.col("id") * 2).alias("v"))
    want = big.join(dim, ["k", "c"], "left")
    got = joins.attach(big, dim, ["k", "c"], "left", max_broadcast=0)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    narrow = dim.withColumn("k", F.col("k").cast("int"))
    got = joins.attach(big, narrow, ["k", "c"], "left", max_broadcast=0)
    assert got.where("v IS NOT NULL").count() == want.where("v IS NOT NULL").count() and got.count() == want.count()


def test_hot_keys_found_and_spread(spark):
    big = _skewed(spark)
    hot = joins.hot_keys(big, ["k"])
    seven = spark.range(7, 8).select(F.xxhash64("id")).first()[0]
    assert set(hot) == {seven, None} and all(0.3 < share < 0.4 for share in hot.values())
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, salted = (
            j.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            for j in (big.join(dim, "k", "left"), joins.attach(big, dim, "k", "left", max_broadcast=0)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plain >= 10_000 and salted < 0.7 * plain


def test_equal_rows_of_a_hot_key_spread_by_row_id_and_keep_the_scan_narrow(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS row_no", "7L AS k", "'same' AS a", "'wide' AS b").write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = joins.hot_keys(big, ["k"])
    joined = joins._salted(big, dim, ["k"], "inner", hot, ["row_no"])
    plan = joined.select("v")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<row_no:bigint,k:bigint>", plan)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in joins._salted(big, dim, ["k"], "inner", hot, ["row_no"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and len(sizes) >= 6 and max(sizes) < 8_000


def test_broadcast_is_bounded_in_bytes(spark, monkeypatch):
    dim = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    assert joins._measured(dim) == (100, 100 * 1000 + 100 * 32)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.attach(spark.range(1000).withColumnRenamed("id", "k"), dim, "k")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan


def test_hot_keys_of_text_even_and_no_rows(spark):
    names = spark.range(1000).select(F.concat(F.lit("c"), F.col("id") % 2).alias("k"))
    assert sorted(joins.hot_keys(names, ["k"]).values()) == [0.5, 0.5]
    assert joins.hot_keys(spark.range(1000).withColumnRenamed("id", "k"), ["k"]) == {}
    assert joins.hot_keys(names.limit(0), ["k"]) == {}


def test_a_side_counted_as_too_large_is_not_broadcast(spark, tmp_path):
    # Running numbers take next to no room in a file, from which its size would be guessed.
    spark.range(2000).selectExpr("id AS k", "id + 1 AS v").write.parquet(str(tmp_path / "side"))
    side, big = spark.read.parquet(str(tmp_path / "side")), spark.range(5000).selectExpr("id % 2500 AS k", "id")
    for how, rows in (("inner", 4000), ("left", 5000)):
        joined = joins.attach(big, side, "k", how, rows=joins.BROADCAST_ROWS + 1)
        plan = joined._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert joined.count() == rows


def test_shuffle_files_go_with_their_query_and_written_rows_stay(spark, tmp_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {p.name for folder in folders for p in Path(folder).rglob("shuffle_*.data")}

    before = shuffled()
    written = stage(spark.range(20_000).repartition(16, "id").groupBy(F.col("id") % 100).count(), "grouped")
    for _ in range(100):
        if not shuffled() - before:
            break
        spark.range(1).count()
    assert not shuffled() - before and written.agg(F.sum("count")).first()[0] == 20_000
    assert {p.name.rsplit(".", 2)[1] for p in Path(re.sub("^file:", "", written.inputFiles()[0]).replace("//", "/")).parent.glob("*.parquet")} == {"zstd"}
    # A result that is asked for twice is made again where its shuffle is gone.
    counted = spark.range(1000).repartition(4, "id").groupBy("id").count()
    assert len(counted.collect()) == len(counted.collect()) == 1000
