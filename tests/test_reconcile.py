from __future__ import annotations

from pyspark.sql import functions as F

from tallyloft.operators import reconcile


def test_equal_to_the_join_on_planted_defects(spark):
    before = spark.range(20_000).select("id", (F.col("id") % 3).alias("part"), F.when(F.col("id") % 5 > 0, F.lit("v")).alias("v"), F.lit(None).cast("string").alias("w"))
    after = before.where("id <> 17").unionAll(before.where("id = 40")).withColumns({
        "v": F.when(F.col("id") == 99, "other").otherwise(F.col("v")),
        # A value that moves to the next column is a change, though the hash skips NULL.
        "w": F.when(F.col("id") == 101, F.col("v"))})
    after = after.withColumn("v", F.when(F.col("id") != 101, F.col("v")))
    got = {tuple(r) for r in reconcile.reconciled(before, after.withColumn("more", F.lit(1)), ["id", "part"]).collect()}
    assert got == {(17, 2, 1, 0), (40, 1, 1, 2), (99, 0, 1, 1), (101, 2, 1, 1)}
    assert reconcile.reconciled(before, before.repartition(5), ["id"]).count() == 0


def test_swapped_copies_and_null_keys(frame):
    schema = "k int, v string"
    before = frame(schema, (1, "a"), (1, "b"), (None, "n"), (2, "x"), (2, "x"))
    assert reconcile.reconciled(before, frame(schema, (2, "x"), (1, "b"), (None, "n"), (1, "a"), (2, "x")), ["k"]).count() == 0
    got = {tuple(r) for r in reconcile.reconciled(before, frame(schema, (1, "a"), (1, "a"), (2, "x"), (2, "x"), (0, "n")), ["k"]).collect()}
    assert got == {(1, 2, 2), (None, 1, 0), (0, 0, 1)}
    nothing = frame(schema)
    assert reconcile.reconciled(nothing, nothing, ["k"]).count() == 0


def test_only_rows_of_differing_ranges_are_grouped_by_key(spark):
    before = spark.range(100_000).withColumn("v", F.lit(1))
    rows = reconcile._hashed(before, before.where("id NOT IN (5, 70000)"), ["id"])
    cells = reconcile.differing_cells(rows)
    assert cells.count() == 2
    assert rows.join(cells, "_cell", "left_semi").count() < 20
    plan = reconcile.reconciled(before, before, ["id"])._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan
