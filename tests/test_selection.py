from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloft.operators import selection

SCHEMA = "k bigint, money decimal(29,2), few int, x string"


def rows(n: int, seed: int = 1):
    draw = random.Random(seed)
    return [(None if i == 3 else i * 7 - 50, None if i % 41 == 5 else Decimal(draw.randrange(-10**12, 10**12)) / 100, draw.randrange(3), "x")
            for i in range(n)]


@pytest.mark.parametrize("n", [1, 3, 5, 7, 500, 3001])
def test_tiles_equal_ntile(spark, n):
    df = spark.createDataFrame(rows(n), SCHEMA)
    got = selection.tiles(df, {"a": "money", "b": "few"}, "k", 5)
    for score, measure in (("a", "money"), ("b", "few")):
        got = got.withColumn(f"want_{score}", F.ntile(5).over(Window.orderBy(measure, "k")))
    assert got.count() == n and got.where("a <> want_a OR b <> want_b OR a IS NULL OR b IS NULL").count() == 0


def test_no_rows_and_no_sort(spark):
    assert selection.tiles(spark.createDataFrame([], SCHEMA), {"a": "money"}, "k", 5).columns == ["k", "money", "few", "x", "a"]
    plan = selection.tiles(spark.createDataFrame(rows(100), SCHEMA), {"a": "money"}, "k", 4)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan and "Window" not in plan and "Exchange" not in plan


def test_a_pass_returns_a_bounded_number_of_counts(spark, monkeypatch):
    sizes, inner = [], selection._narrowed
    monkeypatch.setattr(selection, "_narrowed", lambda points, ranges: sizes.append(inner(points, ranges)) or sizes[-1])
    selection.tiles(spark.createDataFrame(rows(3001), SCHEMA), {"a": "money", "b": "few"}, "k", 5)
    assert all(len(s) <= 8 * selection.CELLS for s in sizes) and len(sizes) <= 6


def test_measures_without_order_in_digits_are_refused(spark):
    with pytest.raises(TypeError, match="string"):
        selection.tiles(spark.createDataFrame(rows(3), SCHEMA), {"a": "x"}, "k", 5)
