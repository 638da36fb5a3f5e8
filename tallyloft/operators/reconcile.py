"""Two copies of a table compared by digests that do not depend on the order of rows.

Keys are hashed into ``COARSE`` ranges of ``FINE`` smaller ones. First each coarse range's rows are counted and their hashes summed and
xor-ed, on both sides; only rows of ranges that differ are digested again by smaller range, and only rows of smaller ranges that differ
are grouped by key. Equal tables cost two scans and a shuffle of a thousand digests; a full outer join would shuffle both tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.session import stage

COARSE, FINE = 1024, 256


def _hash(columns: list[str]) -> Column:
    """NULLs count by place: the hash alone would skip them."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _digests(rows: DataFrame, by: list[str]) -> DataFrame:
    """Count, sum and xor of the row hashes of each side."""
    parts = []
    for side in ("before", "after"):
        mine = F.when(F.col("_side") == side, F.col("_hash"))
        parts += [
            F.count(mine).alias(f"rows_{side}"),
            F.coalesce(F.sum(mine.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"_sum_{side}"),
            F.coalesce(F.bit_xor(mine), F.lit(0)).alias(f"_xor_{side}")]
    same = reduce(Column.__and__, [F.col(f"{p}_before") == F.col(f"{p}_after") for p in ("rows", "_sum", "_xor")])
    return rows.groupBy(*by).agg(*parts).where(~same).select(*by, "rows_before", "rows_after")


def _hashed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    columns = before.columns
    cell = F.pmod(_hash(keys), F.lit(COARSE * FINE)).cast("int")
    sides = [
        df.select(*columns).select(*keys, F.lit(side).alias("_side"), _hash(columns).alias("_hash"), cell.alias("_cell"))
        for side, df in (("before", before), ("after", after))]
    return sides[0].unionAll(sides[1]).withColumn("_range", F.floor(F.col("_cell") / FINE).cast("int"))


def differing_cells(rows: DataFrame) -> DataFrame:
    """The smaller ranges whose digests differ: at most ``COARSE * FINE`` numbers."""
    ranges = stage(_digests(rows, ["_range"]).select("_range"), "ranges")
    inside = rows.join(F.broadcast(ranges), "_range", "left_semi")
    return stage(_digests(inside, ["_cell"]).select("_cell"), "cells")


def reconciled(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows_before, rows_after) of the keys whose rows differ in number or content; copies count, NULL is a key like others.

    Tables of equal rows give no row; ``after`` may have further columns, which are not compared.
    """
    rows = _hashed(before, after, keys)
    inside = rows.join(F.broadcast(differing_cells(rows)), "_cell", "left_semi")
    return _digests(inside, keys)
