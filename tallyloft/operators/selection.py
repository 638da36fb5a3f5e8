"""Exact tiles of many measures at once without a sort: counts over ranges that narrow from pass to pass.

Each measure and the key that breaks its ties make one whole number per row, its point. A pass cuts every range that still holds the end
of a tile into ``CELLS`` cells of equal width and counts the rows of each; the cell with the end is the next range. So a pass shuffles and
returns at most ``CELLS`` counts per open end, whatever the table holds, and the number of passes follows from the width of the values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloft.session import stage

CELLS = 1024
POINT = T.DecimalType(38, 0)


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Positions of the last rows of all tiles but the last; the first ``rows % tiles`` tiles take one more."""
    size, extra = divmod(rows, tiles)
    return [i * size + min(i, extra) for i in range(1, tiles)]


def _number(value: int) -> Column:
    return F.lit(Decimal(value)).cast(POINT)


def _whole(df: DataFrame, measure: str) -> Column:
    """The measure in units of its last digit."""
    kind = df.schema[measure].dataType
    if isinstance(kind, T.DecimalType):
        # A precision at which the product loses no digit.
        wide = F.col(measure).cast(T.DecimalType(36 - kind.scale, kind.scale))
        return (wide * F.lit(Decimal(10 ** kind.scale))).cast(POINT)
    if isinstance(kind, T.IntegralType):
        return F.col(measure).cast(POINT)
    raise TypeError(f"{measure}: whole numbers and decimals have tiles, {kind.simpleString()} has not")


def _narrowed(points: DataFrame, ranges: list[tuple[str, int, int]]) -> dict[tuple[int, int], int]:
    """Rows per (range, cell)."""
    def cell(i: int, measure: str, low: int, high: int) -> Column:
        width = -(-(high - low + 1) // CELLS)
        return F.when(F.col(measure).between(_number(low), _number(high)), F.struct(
            F.lit(i).alias("range"), F.call_function("div", F.col(measure) - _number(low), _number(width)).alias("cell")))

    cells = F.filter(F.array(*[cell(i, *r) for i, r in enumerate(ranges)]), lambda c: c.isNotNull())
    counted = points.select(F.inline(cells)).groupBy("range", "cell").agg(F.count(F.lit(1)).alias("n"))
    return {(r.range, r.cell): r.n for r in counted.collect()}


def tiles(df: DataFrame, scores: dict[str, str], key: str, count: int) -> DataFrame:
    """``df`` with ``ntile(count)`` over (measure, key) for each (score, measure) of ``scores``; ``key`` is a unique whole number.

    NULL comes first in measures and key. Measure and key together need at most 38 digits; beyond that the job stops.
    """
    measures = sorted(set(scores.values()))
    whole = df.select("*", *[_whole(df, m).alias(f"_whole_{m}") for m in measures])
    spans = whole.agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"),
        *[f(f"_whole_{m}").alias(f"{name}_{m}") for m in measures for name, f in (("min", F.min), ("max", F.max))]).first()
    if not spans.rows:
        return df.select("*", *[F.lit(None).cast("int").alias(s) for s in scores])
    first = (spans.low or 0) - 1
    keys = (spans.high or 0) - first + 1
    at = F.coalesce(F.col(key).cast(POINT), _number(first)) - _number(first)
    lowest = {m: int(spans[f"min_{m}"] or 0) - 1 for m in measures}
    highest = {m: int(spans[f"max_{m}"] or 0) for m in measures}
    points = stage(whole.select(*df.columns, *[
        ((F.coalesce(f"_whole_{m}", _number(lowest[m])) * _number(keys)).cast(POINT) + at).cast(POINT).alias(f"_point_{m}")
        for m in measures]), "points")

    ends = tile_ends(spans.rows, count)
    # Per (measure, end): the range that holds it, and the rows before that range.
    open_ends = {(m, end): (lowest[m] * keys, highest[m] * keys + keys - 1, 0) for m in measures for end in ends if end}
    bounds = {}
    while open_ends:
        ranges = sorted({(f"_point_{m}", low, high) for (m, _), (low, high, _) in open_ends.items()})
        counts, still = _narrowed(points, ranges), {}
        for (m, end), (low, high, before) in open_ends.items():
            i, width, cell = ranges.index((f"_point_{m}", low, high)), -(-(high - low + 1) // CELLS), 0
            while before + counts.get((i, cell), 0) < end:
                before += counts.get((i, cell), 0)
                cell += 1
            inside = low + cell * width, min(low + cell * width + width - 1, high)
            if before + counts[i, cell] == end or inside[0] == inside[1]:
                bounds[m, end] = inside[1]
            else:
                still[m, end] = (*inside, before)
        open_ends = still

    def score(m: str) -> Column:
        over = [(F.col(f"_point_{m}") > _number(bounds[m, end])).cast("int") for end in ends if end]
        empty = sum(1 for end in ends if not end)
        return sum(over, F.lit(1 + empty)).cast("int")

    return points.select(*df.columns, *[score(m).alias(s) for s, m in scores.items()])
