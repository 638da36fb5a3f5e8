"""Dense 1..n keys in the order of given columns, without sorting the whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.session import stage

ONE_TASK_ROWS = 200_000
_POSITION_BITS = 33


def dense_key(
    df: DataFrame, order_by: list[str], name: str, rows: int | None = None, one_task_rows: int | None = None, ranged: bool = False
) -> DataFrame:
    """Equal to ``row_number() over (order by ...)``; ``order_by`` must be unique.

    Where ``rows`` is known and small, the plain window does it. Otherwise the rows are
    range-partitioned, sorted inside each partition and written once with (partition, position);
    only the per-partition counts are then needed to turn positions into global numbers.
    Partition and position are read back from the written table, so numbering and counting
    cannot disagree. ``ranged`` says that the partitions of ``df`` are ranges of the first column
    already, in order, with equal values of it in one of them.
    """
    limit = ONE_TASK_ROWS if one_task_rows is None else one_task_rows
    if rows is not None and rows <= limit:
        number = F.row_number().over(Window.orderBy(*order_by)).cast("bigint")
        return df.select(number.alias(name), "*")
    placed = stage(
        (df if ranged else df.repartitionByRange(*order_by)).sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        f"dense-{name}",
    )
    part = F.shiftright("_place", _POSITION_BITS)
    position = F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1)
    # One row per partition of the write: bounded by the shuffle width, not by the data.
    before = (
        placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
        .select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .select((F.col("_before") + position + 1).alias(name), *df.columns)
    )


def ntile_of(position: Column, rows: int, tiles: int) -> Column:
    """Tile of the row at 1-based ``position`` among ``rows``; the first ``rows % tiles`` tiles take one more."""
    size, extra = divmod(rows, tiles)
    wide = extra * (size + 1)
    head = F.floor((position - 1) / (size + 1)) + 1
    if size == 0:
        return head.cast("int")
    tail = F.floor((position - 1 - wide) / size) + 1 + extra
    return F.when(position <= wide, head).otherwise(tail).cast("int")
