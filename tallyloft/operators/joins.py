"""Equi-joins of a large side with a side that is unique on the key.

Three ways, picked by size and shape:

* few rows on the unique side (counted, not guessed): broadcast, no shuffle of the large side;
* otherwise a shuffle join, with adaptive skew splitting left on;
* otherwise, when a key holds a notable share of the large side: the rows of that key are
  spread over several salts and the one matching row is repeated once per salt.

Every way returns the same rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 << 20
# For a unique side that grows with the data and is not worth counting.
UNBOUNDED = 1 << 62
# A key is hot from this share on, so at most 1 / HOT_SHARE keys can be hot.
HOT_SHARE = 0.01
SKETCH_ITEMS = 10_000
# Pieces of hot rows per shuffle partition. Shares add up to at most one, so the unique side grows
# by no more than this many rows per partition, however hot the keys are.
PIECES = 8


def _code(keys: list[str]) -> Column:
    """One number per key, NULL when a part of the key is NULL (such a row has no partner)."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(whole, F.xxhash64(*keys))


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> dict[int | None, float]:
    """Codes of the keys holding at least ``share`` of the rows, with their share; NULL counts as a key.

    One pass with a mergeable sketch: nothing is shuffled by the key itself. The answer only
    steers the salting, so an estimate is enough, and two keys sharing a code do no harm.
    """
    most = int(1 / share)
    found = df.select(_code(keys).alias("code")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("code").isNull()).alias("nulls"),
        F.expr(f"approx_top_k(code, {most}, {SKETCH_ITEMS}) FILTER (WHERE code IS NOT NULL)").alias("top"),
    ).first()
    least = max(share * found["n"], 1)
    hot = {t["item"]: t["count"] / found["n"] for t in found["top"] or [] if t["count"] >= least}
    if found["nulls"] >= least:
        hot[None] = found["nulls"] / found["n"]
    return hot


def _codes_agree(big: DataFrame, unique: DataFrame, keys: list[str]) -> bool:
    """Codes are only comparable between columns of one type, and not at all for floating point."""
    kinds = [(big.schema[k].dataType, unique.schema[k].dataType) for k in keys]
    return all(a == b and not isinstance(a, (T.FloatType, T.DoubleType)) for a, b in kinds)


def _salted(
    big: DataFrame, unique: DataFrame, keys: list[str], how: str, hot: dict[int | None, float], row_id: list[str] | None = None
) -> DataFrame:
    width = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.lit(1)
    for code, share in hot.items():
        is_hot = F.col("_code").isNull() if code is None else F.col("_code") == code
        spread = F.when(is_hot, math.ceil(share * width * PIECES) + 1).otherwise(spread)
    # The salt depends on the row's content alone, so a recomputed task sends each row the same way. Columns that tell
    # rows apart do for it; without them it takes all, which keeps them alive and leaves equal rows together.
    salt = F.pmod(F.xxhash64(*(row_id or big.columns)), spread).cast("int")
    left = big.withColumn("_code", _code(keys)).withColumn("_salt", salt).drop("_code")
    right = (
        unique.withColumn("_code", _code(keys)).where("_code IS NOT NULL")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), spread - 1))).drop("_code")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _measured(df: DataFrame) -> tuple[int, int]:
    """Rows, and the bytes of their texts plus the fixed widths of the other columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sizes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    rows, *found = df.agg(F.count(F.lit(1)), *sizes).first()
    return rows, sum(found) + rows * 16 * len(df.columns)


def attach(
    big: DataFrame,
    unique: DataFrame,
    on: str | list[str],
    how: str = "inner",
    rows: int | None = None,
    max_broadcast: int | None = None,
    hot_from: DataFrame | None = None,
    row_id: list[str] | None = None,
) -> DataFrame:
    """Join ``unique`` (one row per key) to ``big``, ``how`` being inner or left.

    ``rows`` is a known upper bound for the unique side; rows and bytes are counted when it is left out.
    ``row_id`` names columns that tell the rows of ``big`` apart, to spread hot keys by.
    ``hot_from`` is a cheaper DataFrame with the same key distribution as ``big``.
    """
    max_broadcast = BROADCAST_ROWS if max_broadcast is None else max_broadcast
    size = 0
    if rows is None:
        rows, size = _measured(unique)
    if rows <= max_broadcast and size <= BROADCAST_BYTES:
        return big.join(F.broadcast(unique), on, how)
    keys = [on] if isinstance(on, str) else list(on)
    if rows < UNBOUNDED:
        # Counted to be too large. A small file or shuffle says little about that, as running numbers compress well.
        unique = unique.hint("merge")
    # A stream cannot be searched for hot keys before it runs; foreachBatch hands over plain tables.
    if not big.isStreaming and _codes_agree(big, unique, keys):
        hot = hot_keys(big if hot_from is None else hot_from, keys)
        if hot:
            return _salted(big, unique, keys, how, hot, row_id)
    return big.join(unique, keys, how)
