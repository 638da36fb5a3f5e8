"""Null handling, trimming and deduplication for the silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_strings(df: DataFrame, blank_to_null: bool = True) -> DataFrame:
    """Trim every string column; text that is only blanks becomes NULL."""
    done = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            text = F.trim(F.col(field.name))
            done[field.name] = F.nullif(text, F.lit("")) if blank_to_null else text
    return df.withColumns(done)


def fill_nulls(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``newest`` columns.

    An aggregate rather than a window: copies of a hot key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*newest))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], oldest: list[str]) -> DataFrame:
    """One row per key: the one with the least ``oldest`` columns."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*oldest))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)
