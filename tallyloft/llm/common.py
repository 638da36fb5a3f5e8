"""Helpers shared by the corpus operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is hot when it holds at least one row in HOT_SHARE; so at most HOT_SHARE keys are, whatever the size of the table.
HOT_SHARE = 1000

WHITE = r"[\x20\x09-\x0D]+"
# The same runs without those that are one space already: replacing these by a space has the same effect and fewer matches.
WHITE_ODD = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def squeezed(text: Column) -> Column:
    """NULL as the empty text, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_ODD, " ")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def attach(rows: DataFrame, facts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with one row of ``facts`` per ``key``.

    ``hot`` lists the keys that hold at least one row in HOT_SHARE, at most HOT_SHARE of them by construction. Their facts
    are broadcast, so that a key with a third of all rows stays where its rows are; all other keys are joined by a shuffle.
    """
    hot = F.broadcast(hot.select(key))
    few = F.broadcast(facts.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_anti").join(facts, key).unionByName(rows.join(few, key))


def only(docs: DataFrame, kept: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` (name in ``kept``: expression over ``docs``) are in ``kept``, one row for each.

    NULL keys are equal to each other. The keys of documents are nearly unique, so neither side of the join is skewed.
    """
    names = {name: f"__{i}_key" for i, name in enumerate(keys)}
    keyed = docs.withColumns({names[n]: e for n, e in keys.items()})
    right = kept.select(*(F.col(n).alias(f"{names[n]}_kept") for n in keys))
    on = [F.col(names[n]).eqNullSafe(F.col(f"{names[n]}_kept")) for n in keys]
    return keyed.join(right, on, "left_semi").dropDuplicates(list(names.values())).drop(*names.values())


def sampled(rows: DataFrame, code: Column, most: int) -> DataFrame:
    """The rows with the ``most`` smallest different values of ``code``, one row each: only codes are sorted and compared."""
    coded = rows.withColumn("__code", code)
    last = coded.select("__code").distinct().orderBy("__code").limit(most).agg(F.max("__code")).first()[0]
    return coded.filter(F.col("__code") <= last).dropDuplicates(["__code"]).drop("__code")


def shared(context: SparkContext, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size with its class; tasks get it by a call."""
    packed, held = context.broadcast(cloudpickle.dumps(value)), []

    def get() -> Any:
        if not held:
            held.append(pickle.loads(packed.value))
        return held[0]

    return get
