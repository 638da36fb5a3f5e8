"""Order-level aggregation of the event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.functions.scalar import EXACT
from tallyloft.schemas import ORDER_KEYS

LATENESS = "10 minutes"


def _cents(name: str) -> Column:
    """Sums run on exact decimals, so the total does not depend on the order of arrival, and are rounded once."""
    return F.round(F.sum(F.col(name).cast(EXACT)), 2).cast("double")


def _measures() -> list[Column]:
    return [
        F.sum("quantity").alias("total_items_count"),
        _cents("line_total_amount").alias("total_order_local"),
        _cents("total_sales_usd").alias("total_order_usd"),
        F.max("is_return").alias("is_return_flag"),
        F.max("is_cancel").alias("is_cancel_flag"),
        F.max("processing_lag").alias("max_lag_seconds"),
        F.max("event_ts").alias("last_update"),
    ]


def _late(events: DataFrame, lateness: str | None) -> DataFrame:
    """No ``lateness``: the events, as ``once`` leaves them, have their watermark."""
    return events.withWatermark("event_ts", lateness) if events.isStreaming and lateness else events


def running(events: DataFrame, lateness: str | None = LATENESS) -> DataFrame:
    """Totals that keep growing, for update mode. The keys hold no time, so state is never given up."""
    source = _late(events, lateness)
    return source.groupBy(*ORDER_KEYS).agg(*_measures())


def windowed(events: DataFrame, width: str = "10 minutes", lateness: str | None = LATENESS) -> DataFrame:
    """Totals per time window: final once the watermark has passed, and then dropped from the state."""
    source = _late(events, lateness)
    totals = source.groupBy(F.window("event_ts", width).alias("w"), *ORDER_KEYS).agg(*_measures())
    return totals.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         *[c for c in totals.columns if c != "w"])


def sessions(events: DataFrame, gap: str = "1 hour", lateness: str | None = LATENESS) -> DataFrame:
    """Totals per order while its events follow within ``gap``: final, one row an order, and dropped from the state after that."""
    source = _late(events, lateness)
    totals = source.groupBy(F.session_window("event_ts", gap).alias("w"), *ORDER_KEYS).agg(*_measures())
    return totals.select(F.col("w.start").alias("first_event"), *[c for c in totals.columns if c != "w"])


def once(
    events: DataFrame, keys: list[str] = ("order_serial", "event_type"), lateness: str = LATENESS, salts: int = 1
) -> DataFrame:
    """Drop repeated deliveries; state is kept for the lateness only.

    With ``salts`` copies are first dropped per (key, salt), the salt following the input partition, and then per key. That
    doubles the state and is worth it only for messages that are delivered over and over. Any salt gives the same result.
    """
    keys = list(keys)
    late = events.withWatermark("event_ts", lateness)
    if salts > 1:
        spread = late.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        late = spread.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return late.dropDuplicatesWithinWatermark(keys)
