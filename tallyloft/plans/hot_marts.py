"""Dashboard marts over the hot item and order tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CENT = "decimal(18,2)"
PPM = 1_000_000


def in_range(items: DataFrame, start: datetime, end: datetime, countries: list[str] | None = None) -> DataFrame:
    """Closed time range and country list; the list prunes partitions of the stored table."""
    picked = items.where(F.col("event_ts").between(F.lit(start), F.lit(end)))
    return picked.where(F.col("store_country").isin(countries)) if countries else picked


def net(items: DataFrame) -> DataFrame:
    """Without cancels and returns."""
    return items.where("is_cancel = 0 AND is_return = 0")


def at(items: DataFrame, **equal) -> DataFrame:
    """Equality lookup, e.g. by city or sales channel."""
    for name, value in equal.items():
        items = items.where(F.col(name) == value)
    return items


def newest(items: DataFrame, n: int, ties: list[str]) -> DataFrame:
    return items.orderBy(F.desc("event_ts"), *ties).limit(n)


def _usd(name: str = "total_sales_usd") -> Column:
    return F.sum(F.col(name).cast(CENT))


def _bucket(width: str, slide: str | None = None) -> Column:
    return F.window("event_ts", width, slide) if slide else F.window("event_ts", width)


def total_revenue(items: DataFrame, start: datetime, end: datetime, countries: list[str] | None = None) -> DataFrame:
    return net(in_range(items, start, end, countries)).agg(_usd().alias("revenue"))


def top_products(
    items: DataFrame, start: datetime, end: datetime, countries: list[str] | None = None, k: int = 10
) -> DataFrame:
    sold = net(in_range(items, start, end, countries)).groupBy("product_name").agg(F.sum("quantity").alias("units"))
    return sold.orderBy(F.desc("units"), "product_name").limit(k)


def revenue_over_time(
    items: DataFrame, start: datetime, end: datetime, countries: list[str] | None = None, width: str = "1 hour"
) -> DataFrame:
    series = net(in_range(items, start, end, countries)).groupBy(_bucket(width).alias("w")).agg(_usd().alias("revenue"))
    return series.select(F.col("w.start").alias("bucket"), "revenue").orderBy("bucket")


def order_ticker(orders: DataFrame, width: str = "1 day") -> DataFrame:
    """Orders and revenue per time bucket."""
    placed = orders.where("event_type = 'ORDER'").groupBy(_bucket(width).alias("w")).agg(
        F.count(F.lit(1)).alias("orders"), _usd("total_order_usd").alias("revenue"))
    return placed.select(F.col("w.start").alias("bucket"), "orders", "revenue")


def payment_mix(orders: DataFrame) -> DataFrame:
    by_method = orders.where("event_type = 'ORDER'").groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("orders"), _usd("total_order_usd").alias("revenue"))
    all_orders, all_revenue = (by_method.agg(F.sum(c)).scalar() for c in ("orders", "revenue"))
    return by_method.select(
        "payment_method", "orders", "revenue",
        (F.col("orders") / all_orders).alias("order_share"),
        F.try_divide(F.col("revenue").cast("double"), all_revenue.cast("double")).alias("revenue_share"))


def return_impact(items: DataFrame, width: str = "1 day") -> DataFrame:
    """Cancels (before delivery) and returns (after it) per bucket, and the revenue each took away."""
    pivoted = (
        items.groupBy(_bucket(width).alias("w")).pivot("event_type", ["CANCEL", "RETURN"])
        .agg(F.count(F.lit(1)).alias("n"), _usd().alias("lost"))
    )
    return pivoted.select(
        F.col("w.start").alias("bucket"),
        F.coalesce("CANCEL_n", F.lit(0)).alias("cancels"),
        F.coalesce("RETURN_n", F.lit(0)).alias("returns"),
        F.coalesce("CANCEL_lost", F.lit(0).cast(CENT)).alias("lost_before_delivery"),
        F.coalesce("RETURN_lost", F.lit(0).cast(CENT)).alias("lost_after_delivery"))


def problem_skus(items: DataFrame, k: int = 20) -> DataFrame:
    bad = (F.col("is_cancel") + F.col("is_return")) > 0
    rated = items.groupBy(F.coalesce("product_name", F.lit("UNKNOWN")).alias("product_name")).agg(
        F.sum("quantity").alias("units"),
        F.sum(F.when(bad, F.col("quantity")).otherwise(0)).alias("bad_units"),
    ).withColumn("bad_rate", F.try_divide(F.col("bad_units").cast("double"), F.col("units").cast("double")))
    return rated.orderBy(F.desc("bad_rate"), F.desc("units"), "product_name").limit(k)


def lag_monitor(items: DataFrame, width: str = "1 day", limit_seconds: int = 5) -> DataFrame:
    """Processing lag per bucket; lags are whole seconds, so percentiles go over (lag, frequency)."""
    counted = items.where("processing_lag IS NOT NULL").groupBy(_bucket(width).alias("w"), "processing_lag").agg(
        F.count(F.lit(1)).alias("n"))
    late = F.sum(F.when(F.col("processing_lag") > limit_seconds, F.col("n")).otherwise(0))
    return counted.groupBy("w").agg(
        F.sum("n").alias("events"),
        F.percentile("processing_lag", 0.5, F.col("n")).alias("p50_lag"),
        F.percentile("processing_lag", 0.95, F.col("n")).alias("p95_lag"),
        F.max("processing_lag").alias("max_lag"),
        (late.cast("double") / F.sum("n")).alias("breach_share"),
    ).select(F.col("w.start").alias("bucket"), "events", "p50_lag", "p95_lag", "max_lag", "breach_share")


def cancel_alerts(
    items: DataFrame, width: str = "6 hours", slide_hours: int = 3, trailing: int = 8, sigmas: float = 2.0
) -> DataFrame:
    """Cancel and return rate per country in sliding windows, against the mean of the ``trailing`` windows before.

    Windows without events have no rate; an alert needs all windows before it.

    Rates are whole parts per million, so the moments are exact integers on any partitioning.
    The trailing window runs over the aggregated rows: one per country and time bucket.
    """
    bad = F.when((F.col("is_cancel") + F.col("is_return")) > 0, 1).otherwise(0)
    rates = items.groupBy(_bucket(width, f"{slide_hours} hours").alias("w"), "store_country").agg(
        F.count(F.lit(1)).alias("events"), F.sum(bad).alias("bad_events"),
    ).select(
        F.col("w.start").alias("window_start"), "store_country", "events", "bad_events",
        F.expr(f"bad_events * {PPM} div events").alias("rate_ppm"))
    step = slide_hours * 3600
    before = Window.partitionBy("store_country").orderBy(F.unix_timestamp("window_start")).rangeBetween(-trailing * step, -step)
    n = F.count("rate_ppm").over(before)
    total = F.sum("rate_ppm").over(before)
    squares = F.sum(F.col("rate_ppm") * F.col("rate_ppm")).over(before)
    moments = rates.withColumns({"_n": n, "_sum": total, "_sq": squares})
    spread = F.sqrt(
        (F.col("_n") * F.col("_sq") - F.col("_sum") * F.col("_sum")).cast("double") / (F.col("_n") * (F.col("_n") - 1)))
    mean = F.col("_sum").cast("double") / F.col("_n")
    known = F.col("_n") == trailing
    return moments.select(
        "window_start", "store_country", "events", "bad_events", "rate_ppm",
        F.when(known, mean).alias("trailing_mean_ppm"),
        F.when(known, spread).alias("trailing_std_ppm"),
        F.when(known & (F.col("rate_ppm") > mean + sigmas * spread), 1).otherwise(0).alias("alert"))
