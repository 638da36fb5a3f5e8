"""Dashboard marts as continuous queries: windows over windows in one stream, each result final once the watermark has passed.

The first aggregate takes events into short windows; all later ones run over these by their window time, so state and late data are
settled by the events' watermark alone and every step gives up its state as the watermark moves. The same expressions over a plain table
give the same rows. Rows that do not count are left out inside the aggregates, not by a filter: the optimizer would move that below the
watermark, and a quiet hour of cancels would hold back results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.plans.hot_marts import CENT, PPM
from tallyloft.schemas import ORDER_KEYS
from tallyloft.streaming.orders import LATENESS

STEP = "10 minutes"


def _late(items: DataFrame, lateness: str | None) -> DataFrame:
    return items.withWatermark("event_ts", lateness) if items.isStreaming and lateness else items


def _over(width: str, slide: str | None = None) -> Column:
    """Windows over the window ``w`` of the step before."""
    return F.window(F.window_time("w"), width, slide) if slide else F.window(F.window_time("w"), width)


def revenue_over_time(items: DataFrame, width: str = "1 hour", lateness: str | None = LATENESS) -> DataFrame:
    """Net revenue per ``width``, a whole number of steps."""
    sold = (F.col("is_cancel") == 0) & (F.col("is_return") == 0)
    usd = F.sum(F.when(sold, F.col("total_sales_usd").cast(CENT)))
    steps = _late(items, lateness).groupBy(F.window("event_ts", STEP).alias("w")).agg(usd.alias("usd"), F.count_if(sold).alias("n"))
    hours = steps.groupBy(_over(width).alias("v")).agg(F.sum("usd").alias("revenue"), F.sum("n").alias("n"))
    return hours.where("n > 0").select(F.col("v.start").alias("bucket"), F.col("revenue").cast("decimal(28,2)").alias("revenue"))


def order_ticker(events: DataFrame, width: str = "1 day", lateness: str | None = LATENESS) -> DataFrame:
    """Orders and their revenue per ``width``: an order's events, which share a day, are summed and rounded once, then counted."""
    usd = F.round(F.sum(F.col("total_sales_usd").cast("decimal(28,10)")), 2).cast(CENT)
    totals = _late(events, lateness).groupBy(F.window("event_ts", width).alias("w"), *ORDER_KEYS).agg(usd.alias("usd"))
    placed = F.col("event_type") == "ORDER"
    days = totals.groupBy(_over(width).alias("v")).agg(F.count_if(placed).alias("orders"), F.sum(F.when(placed, F.col("usd"))).alias("revenue"))
    return days.where("orders > 0").select(F.col("v.start").alias("bucket"), "orders", F.col("revenue").cast("decimal(28,2)").alias("revenue"))


def cancel_alerts(items: DataFrame, width_hours: int = 6, slide_hours: int = 3, trailing: int = 8, sigmas: float = 2.0,
                  lateness: str | None = LATENESS) -> DataFrame:
    """Cancel and return rate per country in sliding windows, against the mean of the ``trailing`` windows before.

    Three steps: short windows, the sliding windows over them, and windows over those that span ``trailing + 1`` slides. The last
    sliding window in such a span is the one judged, the others are its baseline; a span that lacks its last window yields nothing.
    Rates are whole parts per million, so the moments are exact however the rows arrive.
    """
    bad = F.when((F.col("is_cancel") + F.col("is_return")) > 0, 1).otherwise(0)
    steps = _late(items, lateness).groupBy(F.window("event_ts", STEP).alias("w"), "store_country").agg(
        F.count(F.lit(1)).alias("n"), F.sum(bad).alias("b"))
    sliding = steps.groupBy(_over(f"{width_hours} hours", f"{slide_hours} hours").alias("s"), "store_country").agg(
        F.sum("n").alias("events"), F.sum("b").alias("bad_events"))
    rates = sliding.select(F.col("s").alias("w"), "store_country", "events", "bad_events", F.expr(f"bad_events * {PPM} div events").alias("rate_ppm"))
    judged = F.max_by(F.struct(F.col("w.end").alias("end"), F.col("w.start").alias("window_start"), "events", "bad_events", "rate_ppm"), F.col("w.end"))
    spans = rates.groupBy(_over(f"{(trailing + 1) * slide_hours} hours", f"{slide_hours} hours").alias("v"), "store_country").agg(
        judged.alias("j"), F.count(F.lit(1)).alias("k"), F.sum("rate_ppm").alias("total"), F.sum(F.col("rate_ppm") * F.col("rate_ppm")).alias("squares"))
    rate, n = F.col("j.rate_ppm"), F.lit(trailing)
    total, squares = F.col("total") - rate, F.col("squares") - rate * rate
    mean = total.cast("double") / n
    spread = F.sqrt((n * squares - total * total).cast("double") / (n * (n - 1)))
    known = F.col("k") == trailing + 1
    return spans.where("j.end = v.end").select(
        "j.window_start", "store_country", "j.events", "j.bad_events", "j.rate_ppm",
        F.when(known, mean).alias("trailing_mean_ppm"), F.when(known, spread).alias("trailing_std_ppm"),
        F.when(known & (rate > mean + sigmas * spread), 1).otherwise(0).alias("alert"))
