"""Exchange rates by day, with the last known rate standing in for a missing day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.functions.scalar import local_amount
from tallyloft.operators.joins import attach


def daily_rates(rates: DataFrame, until: Column) -> DataFrame:
    """One row per currency and day up to ``until``; ``rate_date_used`` says where the rate comes from.

    The window runs over the rate table alone (days of one currency), never over the sales.
    """
    per_currency = Window.partitionBy("currency_code").orderBy("date_key")
    last_day = F.coalesce(F.date_sub(F.lead("date_key").over(per_currency), 1), F.greatest("date_key", until))
    return rates.select(
        "currency_code", "date_key", "rate", last_day.alias("_last")
    ).select(
        "currency_code",
        F.explode(F.sequence("date_key", "_last")).alias("date_key"),
        "rate",
        F.col("date_key").alias("rate_date_used"),
    )


def normalise(lines: DataFrame, daily: DataFrame, usd: list[str], date_col: str = "order_date") -> DataFrame:
    """Attach the rate of the day (or the last one before it) and a local amount per USD column.

    ``daily`` is one row per currency and day, so an equi-join does what an as-of join would.
    """
    rated = attach(lines, daily.withColumnRenamed("date_key", date_col), ["currency_code", date_col], "left")
    return rated.withColumns({
        c.replace("_usd", "_local"): local_amount(F.col(c), F.col("rate")) for c in usd})
