"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.operators.keys import dense_key
from tallyloft.sources.bronze import date_spine

# National holidays as (country, month, day, name).
HOLIDAYS = [
    ("US", 1, 1, "US - New Year's Day"),
    ("US", 7, 4, "US - Independence Day"),
    ("US", 12, 25, "US - Christmas"),
    ("UK", 1, 1, "UK - New Year's Day"),
    ("UK", 12, 25, "UK - Christmas"),
    ("NL", 1, 1, "NL - New Year's Day"),
    ("NL", 4, 27, "NL - King's Day"),
    ("FR", 1, 1, "FR - New Year's Day"),
    ("FR", 7, 14, "FR - Bastille Day"),
    ("DE", 10, 3, "DE - Unity Day"),
    ("IT", 6, 2, "IT - Republic Day"),
    ("CA", 7, 1, "CA - Canada Day"),
    ("AU", 1, 26, "AU - Australia Day"),
]
HOLIDAY_COUNTRIES = list(dict.fromkeys(rule[0] for rule in HOLIDAYS))

# First day of the standard calendar and the day it stops before.
CALENDAR_START, CALENDAR_END = "2015-01-01", "2021-12-31"


def customer_columns(silver: DataFrame) -> DataFrame:
    return silver.select("customer_key", "name", "gender", "city", "state", "country", "continent", "birthday")


def product_columns(silver: DataFrame) -> DataFrame:
    return silver.select(
        "product_key", "product_name", "brand",
        F.col("unit_cost").alias("unit_cost_usd"), F.col("unit_price").alias("unit_price_usd"),
        "subcategory_key", "subcategory", "category_key", "category")


def store_columns(silver: DataFrame) -> DataFrame:
    return silver.select("store_key", "state", "country", "square_meters", "open_date")


def rate_columns(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("currency").alias("currency_code"),
        F.col("currency").alias("currency_name"),
        F.col("rate_day").alias("date_key"),
        F.col("exchange_rate_usd").alias("rate"),
        "rate_date")


def customer(silver: DataFrame, rows: int | None = None) -> DataFrame:
    return dense_key(customer_columns(silver), ["customer_key"], "customer_sk", rows)


def product_info(silver: DataFrame, rows: int | None = None) -> DataFrame:
    return dense_key(product_columns(silver), ["product_key"], "product_sk", rows)


def stores(silver: DataFrame, rows: int | None = None) -> DataFrame:
    return dense_key(store_columns(silver), ["store_key"], "store_sk", rows)


def exchange_rates(silver: DataFrame, rows: int | None = None) -> DataFrame:
    """Keys follow the calendar."""
    return dense_key(rate_columns(silver), ["date_key", "currency_code"], "exchange_sk", rows).drop("rate_date")


def exchange_rates_compat(silver: DataFrame, rows: int | None = None) -> DataFrame:
    """Keys follow the day-first text of the date, so they are not chronological."""
    return dense_key(rate_columns(silver), ["rate_date", "currency_code"], "exchange_sk", rows).drop("rate_date")


def standard_bounds(any_df: DataFrame) -> DataFrame:
    return any_df.sparkSession.sql(f"SELECT DATE'{CALENDAR_START}' AS start, DATE'{CALENDAR_END}' AS end")


def _rules() -> Column:
    return F.array(*[
        F.struct(F.lit(c).alias("country"), F.lit(m).alias("month"), F.lit(d).alias("day"), F.lit(n).alias("name"))
        for c, m, d, n in HOLIDAYS])


def _holidays_of(day: str) -> Column:
    return F.filter(_rules(), lambda r: (r["month"] == F.month(day)) & (r["day"] == F.dayofmonth(day)))


def _date_parts(day: str) -> list[Column]:
    return [
        F.year(day).alias("year"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"), F.quarter(day).alias("quarter")]


def date(bounds: DataFrame) -> DataFrame:
    """One row per day, with the names of all holidays that fall on it."""
    names = F.array_sort(F.transform(_holidays_of("date_key"), lambda r: r["name"]))
    return (
        date_spine(bounds)
        .withColumn("holiday_names", names)
        .select("date_sk", "date_key", *_date_parts("date_key"),
                (F.size("holiday_names") > 0).cast("int").alias("is_holiday"), "holiday_names")
    )


def holiday(bounds: DataFrame) -> DataFrame:
    """One row per (day, country) holiday."""
    return date_spine(bounds).select("date_key", F.inline(_holidays_of("date_key"))).select(
        "date_key", "country", F.col("name").alias("holiday_name"))


def date_compat(bounds: DataFrame) -> DataFrame:
    """One row per day and holiday country, the name NULL on most of them; ``date_sk`` counts these rows."""
    countries = F.array(*[F.lit(c) for c in HOLIDAY_COUNTRIES])
    n = len(HOLIDAY_COUNTRIES)
    fanned = date_spine(bounds).select("date_sk", "date_key", F.posexplode(countries).alias("pos", "country"))
    # A country has at most one holiday on a day.
    name = F.try_element_at(
        F.filter(_holidays_of("date_key"), lambda r: r["country"] == F.col("country")), F.lit(1))["name"]
    return fanned.withColumn("holiday_name", name).select(
        ((F.col("date_sk") - 1) * n + F.col("pos") + 1).cast("bigint").alias("date_sk"),
        "date_key", *_date_parts("date_key"),
        F.col("holiday_name").isNotNull().cast("int").alias("is_holiday"), "holiday_name")
