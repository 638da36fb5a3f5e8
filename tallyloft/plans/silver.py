"""Silver layer: cleaned and renamed copies of the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloft.functions.scalar import expensive_flag, money, parse_date
from tallyloft.operators.clean import fill_nulls, first_per_key, trim_strings
from tallyloft.schemas import RATE

SALES_KEY = ["order_number", "line_item"]
CUSTOMER_DEFAULTS = {"gender": "UNKNOWN", "city": "Unknown", "state": "Unknown", "country": "Unknown", "continent": "UNKNOWN"}


def customers(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("customerkey").alias("customer_key"),
        F.upper("gender").alias("gender"),
        "name", "city", "state_code", "state", "zip_code", "country",
        F.upper("continent").alias("continent"),
        F.to_date("birthday").alias("birthday"),
    )


def products(bronze: DataFrame) -> DataFrame:
    cost, price = money(F.col("unit_cost_usd")), money(F.col("unit_price_usd"))
    return bronze.select(
        F.col("productkey").alias("product_key"),
        "product_name", "brand",
        F.upper("color").alias("color"),
        cost.alias("unit_cost"),
        price.alias("unit_price"),
        expensive_flag(price).alias("expensive_flag"),
        F.col("subcategorykey").alias("subcategory_key"),
        "subcategory",
        F.col("categorykey").alias("category_key"),
        "category",
    )


def sales(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_number", "line_item",
        F.to_date("order_date").alias("order_date"),
        F.to_date("delivery_date").alias("delivery_date"),
        F.col("customerkey").alias("customer_key"),
        F.col("storekey").alias("store_key"),
        F.col("productkey").alias("product_key"),
        "quantity", "currency_code",
    )


def stores(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("storekey").alias("store_key"),
        "country", "state", "square_meters",
        F.date_format("open_date", "dd-MM-yy").alias("open_date"),
    )


def exchange_rates(bronze: DataFrame) -> DataFrame:
    """The rate stays decimal, so local amounts are exact; ``rate_date`` is the old text, ``rate_day`` the date itself."""
    day = parse_date(F.col("rate_date"), "MM/dd/yyyy")
    return bronze.select(
        F.date_format(day, "dd-MM-yy").alias("rate_date"),
        day.alias("rate_day"),
        F.upper("currency").alias("currency"),
        F.col("exchange").cast(RATE).alias("exchange_rate_usd"),
    )


MODELS = {
    "customers": customers, "products": products, "sales": sales,
    "stores": stores, "exchange_rates": exchange_rates,
}


def sales_once(silver_sales: DataFrame) -> DataFrame:
    """One row per (order, line): the earliest delivered, then smallest product and quantity."""
    rest = [c for c in silver_sales.columns if c not in SALES_KEY]
    undelivered = F.col("delivery_date").isNull()
    order = ["_undelivered", "delivery_date", "product_key", "quantity", "customer_key", "store_key",
             "currency_code", "order_date"]
    ranked = silver_sales.withColumn("_undelivered", undelivered)
    return first_per_key(ranked, SALES_KEY, order).select(*SALES_KEY, *rest)


def cleaned(name: str, model: DataFrame) -> DataFrame:
    """Trimmed text and blanks as NULL in every model; the agreed defaults where there are some."""
    return customers_clean(model) if name == "customers" else trim_strings(model)


def customers_clean(silver_customers: DataFrame) -> DataFrame:
    """Trimmed text, blanks as NULL, then the agreed defaults."""
    return fill_nulls(trim_strings(silver_customers), CUSTOMER_DEFAULTS)
