"""Marts over the gold layer. Each aggregates first and attaches descriptions to the small result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.functions.scalar import sales_channel
from tallyloft.operators.joins import attach
from tallyloft.operators.selection import tiles
from tallyloft.plans import sketches
from tallyloft.session import stage

AGE_BANDS = [(25, "under 25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST_BAND = "65 and over"


def _double(column: str) -> Column:
    return F.col(column).cast("double")


def _share(column: str, total: Column) -> Column:
    return F.try_divide(_double(column), total.cast("double"))


def _ratio(top: str, bottom: str) -> Column:
    return F.try_divide(_double(top), _double(bottom))


def _with_days(fact: DataFrame, date: DataFrame, rows: int | None, row_id: list[str]) -> DataFrame:
    days = date.select("date_sk", "date_key")
    ordered = days.select(F.col("date_sk").alias("order_date_fk"), F.col("date_key").alias("order_date"))
    delivered = days.select(F.col("date_sk").alias("delivery_date_fk"), F.col("date_key").alias("delivery_date"))
    rows = days.count() if rows is None else rows
    fact = attach(fact, ordered, "order_date_fk", rows=rows, row_id=row_id)
    return attach(fact, delivered, "delivery_date_fk", "left", rows=rows, row_id=row_id)


def published_orders(fact: DataFrame, date: DataFrame, stores: DataFrame, rows: dict[str, int] | None = None) -> DataFrame:
    """The order fact with days and natural keys in place of its foreign keys: what the order marts take."""
    rows = rows or {}
    dated = _with_days(fact, date, rows.get("date"), ["order_sk"])
    placed = attach(dated, stores.select(F.col("store_sk").alias("store_fk"), "store_key"), "store_fk", rows=rows.get("store"), row_id=["order_sk"])
    return placed.withColumnsRenamed({"order_number_bk": "order_number", "customer_fk": "customer_key"})


def published_products(
    fact: DataFrame, date: DataFrame, stores: DataFrame, products: DataFrame, rows: dict[str, int] | None = None
) -> DataFrame:
    """The product fact likewise, with the descriptions of its products."""
    rows = rows or {}
    dated = _with_days(fact, date, rows.get("date"), ["product_sale_sk"])
    placed = attach(dated, stores.select(F.col("store_sk").alias("store_fk"), "store_key"), "store_fk",
                    rows=rows.get("store"), row_id=["product_sale_sk"])
    described = products.select(F.col("product_sk").alias("product_fk"), "product_key", "product_name", "brand", "category")
    whole = attach(placed, described, "product_fk", rows=rows.get("product"), row_id=["product_sale_sk"])
    return whole.withColumnsRenamed({"order_number_bk": "order_number", "customer_fk": "customer_key", "p_quantity": "quantity"})


def all_marts(orders: DataFrame, products: DataFrame, stores: DataFrame, customers: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Every mart over the published gold tables, by name."""
    return {
        "mart_shipping": shipping(orders, stores),
        "mart_revenue_quarter_category": revenue_by_quarter_category(products),
        "mart_aov_margin": order_value_and_margin(orders),
        "mart_top_brands": top_brands(products),
        "mart_demographics": demographics(orders, customers, as_of),
        "mart_store_performance": store_performance(orders, stores),
        "mart_channel_geo": channel_geography(orders, stores),
        "mart_rfm": rfm(orders, as_of),
        "mart_clv": lifetime_value(orders, as_of),
        "mart_product_mix": product_mix(products),
        "customer_reach_daily": sketches.reach_sketches(orders, stores),
    }


def shipping(orders: DataFrame, stores: DataFrame, store_rows: int | None = None) -> DataFrame:
    """Days from order to delivery by store country."""
    waits = (
        orders.where("delivery_date IS NOT NULL")
        .groupBy("store_key", F.datediff("delivery_date", "order_date").alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_country = attach(waits, stores.select("store_key", "country"), "store_key", rows=store_rows)
    # Percentiles over (value, frequency) pairs: exact, and bounded by the number of distinct waits.
    return by_country.groupBy("country").agg(
        F.sum("n").alias("delivered_orders"),
        (F.sum(F.col("days") * F.col("n")).cast("double") / F.sum("n")).alias("avg_days"),
        F.percentile("days", 0.5, F.col("n")).alias("p50_days"),
        F.percentile("days", 0.95, F.col("n")).alias("p95_days"),
    )


def revenue_by_quarter_category(products: DataFrame) -> DataFrame:
    """Revenue per quarter and category with growth on the quarter before (NULL without one), plus quarter and year totals."""
    leaves = products.groupBy(
        F.year("order_date").alias("year"), F.quarter("order_date").alias("quarter"), "category"
    ).agg(F.sum("total_price_usd").alias("revenue"))
    number = F.col("year") * 4 + F.col("quarter")
    before = F.sum("revenue").over(Window.partitionBy("category").orderBy(number).rangeBetween(-1, -1))
    grown = leaves.withColumn("growth", F.try_divide(
        (F.col("revenue") - before).cast("double"), before.cast("double")))
    return grown.rollup("year", "quarter", "category").agg(
        F.sum("revenue").alias("revenue"),
        F.when(F.grouping_id() == 0, F.max("growth")).alias("growth"),
        F.grouping_id().cast("int").alias("level"),
    )


def order_value_and_margin(orders: DataFrame) -> DataFrame:
    yearly = orders.groupBy(F.year("order_date").alias("year")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_price_usd").alias("revenue"),
        F.sum("total_profit_usd").alias("profit"),
    )
    return yearly.select(
        "year", "orders", "revenue", "profit",
        _ratio("revenue", "orders").alias("avg_order_value"),
        _ratio("profit", "revenue").alias("profit_margin"))


def top_brands(products: DataFrame) -> DataFrame:
    """Brands ranked inside their category, with their share of the category and of everything."""
    brands = products.groupBy("category", "brand").agg(
        F.sum("total_price_usd").alias("revenue"), F.sum("quantity").alias("units"))
    by_revenue = Window.partitionBy("category").orderBy(F.desc("revenue"), "brand")
    return brands.select(
        "category", "brand", "revenue", "units",
        F.row_number().over(by_revenue).cast("bigint").alias("brand_rank"),
        _share("revenue", F.sum("revenue").over(Window.partitionBy("category"))).alias("category_share"),
        _share("revenue", brands.agg(F.sum("revenue")).scalar()).alias("total_share"))


def age_band(birthday: Column, as_of: Column) -> Column:
    years = F.floor(F.months_between(as_of, birthday) / 12)
    band = F.when(birthday.isNull(), "unknown")
    for upper, label in AGE_BANDS:
        band = band.when(years < upper, label)
    return band.otherwise(OLDEST_BAND)


def demographics(orders: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """Customers and revenue by age band and country, with all subtotals."""
    spent = orders.groupBy("customer_key").agg(
        F.sum("total_price_usd").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    people = customers.select(
        "customer_key", F.col("country"), age_band(F.col("birthday"), as_of).alias("age_band"))
    # Both sides hold one row per customer, so no key is hot any more.
    return people.join(spent, "customer_key").cube("age_band", "country").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.grouping_id().cast("int").alias("level"),
    )


def store_performance(orders: DataFrame, stores: DataFrame, store_rows: int | None = None) -> DataFrame:
    per_store = orders.groupBy("store_key").agg(
        F.sum("total_price_usd").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    placed = attach(per_store, stores.select("store_key", "country", "square_meters"), "store_key", rows=store_rows)
    region = Window.partitionBy("country")
    return placed.select(
        "store_key", "country", "orders", "revenue",
        _ratio("revenue", "square_meters").alias("revenue_per_m2"),
        F.rank().over(region.orderBy(F.desc("revenue"))).cast("bigint").alias("best_rank"),
        F.rank().over(region.orderBy("revenue")).cast("bigint").alias("worst_rank"))


def channel_geography(orders: DataFrame, stores: DataFrame, store_rows: int | None = None) -> DataFrame:
    per_store = orders.groupBy("store_key").agg(
        F.sum("total_price_usd").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    placed = attach(per_store, stores.select("store_key", "country"), "store_key", rows=store_rows)
    grouped = placed.groupBy(sales_channel(F.col("store_key")).alias("sales_channel"), "country").agg(
        F.count(F.lit(1)).alias("stores"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    return grouped.withColumn("revenue_share", _share("revenue", grouped.agg(F.sum("revenue")).scalar()))


def customer_activity(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_key").agg(
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("total_price_usd").alias("monetary"),
        F.sum("total_profit_usd").alias("profit"),
    )


def rfm(orders: DataFrame, as_of: Column) -> DataFrame:
    """Exact fifths of recency, frequency and monetary value; ties go by customer key."""
    age = F.datediff(as_of, "last_order")
    people = stage(
        customer_activity(orders).select("customer_key", age.alias("recency_days"), "frequency", "monetary", (-age).alias("_freshness")),
        "rfm")
    scored = tiles(people, {"r_score": "_freshness", "f_score": "frequency", "m_score": "monetary"}, "customer_key", 5)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "champion")
        .when((r >= 3) & (f >= 3), "loyal")
        .when((r >= 4) & (f <= 2), "new")
        .when((r <= 2) & (f >= 3), "at risk")
        .when((r <= 2) & (f <= 2), "lost")
        .otherwise("regular")
    )
    return scored.select(
        "customer_key", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        segment.alias("segment"))


def lifetime_value(orders: DataFrame, as_of: Column, horizon_days: int = 3 * 365) -> DataFrame:
    """Margin to date and the same daily margin carried on over the horizon."""
    activity = customer_activity(orders).withColumn(
        "tenure_days", F.greatest(F.datediff(as_of, "first_order"), F.lit(1)))
    daily = F.col("profit").cast("double") / F.col("tenure_days")
    return activity.select(
        "customer_key", "tenure_days", "frequency",
        F.col("monetary").alias("revenue"), F.col("profit").alias("margin"),
        (F.col("profit").cast("double") + daily * horizon_days).alias("clv"))


def product_mix(products: DataFrame) -> DataFrame:
    return products.groupBy("product_key", "product_name", "category").agg(
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_price_usd").alias("revenue"),
        F.sum("total_profit_usd").alias("profit"))
