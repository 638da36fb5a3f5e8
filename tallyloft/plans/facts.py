"""Gold facts: order grain and product-in-order grain.

The default facts sum at their documented grain. The ``_compat`` facts keep the older rules,
where the greatest shipment or line stands for the whole order.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloft.functions.scalar import local_amount, margin
from tallyloft.operators import joins
from tallyloft.operators.joins import attach
from tallyloft.operators.keys import dense_key
from tallyloft.schemas import TOTAL
from tallyloft.session import stage

ORDER_COLS = ["order_number", "customer_key", "store_key", "currency_code", "order_date"]
ORDER_IDENTITY = ["order_number_bk", "order_date_fk", "store_fk", "customer_fk", "currency_code"]
PRODUCT_IDENTITY = ["order_number_bk", "product_fk", "order_date_fk", "store_fk", "customer_fk", "local_currency"]


@dataclass
class Star:
    """What the facts are built from.

    ``rows`` holds upper bounds for the dimension sizes. ``hot_from`` names, per key, a narrow table
    with the key distribution of the sales, for when looking for hot keys in the sales costs too much.
    ``apart`` says that the sales are read from files, where the lines of an order do not lie together.
    ``shared`` says that both facts are built: what their lines take from large dimensions is then written once for both.
    """

    sales: DataFrame
    product: DataFrame
    store: DataFrame
    customer: DataFrame
    rates: DataFrame
    date: DataFrame
    rows: dict[str, int | None]
    hot_from: dict[str, DataFrame] = field(default_factory=dict)
    apart: bool = False
    shared: bool = False

    def keys_of(self, key: str) -> DataFrame:
        return self.hot_from.get(key, self.sales)

    @cached_property
    def hot_orders(self) -> bool:
        return bool(joins.hot_keys(self.keys_of("order_number"), ["order_number"]))

    def small(self, *names: str) -> bool:
        return all(n is not None and n <= joins.BROADCAST_ROWS for n in map(self.rows.get, names))

    @cached_property
    def in_ranges(self) -> bool:
        """Ranges of orders hold from the lines to the fact: no order is hot, and no dimension shuffles them."""
        return self.small("product", "store", "customer", "rates", "date") and not self.hot_orders

    @cached_property
    def in_late_ranges(self) -> bool:
        """Ranges of orders hold once the lines have met products and customers: no order is hot, and no other dimension shuffles them."""
        return self.small("store", "rates", "date") and not self.hot_orders

    @cached_property
    def orders_in_ranges(self) -> bool:
        """Whether the rows of the order fact lie in ranges of orders: its lines travel only where the products are many."""
        return not self.small("product") and self.in_late_ranges

    @cached_property
    def met_lines(self) -> DataFrame:
        return stage(_met_lines(self, "line_item"), "met-lines")


def _product_grain(star: Star) -> DataFrame:
    """Lines summed per (order, product): the widest pre-aggregation both facts can share."""
    return star.sales.groupBy(*ORDER_COLS, "product_key").agg(
        F.sum("quantity").alias("quantity"),
        F.count(F.lit(1)).alias("line_count"),
        F.max("line_item").alias("max_line_item"),
        F.max("delivery_date").alias("delivery_date"),
    )


def _to_product(df: DataFrame, product: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    return attach(df, product, "product_key", how,
                  rows=star.rows.get("product"), hot_from=star.keys_of("product_key"), row_id=["order_number"])


def _product_joined(grain: DataFrame, star: Star, *extra: str) -> DataFrame:
    return _to_product(grain, star.product.select("product_key", "unit_cost_usd", "unit_price_usd", *extra), star)


def _priced(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_cost_usd": (F.col("unit_cost_usd") * F.col("quantity")).cast(TOTAL),
        "total_price_usd": (F.col("unit_price_usd") * F.col("quantity")).cast(TOTAL),
    })


def _with_product(grain: DataFrame, star: Star, *extra: str) -> DataFrame:
    return _priced(_product_joined(grain, star, *extra))


def _with_store(df: DataFrame, star: Star) -> DataFrame:
    return attach(df, star.store.select("store_key", "store_sk"), "store_key",
                  rows=star.rows.get("store"), hot_from=star.keys_of("store_key"), row_id=["order_number"])


def _to_customer(df: DataFrame, customer: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    return attach(df, customer, "customer_key", how,
                  rows=star.rows.get("customer"), hot_from=star.keys_of("customer_key"), row_id=["order_number"])


def _with_customer(df: DataFrame, star: Star) -> DataFrame:
    return _to_customer(df, star.customer.select("customer_key", "customer_sk"), star)


def _copies(dim: DataFrame, key: str, own: str) -> DataFrame:
    """Numbers the rows of one key, in the order of the dimension's ``own`` key."""
    return dim.where(F.col(key).isNotNull()).withColumn("_copy", F.row_number().over(Window.partitionBy(key).orderBy(own)))


def _counting(df: DataFrame) -> DataFrame:
    """Of the copies of a line that a left join with ``_copies`` made, the first keeps its ``line_count``; so does a line without a match."""
    first = F.coalesce(F.col("_copy") == 1, F.lit(True))
    return df.withColumn("line_count", F.when(first, F.col("line_count")).otherwise(0)).drop("_copy")


def _with_rate(df: DataFrame, star: Star, how: str = "left") -> DataFrame:
    """The rate and its surrogate key in one join."""
    rates = star.rates.select("currency_code", F.col("date_key").alias("order_date"), "rate", "exchange_sk")
    return attach(df, rates, ["currency_code", "order_date"], how, rows=star.rows.get("rates"), row_id=["order_number"])


def _with_line_count(df: DataFrame, per_order: DataFrame, star: Star) -> DataFrame:
    return attach(df, per_order, "order_number", rows=joins.UNBOUNDED, hot_from=star.keys_of("order_number"))


def _with_dates(df: DataFrame, star: Star) -> DataFrame:
    """The calendar twice: order date (required) and delivery date (optional)."""
    days = star.date.select("date_key", "date_sk")
    ordered = days.select(F.col("date_key").alias("order_date"), F.col("date_sk").alias("order_date_fk"))
    delivered = days.select(F.col("date_key").alias("delivery_date"), F.col("date_sk").alias("delivery_date_fk"))
    df = attach(df, ordered, "order_date", "inner", rows=star.rows.get("date"), row_id=["order_number"])
    return attach(df, delivered, "delivery_date", "left", rows=star.rows.get("date"), row_id=["order_number"])


def _counted_grain(star: Star) -> DataFrame:
    """The product grain with the lines of its order. Lines without an order number are left out.

    Lines that lie together by order give both in one shuffle, or in none where the sales come from a join by order; what travels is a line.
    Where all dimensions are broadcast, the lines go into ranges of orders, which then serve for the key as well.
    Where an order is hot, lines are summed before they travel, and the count is joined to the written grain.
    """
    sales = star.sales.where(F.col("order_number").isNotNull())
    if star.in_ranges:
        sales = sales.repartitionByRange("order_number")
    elif star.hot_orders:
        grain = stage(_product_grain(replace(star, sales=sales)), "product-grain")
        per_order = grain.groupBy("order_number").agg(F.sum("line_count").alias("total_line_items"))
        return _with_line_count(grain, per_order, star)
    elif star.apart:
        sales = sales.repartition("order_number")
    grain = _product_grain(replace(star, sales=sales))
    return grain.withColumn("total_line_items", F.sum("line_count").over(Window.partitionBy("order_number")))


def _sold_lines(star: Star, *extra: str) -> DataFrame:
    """Single lines with their customer, one row for each of several, NULL in place of an unknown one.

    Where many customers need a shuffle, it comes first: the lines of an order, which lie together or near, stay so and take little room.
    """
    sales = star.sales.select(*ORDER_COLS, "product_key", "quantity", "delivery_date", F.lit(1).alias("line_count"), *extra)
    return _counting(_to_customer(sales, _copies(star.customer.select("customer_key", "customer_sk"), "customer_key", "customer_sk"), star, "left"))


def _met_lines(star: Star, *extra: str) -> DataFrame:
    """The same with their product: all that the facts take from the dimensions that may need a shuffle."""
    product = star.product.select("product_key", "unit_cost_usd", "unit_price_usd", "product_sk")
    sold = _sold_lines(star, *extra)
    return _counting(_to_product(sold, _copies(product, "product_key", "product_sk"), star, "left")).drop("product_key")


def _late_grain(star: Star) -> DataFrame:
    """The product grain with the lines of its order, and all that products and customers give to it, in ranges of orders.

    Single lines travel, to their customer, to their product and into ranges, which serve for grain, line count and key. An order counts all its
    lines, so those without a product or customer, and no others for those with several, stay until then.
    """
    lines = (star.met_lines if star.shared else _met_lines(star)).where(F.col("order_number").isNotNull())
    grain = lines.repartitionByRange("order_number").groupBy(*ORDER_COLS, "customer_sk", "product_sk", "unit_cost_usd", "unit_price_usd").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_count").alias("line_count"), F.max("delivery_date").alias("delivery_date"))
    total = F.sum("line_count").over(Window.partitionBy("order_number"))
    return grain.withColumn("total_line_items", total).where("customer_sk IS NOT NULL AND product_sk IS NOT NULL")


def _late_orders(star: Star) -> DataFrame:
    """Orders with their customer, in ranges of them: single lines travel, not their sums."""
    if star.shared:
        lines = star.met_lines.where("customer_sk IS NOT NULL AND product_sk IS NOT NULL").drop("line_count")
    else:
        lines = _product_joined(_with_customer(_raw_lines(star).drop("line_count"), star), star)
    ranged = lines.repartitionByRange("order_number").withColumn("line_count", F.lit(1)).withColumnRenamed("line_item", "max_line_item")
    return _summed(_priced(ranged), "customer_sk")


def _lines(star: Star) -> DataFrame:
    """Order lines ready for pricing.

    Where the product dimension is broadcast, pricing needs no shuffle and the raw lines go straight
    into the order aggregate. Otherwise the lines are summed per (order, product) before they travel.
    """
    rows = star.rows.get("product")
    if rows is None or rows > joins.BROADCAST_ROWS:
        return _product_grain(star)
    return _raw_lines(star)


def _raw_lines(star: Star) -> DataFrame:
    return star.sales.select(
        *ORDER_COLS, "product_key", "quantity", F.lit(1).alias("line_count"),
        F.col("line_item").alias("max_line_item"), "delivery_date")


def _summed(lines: DataFrame, *extra: str) -> DataFrame:
    """Priced lines by order."""
    return lines.groupBy(*ORDER_COLS, *extra).agg(
        F.max("max_line_item").alias("number_of_items"),
        F.sum("line_count").alias("line_count"),
        F.max("delivery_date").alias("delivery_date"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_cost_usd").cast(TOTAL).alias("total_cost_usd"),
        F.sum("total_price_usd").cast(TOTAL).alias("total_price_usd"),
    )


def order_measures(star: Star) -> DataFrame:
    """One row per order, natural and surrogate foreign keys, no own surrogate key yet."""
    if star.orders_in_ranges:
        orders = _late_orders(star)
    else:
        orders = _with_customer(_summed(_with_product(_lines(star), star)), star)
    keyed = _with_dates(_with_rate(_with_store(orders, star), star), star)
    return keyed.withColumns({
        "total_profit_usd": F.col("total_price_usd") - F.col("total_cost_usd"),
        "total_cost_local": local_amount(F.col("total_cost_usd"), F.col("rate")),
        "total_price_local": local_amount(F.col("total_price_usd"), F.col("rate")),
    }).withColumn("total_profit_local", F.col("total_price_local") - F.col("total_cost_local"))


def order_rows(star: Star, *extra: str) -> DataFrame:
    """The order fact without its key; ``extra`` carries columns of ``order_measures`` along."""
    return order_measures(star).select(
        F.col("order_number").alias("order_number_bk"), "number_of_items", "line_count",
        "order_date_fk", "delivery_date_fk",
        F.col("store_sk").alias("store_fk"),
        F.col("customer_key").alias("customer_fk"), "customer_sk",
        F.col("exchange_sk").alias("exchange_rate_fk"),
        "total_quantity", "total_cost_usd", "total_price_usd", "total_profit_usd",
        "total_cost_local", "total_price_local", "total_profit_local", "currency_code", *extra,
    )


def order_fact(star: Star) -> DataFrame:
    return dense_key(order_rows(star), ORDER_IDENTITY, "order_sk", ranged=star.orders_in_ranges)


def product_measured(df: DataFrame) -> DataFrame:
    """The measures of the product grain, from quantity, unit prices and rate; made last, so that no shuffle carries them."""
    return _priced(df).withColumns({
        "total_profit_usd": F.col("total_price_usd") - F.col("total_cost_usd"),
        "total_cost_local": local_amount(F.col("total_cost_usd"), F.col("rate")),
        "total_price_local": local_amount(F.col("total_price_usd"), F.col("rate")),
        "profit_margin": margin(F.col("unit_cost_usd"), F.col("unit_price_usd")),
    }).withColumn("total_profit_local", F.col("total_price_local") - F.col("total_cost_local"))


def _product_keyed(grain: DataFrame, star: Star, *product_cols: str) -> DataFrame:
    lines = _product_joined(grain, star, *product_cols)
    return _with_dates(_with_rate(_with_customer(_with_store(lines, star), star), star), star)


def product_measures(star: Star, *product_cols: str) -> DataFrame:
    """One row per (order, product); ``product_cols`` carries product attributes along for the marts."""
    return product_measured(_product_keyed(_product_grain(star), star, *product_cols))


def product_parts(star: Star, *extra: str) -> DataFrame:
    """What ``product_rows`` are made of: all their foreign keys, and in place of the measures the five columns they follow from."""
    if star.in_late_ranges and not star.in_ranges:
        keyed = _with_dates(_with_rate(_with_store(_late_grain(star), star), star), star)
    else:
        keyed = _product_keyed(_counted_grain(star), star, "product_sk")
    return keyed.select(
        F.col("order_number").alias("order_number_bk"), "total_line_items",
        "order_date_fk", "delivery_date_fk",
        F.col("store_sk").alias("store_fk"),
        F.col("customer_key").alias("customer_fk"), "customer_sk",
        F.col("product_sk").alias("product_fk"),
        F.col("exchange_sk").alias("exchange_fk"),
        "quantity", "unit_cost_usd", "unit_price_usd", "rate", F.col("currency_code").alias("local_currency"), *extra,
    )


def product_columns(parts: DataFrame, *extra: str) -> DataFrame:
    """The product fact's columns from its parts; ``extra`` names further columns to keep."""
    kept = [c for c in parts.columns if c == "product_sale_sk"]
    return product_measured(parts).select(
        *kept, "order_number_bk", "total_line_items", "order_date_fk", "delivery_date_fk", "store_fk", "customer_fk", "customer_sk",
        "product_fk", "exchange_fk", F.col("quantity").alias("p_quantity"),
        "total_cost_usd", "total_price_usd", "total_profit_usd",
        "total_cost_local", "total_price_local", "total_profit_local",
        "profit_margin", "local_currency", *extra,
    )


def product_rows(star: Star, *extra: str) -> DataFrame:
    """The product fact without its key."""
    return product_columns(product_parts(star, *extra), *extra)


def product_fact(star: Star) -> DataFrame:
    return product_columns(dense_key(product_parts(star), PRODUCT_IDENTITY, "product_sale_sk", ranged=star.in_late_ranges))


def members(star: Star) -> list[tuple[DataFrame, list[str], list[str]]]:
    """What the facts take from the dimensions, to tell which months must be loaded again: rows, their key, and its columns in the sales."""
    rates, days = star.rates.select("currency_code", "date_key", "rate", "exchange_sk"), star.date.select("date_key", "date_sk")
    return [
        (star.product.select("product_key", "unit_cost_usd", "unit_price_usd", "product_sk"), ["product_key"], ["product_key"]),
        (star.store.select("store_key", "store_sk"), ["store_key"], ["store_key"]),
        (star.customer.select("customer_key", "customer_sk"), ["customer_key"], ["customer_key"]),
        (rates, ["currency_code", "date_key"], ["currency_code", "order_date"]),
        (days, ["date_key"], ["order_date"]), (days, ["date_key"], ["delivery_date"])]


def _compat_dates(star: Star) -> Star:
    """Facts see the greatest ``date_sk`` of a day, so the fanned-out calendar is collapsed first."""
    day = star.date.groupBy("date_key").agg(F.max("date_sk").alias("date_sk"))
    return replace(star, date=day)


def order_fact_compat(star: Star) -> DataFrame:
    """Totals per delivery date, of which the greatest stands for the order."""
    star = _compat_dates(star)
    lines = _with_store(_with_product(star.sales, star), star)
    shipments = lines.groupBy(*ORDER_COLS, "store_sk", "delivery_date").agg(
        F.max("line_item").alias("max_line_item"),
        F.sum("quantity").alias("quantity"),
        F.sum("total_cost_usd").cast(TOTAL).alias("total_cost_usd"),
        F.sum("total_price_usd").cast(TOTAL).alias("total_price_usd"),
    )
    keyed = _with_dates(_with_rate(_with_customer(shipments, star), star), star).withColumns({
        "total_cost_local": local_amount(F.col("total_cost_usd"), F.col("rate")),
        "total_price_local": local_amount(F.col("total_price_usd"), F.col("rate")),
    })
    fact = keyed.groupBy(
        F.col("order_number").alias("order_number_bk"),
        F.col("store_sk").alias("store_fk"),
        F.col("customer_key").alias("customer_fk"),
        F.col("exchange_sk").alias("exchange_rate_fk"),
        "currency_code",
    ).agg(
        F.max("max_line_item").alias("number_of_items"),
        F.max("order_date_fk").alias("order_date_fk"),
        F.max("delivery_date_fk").alias("delivery_date_fk"),
        F.max("quantity").alias("total_quantity"),
        F.max("total_cost_usd").alias("total_cost_usd"),
        F.max("total_price_usd").alias("total_price_usd"),
        (F.max("total_price_usd") - F.max("total_cost_usd")).alias("total_profit_usd"),
        F.max("total_cost_local").alias("total_cost_local"),
        F.max("total_price_local").alias("total_price_local"),
        (F.max("total_price_local") - F.max("total_cost_local")).alias("total_profit_local"),
    )
    return dense_key(
        fact, ["order_number_bk", "store_fk", "customer_fk", "exchange_rate_fk", "currency_code"], "order_sk")


def _compat_in_ranges(star: Star) -> DataFrame:
    """Rows of the compat product fact without key and local amounts, in ranges of orders: single lines travel, and nothing after them."""
    by_product = [*ORDER_COLS, "product_key"]
    product = star.product.select("product_key", "unit_cost_usd", "unit_price_usd", "product_sk")
    sold = _sold_lines(star).where(F.col("order_number").isNotNull())
    lines = _to_product(sold, product, star).repartitionByRange("order_number").distinct()
    rated = _with_rate(_with_store(_priced(lines), star), star, "inner")
    # All lines with a product, store and rate count, also those whose customer or day is unknown.
    counted = rated.withColumn("total_line_items", F.sum("line_count").over(Window.partitionBy("order_number"))).where("customer_sk IS NOT NULL")
    return _collapsed(_with_dates(counted, star), by_product, "customer_sk", "total_line_items")


def _compat_by_joins(star: Star) -> DataFrame:
    """The same where an order is hot or another dimension needs a shuffle."""
    by_product = [*ORDER_COLS, "product_key"]
    groups = star.sales.select(*by_product, "delivery_date", "quantity").distinct()
    lines = _with_rate(_with_store(_with_product(groups, star, "product_sk"), star), star, "inner")
    per_order = lines.groupBy("order_number").agg(F.count(F.lit(1)).alias("total_line_items"))
    return _with_line_count(_with_customer(_collapsed(_with_dates(lines, star), by_product), star), per_order, star)


def _collapsed(lines: DataFrame, by_product: list[str], *extra: str) -> DataFrame:
    return lines.groupBy(*by_product, "product_sk", "store_sk", "exchange_sk", "rate", *extra).agg(
        F.max("order_date_fk").alias("order_date_fk"),
        F.max("delivery_date_fk").alias("delivery_date_fk"),
        F.max("quantity").alias("p_quantity"),
        F.max("total_cost_usd").alias("total_cost_usd"),
        F.max("total_price_usd").alias("total_price_usd"),
        F.max(margin(F.col("unit_cost_usd"), F.col("unit_price_usd"))).alias("profit_margin"),
    )


def product_fact_compat(star: Star) -> DataFrame:
    """Equal lines collapse, the greatest of the rest stands for the product; lines without a rate are left out."""
    star = _compat_dates(star)
    keyed = _compat_in_ranges(star) if star.in_late_ranges else _compat_by_joins(star)
    parts = keyed.select(
        F.col("order_number").alias("order_number_bk"), "total_line_items",
        "order_date_fk", "delivery_date_fk",
        F.col("store_sk").alias("store_fk"),
        F.col("customer_key").alias("customer_fk"),
        F.col("product_sk").alias("product_fk"),
        F.col("exchange_sk").alias("exchange_fk"),
        "p_quantity", "total_cost_usd", "total_price_usd", "rate", "profit_margin", F.col("currency_code").alias("local_currency"),
    )
    fact = dense_key(
        parts, ["order_number_bk", "product_fk", "store_fk", "customer_fk", "exchange_fk", "order_date_fk", "local_currency"],
        "product_sale_sk", ranged=star.in_late_ranges)
    # Differences and local amounts are made last, so that they are not written with the parts.
    cost_local = local_amount(F.col("total_cost_usd"), F.col("rate"))
    price_local = local_amount(F.col("total_price_usd"), F.col("rate"))
    return fact.select(
        "product_sale_sk", "order_number_bk", "total_line_items", "order_date_fk", "delivery_date_fk", "store_fk", "customer_fk",
        "product_fk", "exchange_fk", "p_quantity", "total_cost_usd", "total_price_usd",
        (F.col("total_price_usd") - F.col("total_cost_usd")).alias("total_profit_usd"),
        cost_local.alias("total_cost_local"), price_local.alias("total_price_local"),
        (price_local - cost_local).alias("total_profit_local"), "profit_margin", "local_currency",
    )
