"""The two processed streams as (key, JSON value) messages, and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloft import schemas as S
from tallyloft.functions.scalar import iso_time, once

# The topics.
ITEM_TOPIC, ORDER_TOPIC = "processed_sales_items", "processed_orders_agg"
HOT_ITEM_KEY = ["store_country", "event_ts", "order_serial"]
HOT_ORDER_KEY = list(S.ORDER_KEYS)
UNKNOWN = "UNKNOWN"

# Columns of the hot serving tables.
HOT_ITEM_COLUMNS = [
    "store_country", "store_city", "product_name", "category", "event_ts", "order_serial", "quantity",
    "total_sales_usd", "line_total_amount", "is_return", "is_cancel", "processing_lag", "customerkey",
    "payment_method", "sales_channel"]
HOT_ORDER_COLUMNS = [
    "currency_code", "event_ts", "order_group_id", "total_items_count", "total_order_local", "total_order_usd",
    "is_return_flag", "is_cancel_flag", "max_lag_seconds", "order_date", "customerkey", "payment_method",
    "store_country"]


def _messages(df: DataFrame, key: str, fields: T.StructType) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*fields.names)).alias("value"))


def item_messages(items: DataFrame) -> DataFrame:
    return _messages(items, "order_serial", S.ITEM_MESSAGE)


def order_messages(orders: DataFrame) -> DataFrame:
    return _messages(orders, "order_group_id", S.ORDER_MESSAGE)


def _parsed(messages: DataFrame, fields: T.StructType) -> DataFrame:
    return messages.select(once(F.from_json(F.col("value").cast("string"), fields), "m")).select("m.*")


def hot_items(items: DataFrame) -> DataFrame:
    """Item columns of the serving table; a store without a country is kept under UNKNOWN."""
    return items.withColumns({
        "store_country": F.coalesce("store_country", F.lit(UNKNOWN)),
        "processing_lag": F.coalesce("processing_lag", F.lit(0)).cast("int"),
    }).select(*HOT_ITEM_COLUMNS)


def hot_orders(orders: DataFrame) -> DataFrame:
    """Order columns of the serving table, plus the key columns the old table left out."""
    renamed = orders.withColumnRenamed("last_update", "event_ts").withColumns({
        "store_country": F.coalesce("store_country", F.lit(UNKNOWN)),
        "store_city": F.coalesce("store_city", F.lit(UNKNOWN)),
        "max_lag_seconds": F.coalesce("max_lag_seconds", F.lit(0)).cast("int"),
    })
    return renamed.select(*HOT_ORDER_COLUMNS, "event_type", "store_city")


def read_items(messages: DataFrame) -> DataFrame:
    """Typed rows of the readable messages; ``unreadable`` has the others."""
    parsed = _parsed(messages, S.ITEM_MESSAGE).withColumn("event_ts", iso_time(F.col("event_ts")))
    return hot_items(parsed.where("event_ts IS NOT NULL"))


def read_orders(messages: DataFrame) -> DataFrame:
    parsed = _parsed(messages, S.ORDER_MESSAGE).withColumn("last_update", iso_time(F.col("last_update")))
    return hot_orders(parsed.where("last_update IS NOT NULL"))


def unreadable(messages: DataFrame, topic: str) -> DataFrame:
    """Messages that cannot be parsed or whose time cannot be read: dead letters, never stamped with the current time."""
    fields, name = (S.ITEM_MESSAGE, "event_ts") if topic == ITEM_TOPIC else (S.ORDER_MESSAGE, "last_update")
    raw = F.from_json(F.col("value").cast("string"), fields)
    return messages.where(iso_time(raw[name]).isNull()).withColumn("reason", F.lit(f"{name} unreadable"))


def by_topic(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split one feed of both topics into typed item rows, typed order rows and rejected messages; each message goes to one."""
    items, orders = (messages.where(F.col("topic") == t) for t in (ITEM_TOPIC, ORDER_TOPIC))
    strange = messages.where(~F.coalesce(F.col("topic").isin(ITEM_TOPIC, ORDER_TOPIC), F.lit(False)))
    rejected = unreadable(items, ITEM_TOPIC).unionByName(unreadable(orders, ORDER_TOPIC)).unionByName(
        strange.withColumn("reason", F.lit("topic unknown")))
    return read_items(items), read_orders(orders), rejected
