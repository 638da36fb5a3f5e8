"""Stream-static enrichment of sales events and their derived columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.functions.scalar import event_time, flag, lag_seconds, line_amount, sales_channel
from tallyloft.operators.joins import attach


def with_stores(events: DataFrame, stores: DataFrame, **size) -> DataFrame:
    columns = stores.select("storekey", "country", "state", "square_meters", "open_date")
    return attach(events, columns, "storekey", "left", **size)


STORE_COLUMNS = ["country", "state", "square_meters", "open_date"]


def _slice(micros: Column, width: Column) -> Column:
    """The start of the slice of time, ``width`` wide, that a moment lies in; a plain number, so that it ends no state by itself."""
    return micros - F.pmod(micros, width)


def with_fresh_stores(
    events: DataFrame, changes: DataFrame, max_age: str = "1 day", lateness: str = "10 minutes", salts: int = 8, busy: Iterable | None = None
) -> DataFrame:
    """Each event with its store as of the event's time, from a stream of store rows that hold from ``changed_at`` on.

    A stream-stream left join under watermarks, then per event the newest change that is not after it. Every store is to be sent again
    at least once per ``max_age``, changed or not: the join looks no further back, so its state is one ``max_age`` of changes. Events
    need ``event_ts`` and ``order_serial``; a repeated event comes out once, an event without a store with NULLs.

    An event looks through the changes of its store in one slice of ``max_age``: a change is sent to the one or two in which it holds. It
    is also sent to every salt, so that a store with a third of all events does not end in one task. ``busy`` names the stores, as ``hot_keys``
    finds them in events of before, of which alone this is worth it; any answer gives the same rows.
    """
    columns = events.columns

    def is_busy(store: str) -> Column:
        codes = None if busy is None else [c for c in busy if c is not None]
        return F.lit(True) if codes is None else F.col(store).isNull() | F.xxhash64(store).isin(codes)

    width = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {max_age})")
    spread = F.when(is_busy("storekey"), F.pmod(F.xxhash64("order_serial", "event_type"), F.lit(salts))).otherwise(0)
    left = events.withWatermark("event_ts", lateness).withColumns({"_salt": spread, "_in": _slice(F.unix_micros("event_ts"), width)})
    at, last = F.unix_micros("_at"), F.when(is_busy("_store"), salts - 1).otherwise(0).cast("bigint")
    right = changes.select(
        F.col("storekey").alias("_store"), F.col("changed_at").alias("_at"), F.struct(*STORE_COLUMNS).alias("_row")).withWatermark(
        "_at", lateness).withColumn("_holds", F.explode(F.sequence(_slice(at, width), _slice(at + width - 1, width), width))).withColumn(
        "_for", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    met = left.join(right, (F.col("storekey") == F.col("_store")) & (F.col("_salt") == F.col("_for")) & (F.col("_in") == F.col("_holds"))
                    & (F.col("_at") <= F.col("event_ts")) & (F.col("_at") > F.col("event_ts") - F.expr(f"INTERVAL {max_age}")), "leftOuter")
    newest = met.groupBy(*columns).agg(F.max_by("_row", "_at").alias("_row"))
    return newest.select(*columns, *[F.col(f"_row.{c}").alias(c) for c in STORE_COLUMNS])


def with_products(events: DataFrame, products: DataFrame, **size) -> DataFrame:
    """Only the descriptive columns: the product's price must not shadow the event's price."""
    return attach(events, products.select("productkey", "product_name", "category"), "productkey", "left", **size)


def derive(events: DataFrame, seen_at: Column | None = None) -> DataFrame:
    """``seen_at`` is the moment of processing; a message's arrival time can stand in for it."""
    seen_at = F.current_timestamp() if seen_at is None else seen_at
    return (
        events.withColumn("event_ts", event_time(F.col("event_timestamp")))
        .withColumns({
            "total_sales_usd": line_amount(F.col("quantity"), F.col("unit_price_usd")),
            "processing_lag": lag_seconds(seen_at, F.col("event_ts")),
            "is_return": flag(F.col("event_type") == "RETURN"),
            "is_cancel": flag(F.col("event_type") == "CANCEL"),
            "sales_channel": sales_channel(F.col("storekey")),
            # The state under its proper name; store_city is the name the serving tables use for it.
            "store_state": F.col("state"),
        })
        .withColumnsRenamed({"country": "store_country", "state": "store_city"})
    )


def enrich(
    events: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    seen_at: Column | None = None,
    store_rows: int | None = None,
    product_rows: int | None = None,
) -> DataFrame:
    joined = with_products(with_stores(events, stores, rows=store_rows), products, rows=product_rows)
    return derive(joined, seen_at)
