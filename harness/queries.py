"""One registered query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.canonical import Inputs, written_parts
from tallyloft import schemas as S
from tallyloft.functions.scalar import is_bad_text, local_amount, money, once, sales_channel
from tallyloft.operators import clean, fx, quality as Q, reconcile, scd2
from tallyloft.operators.joins import attach, hot_keys
from tallyloft.plans import batch, dims, facts, gold_marts as gold, hot_marts as hot, incremental, silver, sketches
from tallyloft.session import scratch_path, stage
from tallyloft.sources import bronze
from tallyloft.streaming import decode, marts as stream_marts, messages, orders, runner, sinks
from tallyloft.streaming.enrich import derive, enrich

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RANGE = (datetime(2024, 1, 5), datetime(2024, 1, 20))
RENAMED = "2024-01-12 09:30:00"
COUNTRIES = [f"NATION_{n}" for n in range(0, 25, 2)] + ["Online"]


def as_of() -> Column:
    return F.lit("2002-01-01").cast("date")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and arrays as text, the forms both engines hand out alike."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "; ")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: comparable(build(Inputs(spark, sf_dir)))
    return build


# ---- sources -------------------------------------------------------------------------------


def _landed(x: Inputs, name: str, df: DataFrame) -> DataFrame:
    """Write a table as gzipped NDJSON into its landing folder and read it through the bronze reader."""
    root = scratch_path(x.spark, "landing")
    df.write.option("compression", "gzip").json(bronze.location(root, name))
    return bronze.table(x.spark, root, name)


def _as_landed(x: Inputs, name: str) -> DataFrame:
    """A table with the names and forms of its lines."""
    if name == "customers":
        return x.customers.withColumn("birthday", F.unix_millis(F.col("birthday").cast("timestamp")))
    if name == "products":
        return x.products.withColumnsRenamed({"unit_cost_usd": "Unit_Cost_USD", "unit_price_usd": "Unit_Price_USD"})
    if name == "data_dictionary":
        words = [(n, t, f, f'{f}, of "{t}"') for n, (t, f) in enumerate((t, f) for t, fields in S.DICTIONARY.items() for f in fields)]
        return x.spark.createDataFrame(words, S.BRONZE[name])
    return getattr(x, name)


@query
def bronze_ndjson_customers(x):
    return _landed(x, "customers", _as_landed(x, "customers"))


@query
def bronze_ndjson_products(x):
    return _landed(x, "products", _as_landed(x, "products"))


@query
def bronze_ndjson_sales(x):
    return _landed(x, "sales", x.sales)


@query
def bronze_ndjson_stores(x):
    return _landed(x, "stores", x.stores)


@query
def bronze_ndjson_exchange_rates(x):
    return _landed(x, "exchange_rates", x.exchange_rates)


def _drifting(x: Inputs) -> DataFrame:
    """Sales lines of which some are cut off, some carry a field nobody declared and some a quantity in words, as landed and parsed."""
    root, number = scratch_path(x.spark, "drift"), F.col("order_number") * 10 + F.col("line_item")
    line = F.to_json(F.struct(*x.sales.columns))
    line = F.when(number % 17 == 0, F.regexp_replace(line, "}$", ',"coupon":"C1"}')).when(
        number % 19 == 0, F.regexp_replace(line, '"quantity":[0-9]+', '"quantity":"many"')).otherwise(line)
    x.sales.select(F.when(number % 97 == 0, F.substring(line, 1, 30)).otherwise(line)).write.text(bronze.location(root, "sales"))
    return stage(bronze.variants(x.spark, bronze.location(root, "sales")), "variants")


@query
def bronze_variant_sales(x):
    return bronze.from_variants(_drifting(x), "sales")


@query
def bronze_variant_rejected(x):
    return bronze.rejected_variants(_drifting(x)).groupBy(F.length("line").alias("length")).agg(F.count("*").alias("lines"))


@query
def bronze_drift(x):
    return bronze.drift(_drifting(x), "sales")


@query
def bronze_csv_stores(x):
    path = scratch_path(x.spark, "csv-stores")
    x.stores.withColumn("open_date", F.date_format("open_date", "M/d/yyyy")).write.option("header", True).csv(path)
    return bronze.csv_stores(x.spark, path)


@query
def bronze_named_sources(x):
    """Sales by country and category, all in SQL over the logical names of the landed tables."""
    root = scratch_path(x.spark, "landing")
    for name in S.BRONZE:
        _as_landed(x, name).write.option("compression", "gzip").json(bronze.location(root, name))
    bronze.register(x.spark, root)
    return x.spark.sql("""
        WITH units AS (SELECT storekey, productkey, count(*) AS lines, sum(quantity) AS units FROM sales_ext GROUP BY ALL)
        SELECT s.country, p.category, sum(u.lines) AS lines, sum(u.units) AS units
        FROM units u JOIN stores_ext s USING (storekey) JOIN products_ext p USING (productkey) GROUP BY ALL""")


@query
def date_spine(x):
    return bronze.date_spine(x.days)


# ---- silver --------------------------------------------------------------------------------


@query
def silver_customers(x):
    return silver.customers(x.customers)


@query
def silver_products(x):
    return silver.products(x.products)


@query
def silver_sales(x):
    return x.silver_sales


@query
def silver_stores(x):
    return silver.stores(x.stores)


@query
def silver_exchange_rates(x):
    return x.silver_rates


@query
def silver_null_trim(x):
    key = F.col("customerkey")
    dirty = x.customers.withColumns({
        "name": F.concat(F.lit("  "), F.col("name"), F.lit(" ")),
        "city": F.when(key % 7 == 0, "   ").otherwise(F.col("city")),
        "gender": F.when(key % 11 != 0, F.col("gender")),
    })
    return silver.customers_clean(silver.customers(dirty))


@query
def silver_sales_dedup(x):
    return silver.sales_once(x.silver_sales)


# ---- dimensions ----------------------------------------------------------------------------


@query
def dim_customer(x):
    return x.dim_customer


@query
def dim_product_info(x):
    return x.dim_product


@query
def dim_stores(x):
    return x.dim_stores


@query
def dim_exchange_rates(x):
    return dims.exchange_rates(x.silver_rates, x.rows["rates"])


@query
def dim_exchange_rates_compat(x):
    return dims.exchange_rates_compat(x.silver_rates, x.rows["rates"])


@query
def dim_date(x):
    return dims.date(x.days)


@query
def dim_date_compat(x):
    return dims.date_compat(x.days)


@query
def dim_holiday(x):
    return dims.holiday(x.days)


@query
def scd2_customer(x):
    """Three snapshots: the opening one, one with moved and new customers, and a repeat of it."""
    key = F.col("customer_key")
    base = silver.customers(x.customers)
    first = base.where(key % 20 != 5)
    second = base.withColumn("city", F.when(key % 10 == 3, F.concat(F.lit("NEW_"), F.col("city"))).otherwise(F.col("city")))
    tracked = ["city", "state", "country", "name"]
    history = scd2.opening(first, "2001-01-01")
    for day in ("2001-07-01", "2001-08-01"):
        history = scd2.apply_snapshot(history, second, "customer_key", tracked, day)
    return history.select("customer_key", "name", "city", "state", "country", "valid_from", "valid_to", "is_current")


def _snapshots(x: Inputs) -> DataFrame:
    """Five snapshots in no order: customers move in the second and back in the fourth, some are missing; the third arrives last, twice."""
    key, base = F.col("customer_key"), silver.customers(x.customers)
    moved = base.withColumn("city", F.when(key % 10 == 3, F.concat(F.lit("NEW_"), F.col("city"))).otherwise(F.col("city")))
    late = moved.withColumn("city", F.when(key % 7 == 0, "LATE").otherwise(F.col("city")))
    taken = [(4, base.where(key % 6 != 1), "2001-09-01"), (1, base.where(key % 20 != 5), "2001-01-01"), (5, base, "2001-11-01"),
             (2, moved, "2001-04-01"), (3, late, "2001-06-01")]
    parts = [df.withColumns({"taken": F.lit(day).cast("date"), "number": F.lit(n)}) for n, df, day in taken]
    return reduce(DataFrame.unionByName, parts).select("customer_key", "name", "city", "state", "country", "taken", "number")


_TRACKED = ["city", "state", "country", "name"]


def _history(x: Inputs) -> DataFrame:
    """Three snapshots at once, then the others, of which the last one to come lies before the latest seen, and comes again."""
    taken = stage(_snapshots(x), "snapshots")

    def of(*numbers: int) -> DataFrame:
        return taken.where(F.col("number").isin(*numbers)).drop("number")

    history = scd2.merged(of(4, 1, 5), "customer_key", _TRACKED, "taken")
    for numbers in ((2,), (3,), (3, 1)):
        history = stage(scd2.merged(of(*numbers), "customer_key", _TRACKED, "taken", history), "history")
    return history


@query
def scd2_late_snapshots(x):
    return _history(x).select("customer_key", "name", "city", "state", "country", "valid_from", "valid_to", "is_current")


@query
def fact_customer_as_of(x):
    """Order lines with the customer's city on the order date, dates moved into the year of the snapshots."""
    day = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("order_number") % 365).cast("int"))
    sales = x.silver_sales.select("order_number", "line_item", "customer_key", day.alias("day"))
    return scd2.valid_on(sales, _history(x), "customer_key", "day", ["city", "country"], rows=x.rows["customer"], row_id=["order_number"])


# ---- facts ---------------------------------------------------------------------------------


@query
def fact_sales(x):
    return facts.order_fact(x.star)


@query
def fact_sales_compat(x):
    return facts.order_fact_compat(x.star_compat)


@query
def fact_product_sales(x):
    return facts.product_fact(x.star)


@query
def fact_product_sales_compat(x):
    return facts.product_fact_compat(x.star_compat)


def _second_load(x: Inputs, name: str) -> DataFrame:
    """A first load without some late orders and with some wrong quantities, then one of the true sales: keys, and months written."""
    root, end = scratch_path(x.spark, "monthly"), F.lit(x.bounds[1])
    number, age = F.col("order_number"), F.datediff(end, "order_date")
    sales = stage(x.silver_sales, "monthly-sales")
    early = sales.where(~((number % 7 == 0) & (age <= 40))).withColumn(
        "quantity", F.when((number % 11 == 0) & age.between(80, 90), F.col("quantity") + 1).otherwise(F.col("quantity")))
    star = replace(x.star, hot_from={})
    key, identity, *_ = batch.FACTS[name]
    before, _ = batch.load_facts(x.spark, root, replace(star, sales=early), (name,))[name]
    before = stage(before.select(*identity, F.col(key).alias("first_key")), "monthly-before")
    after, written = batch.load_facts(x.spark, root, replace(star, sales=sales), (name,))[name]
    told = incremental.with_key_state(after, before, identity, key, "first_key")
    return told.withColumn("written", incremental.in_months(written)).drop(*incremental.MONTH)


@query
def fact_sales_incremental(x):
    return _second_load(x, "fact_sales")


@query
def fact_product_sales_incremental(x):
    return _second_load(x, "fact_product_sales")


@query
def fx_asof_sales(x):
    last = F.lit("2001-12-31").cast("date")
    rates = x.natural_star.rates.select("currency_code", "date_key", "rate")
    lines = attach(x.silver_sales, x.natural_star.product.select("product_key", "unit_price_usd"), "product_key",
                   rows=x.rows["part"])
    lines = lines.withColumn("price_usd", F.col("unit_price_usd") * F.col("quantity"))
    done = fx.normalise(lines, fx.daily_rates(rates, last), ["price_usd"])
    return done.select("order_number", "line_item", "product_key", "quantity", "currency_code", "order_date",
                       "rate_date_used", "rate", "price_usd", "price_local")


# ---- gold marts ----------------------------------------------------------------------------


def _sizes(x: Inputs) -> dict[str, int]:
    return {"date": x.rows["days"], "store": x.rows["supplier"], "product": x.rows["part"]}


def _orders(x: Inputs) -> DataFrame:
    p = x.published
    return gold.published_orders(p["fact_sales"], p["dim_date"], p["dim_stores"], _sizes(x))


def _products(x: Inputs) -> DataFrame:
    p = x.published
    return gold.published_products(p["fact_product_sales"], p["dim_date"], p["dim_stores"], p["dim_product_info"], _sizes(x))


@query
def mart_shipping(x):
    return gold.shipping(_orders(x), x.published["dim_stores"], x.rows["supplier"])


@query
def mart_revenue_quarter_category(x):
    return gold.revenue_by_quarter_category(_products(x))


@query
def mart_aov_margin(x):
    return gold.order_value_and_margin(_orders(x))


@query
def mart_top_brands(x):
    return gold.top_brands(_products(x))


@query
def mart_demographics(x):
    return gold.demographics(_orders(x), x.published["dim_customer"], as_of())


@query
def mart_store_performance(x):
    return gold.store_performance(_orders(x), x.published["dim_stores"], x.rows["supplier"])


@query
def mart_channel_geo(x):
    return gold.channel_geography(_orders(x), x.published["dim_stores"], x.rows["supplier"])


@query
def mart_rfm(x):
    return gold.rfm(_orders(x), as_of())


@query
def mart_clv(x):
    return gold.lifetime_value(_orders(x), as_of())


@query
def mart_product_mix(x):
    return gold.product_mix(_products(x))


@query
def mart_customer_reach(x):
    """Customers from merged sketches, next to the orders and whether they lie within four standard errors of the exact number."""
    orders = _orders(x)
    daily = stage(sketches.reach_sketches(orders, x.published["dim_stores"], x.rows["supplier"]), "reach")
    reach = sketches.customer_reach(daily)
    placed = attach(orders, x.published["dim_stores"].select("store_key", "country"), "store_key", rows=x.rows["supplier"])
    by = ["month", "country", "sales_channel"]
    exact = placed.select(F.trunc("order_date", "month").alias("month"), "country", sales_channel(F.col("store_key")).alias("sales_channel"),
                          "customer_key").cube(*by).agg(F.count_distinct("customer_key").alias("exact"), F.grouping_id().cast("int").alias("level"))
    met = reach.alias("r").join(exact.alias("e"), [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*by, "level"]])
    close = F.abs(F.col("customers") - F.col("exact")) <= 4 * sketches.REACH_ERROR * F.col("exact") + 0.5
    return met.select("r.*", "exact", close.alias("within")).drop("customers")


# ---- streams -------------------------------------------------------------------------------


def _run(x: Inputs, label: str, stream: DataFrame) -> DataFrame:
    """Run a stream over the events table to its end and read what it wrote."""
    out = scratch_path(x.spark, label)
    runner.run_to_end(sinks.parquet(stream, out, scratch_path(x.spark, f"{label}-checkpoint")))
    return x.spark.read.schema(stream.schema).parquet(out)


def _raw(x: Inputs, seed_defects: bool = False) -> DataFrame:
    return x.frames_of(x.event_stream(), seed_defects)


def _enriched(x: Inputs, raw: DataFrame, stores: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    return enrich(decode.good(decode.decode(raw)), stores or x.stores, products or x.products, F.col("arrived_at"),
                  x.rows["supplier"], x.rows["part"])


@query
def stream_item_enrich(x):
    """Store 3 and one product in fifty are missing: their events stay, without a description."""
    stores, products = x.stores.where("storekey <> 3"), x.products.where("productkey % 50 <> 7")
    return _run(x, "items", _enriched(x, _raw(x), stores, products)).drop("arrived_at", "status", "delivery_date")


@query
def stream_item_json(x):
    sent = _run(x, "item-messages", messages.item_messages(_enriched(x, _raw(x))))
    return sent.select("key", once(F.from_json("value", S.ITEM_MESSAGE), "m")).select("key", "m.*").withColumn(
        "event_ts", F.col("event_ts").try_cast("timestamp"))


def _order_table(x: Inputs, raw: DataFrame, **options) -> sinks.UpsertTable:
    """Run the order aggregate in update mode into an upsert table."""
    table = sinks.UpsertTable(scratch_path(x.spark, "hot-orders"), messages.HOT_ORDER_KEY)
    updates = runner.order_updates(raw, x.stores, F.col("arrived_at"), **options)
    runner.run_to_end(
        updates.writeStream.outputMode("update")
        .foreachBatch(table.sink(1, messages.hot_orders))
        .option("checkpointLocation", scratch_path(x.spark, "hot-orders-checkpoint")))
    return table


HOT_ORDER_SCHEMA = S.struct(
    currency_code=S.STR, event_ts=S.TS, order_group_id=S.STR, total_items_count=S.LONG, total_order_local=S.DBL,
    total_order_usd=S.DBL, is_return_flag=S.INT, is_cancel_flag=S.INT, max_lag_seconds=S.INT, order_date=S.STR,
    customerkey=S.LONG, payment_method=S.STR, store_country=S.STR, event_type=S.STR, store_city=S.STR)
HOT_ITEM_SCHEMA = S.struct(
    store_country=S.STR, store_city=S.STR, product_name=S.STR, category=S.STR, event_ts=S.TS, order_serial=S.STR,
    quantity=S.INT, total_sales_usd=S.DBL, line_total_amount=S.DBL, is_return=S.INT, is_cancel=S.INT,
    processing_lag=S.INT, customerkey=S.LONG, payment_method=S.STR, sales_channel=S.STR)


@query
def stream_order_agg_update(x):
    return _order_table(x, _raw(x)).latest(x.spark, HOT_ORDER_SCHEMA)


@query
def stream_order_updates_once(x):
    """Every fifth message arrives three times; the running totals take each once."""
    copies = F.when(F.expr("event_id % 5 = 0"), 3).otherwise(1)
    repeated = x.event_stream().withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    return _order_table(x, x.frames_of(repeated), once_within="10 minutes").latest(x.spark, HOT_ORDER_SCHEMA)


@query
def stream_order_agg_windowed(x):
    events = runner.order_events(x.frames_of(x.event_feed()), x.stores, F.col("arrived_at"))
    return _run(x, "order-windows", orders.windowed(events))


@query
def stream_order_sessions(x):
    events = runner.order_events(x.frames_of(x.event_feed()), x.stores, F.col("arrived_at"))
    return _run(x, "order-sessions", orders.sessions(events, "6 hours"))


@query
def stream_revenue_over_time(x):
    """The revenue mart as a stream over files out of order: ten-minute windows, then hours over them."""
    items = messages.hot_items(_enriched(x, x.frames_of(x.event_feed())))
    return _run(x, "revenue-stream", stream_marts.revenue_over_time(items))


@query
def stream_order_ticker(x):
    events = runner.order_events(x.frames_of(x.event_feed()), x.stores, F.col("arrived_at"))
    return _run(x, "ticker-stream", stream_marts.order_ticker(events))


@query
def stream_cancel_alerts(x):
    """The alert mart as one stream of three aggregates over files out of order."""
    items = messages.hot_items(_enriched(x, x.frames_of(x.event_feed())))
    return _run(x, "alert-stream", stream_marts.cancel_alerts(items))


@query
def stream_lag_sketches(x):
    """Lag sketches per minute and country as a stream writes them, merged by day in two steps; ranks checked against all lags."""
    items = messages.hot_items(_enriched(x, x.frames_of(x.event_feed())))
    parts = _run(x, "lag-sketches", sketches.lag_sketches(items))
    hours = sketches.merged_lags(parts, F.date_trunc("hour", "bucket").alias("hour"), "store_country")
    days = stage(sketches.lag_quantiles(sketches.merged_lags(hours, F.date_trunc("day", "hour").alias("bucket")), p50=0.5, p95=0.95), "lag-days")
    lags = _hot_items(x).where("processing_lag IS NOT NULL").groupBy(F.date_trunc("day", "event_ts").alias("bucket"), "processing_lag").agg(
        F.count(F.lit(1)).alias("n"))
    met, error = days.join(lags, "bucket"), sketches.LAG_RANK_ERROR

    def within(name: str, share: float) -> Column:
        below = F.sum(F.when(F.col("processing_lag") < F.col(name), F.col("n")).otherwise(0)) / F.sum("n")
        up_to = F.sum(F.when(F.col("processing_lag") <= F.col(name), F.col("n")).otherwise(0)) / F.sum("n")
        return ((below <= share + error) & (up_to >= share - error)).alias(f"{name}_within")

    return met.groupBy("bucket", "events", "max_lag").agg(within("p50", 0.5), within("p95", 0.95))


def _store_changes(x: Inputs, parts: int = 3) -> DataFrame:
    """All stores once a day as a stream of several parts, and a third of them renamed in the middle of a month."""
    path, ts, renamed = scratch_path(x.spark, "store-changes"), F.col("ts").cast("timestamp"), F.lit(RENAMED).cast("timestamp")
    span = x.load("events").agg(F.date_trunc("day", F.min(ts)).alias("a"), (F.date_trunc("day", F.max(ts)) + F.expr("INTERVAL 3 DAYS")).alias("b"))
    daily = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("changed_at"))
    sent = x.stores.join(F.broadcast(daily.unionByName(x.spark.range(1).select(renamed.alias("changed_at")))))
    sent = sent.where((F.col("changed_at") != renamed) | (F.col("storekey") % 3 == 1)).withColumn(
        "country", F.when((F.col("storekey") % 3 == 1) & (F.col("changed_at") >= renamed), F.concat(F.lit("NEW_"), F.col("country"))).otherwise(F.col("country")))
    sent.write.parquet(f"{path}/all")
    stored = x.spark.read.parquet(f"{path}/all")
    first, last = stored.agg(F.unix_seconds(F.min("changed_at")), F.unix_seconds(F.max("changed_at"))).first()
    part = F.floor((F.unix_seconds("changed_at") - first) * parts / (last - first + 1)).cast("int")
    return bronze.file_stream(x.spark, f"{path}/feed/*", stored.schema, max_files=written_parts(stored, part, parts, f"{path}/feed"))


@query
def stream_fresh_stores(x):
    """A third of the stores is renamed half-way: the new name shows in later events only."""
    busy = hot_keys(x.events.select("storekey"), ["storekey"])
    events = runner.fresh_order_events(x.frames_of(x.event_feed(days=3)), _store_changes(x), "arrived_at", busy=busy)
    return _run(x, "fresh-stores", events.select("order_serial", "event_type", "event_ts", "store_country", "store_city", "total_sales_usd"))


@query
def stream_order_redelivered(x):
    """Every fifth message arrives three times, over several files; each counts once in the totals of its order."""
    copies = F.when(F.expr("event_id % 5 = 0"), 3).otherwise(1)
    repeated = x.event_feed().withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    events = orders.once(runner.order_events(x.frames_of(repeated), x.stores, F.col("arrived_at")))
    return _run(x, "order-redelivered", orders.windowed(events, lateness=None))


@query
def stream_order_json(x):
    """Order messages as written by the update-mode query, read back into rows."""
    out = scratch_path(x.spark, "order-messages")
    updates = messages.order_messages(runner.order_updates(_raw(x), x.stores, F.col("arrived_at")))
    runner.run_to_end(
        updates.writeStream.outputMode("update")
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}"))
        .option("checkpointLocation", scratch_path(x.spark, "order-messages-checkpoint")))
    sent = x.spark.read.schema("key string, value string, batch_id long").parquet(out)
    return sent.select("key", once(F.from_json("value", S.ORDER_MESSAGE), "m")).select("key", "m.*").withColumn(
        "last_update", F.col("last_update").try_cast("timestamp"))


@query
def stream_dedup(x):
    """Every fifth message arrives three times."""
    copies = F.when(F.expr("event_id % 5 = 0"), 3).otherwise(1)
    repeated = x.event_stream().withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    events = derive(
        decode.good(decode.decode(x.frames_of(repeated))).withColumns({"country": F.lit(None).cast("string"),
                                                                      "state": F.lit(None).cast("string")}),
        F.col("arrived_at"))
    kept = orders.once(events)
    return _run(x, "dedup", kept.select("order_serial", "event_type", "quantity", "event_ts", "total_sales_usd"))


@query
def stream_dlq(x):
    letters = _run(x, "dead-letters", decode.rejected(decode.decode(_raw(x, seed_defects=True))))
    return letters.select("key", "reason", F.length("value").cast("int").alias("bytes"))


@query
def stream_archive_hourly(x):
    out = scratch_path(x.spark, "archive")
    archived = sinks.archive(_raw(x), out, scratch_path(x.spark, "archive-checkpoint"), F.col("arrived_at"))
    runner.run_to_end(archived)
    stored = x.spark.read.schema(
        "key string, value binary, arrived_at timestamp, year int, month int, day int, hour int").parquet(out)
    return stored.groupBy(*sinks.ARCHIVE_PARTS).agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.length("value")).alias("bytes"))


@query
def stream_restarted(x):
    """Items and orders as two queries over one topic; both end, a third of the events arrives, both go on from their checkpoints."""
    events, topic = x.load("events"), scratch_path(x.spark, "topic")
    out, marks = scratch_path(x.spark, "item-messages"), scratch_path(x.spark, "restarted")
    table = sinks.UpsertTable(scratch_path(x.spark, "hot-orders"), messages.HOT_ORDER_KEY)
    late = F.col("event_id") % 3 == 0
    for run, arriving in ((1, ~late), (2, late)):
        events.where(arriving).write.parquet(f"{topic}/arrival={run}")
        raw = x.frames_of(bronze.file_stream(x.spark, f"{topic}/*", events.schema))
        items = sinks.parquet(messages.item_messages(_enriched(x, raw)), out, f"{marks}/items")
        totals = (runner.order_updates(raw, x.stores, F.col("arrived_at")).writeStream.outputMode("update")
                  .foreachBatch(table.sink(run, messages.hot_orders)).option("checkpointLocation", f"{marks}/orders"))
        for started in [w.trigger(availableNow=True).start() for w in (items, totals)]:
            started.awaitTermination()
    sent = x.spark.read.schema("key string, value string").parquet(out).select(once(F.from_json("value", S.ITEM_MESSAGE), "m")).select("m.*")
    of_items = sent.groupBy("store_country").agg(F.count("*").alias("n"), F.sum("quantity").alias("units"))
    of_orders = table.latest(x.spark, HOT_ORDER_SCHEMA).groupBy("store_country").agg(F.count("*").alias("n"), F.sum("total_items_count").alias("units"))
    return of_items.withColumn("kind", F.lit("item")).unionByName(of_orders.withColumn("kind", F.lit("order")))


# ---- hot tables and their marts ------------------------------------------------------------


def _items(x: Inputs) -> DataFrame:
    items = enrich(x.events, x.stores, x.products, F.col("arrived_at"), x.rows["supplier"], x.rows["part"])
    return items


def _hot_items(x: Inputs) -> DataFrame:
    return messages.hot_items(_items(x))


def _hot_orders(x: Inputs) -> DataFrame:
    return messages.hot_orders(orders.running(_items(x)))


def _item_table(x: Inputs) -> sinks.UpsertTable:
    """A first batch with all items, then one correcting every fourth item, which is delivered twice."""
    table = sinks.UpsertTable(scratch_path(x.spark, "hot-items"), messages.HOT_ITEM_KEY)
    # Read back from JSON once for the three writes.
    rows = stage(messages.read_items(messages.item_messages(_items(x))), "read-items")
    serial = F.split_part("order_serial", F.lit("-"), F.lit(2)).cast("bigint")
    corrected = rows.where(serial % 4 == 0).withColumn("quantity", F.col("quantity") + 1)
    table.write(rows, 1, 0)
    table.write(corrected, 1, 1)
    table.write(corrected, 1, 1)
    return table


@query
def hot_items_latest(x):
    return _item_table(x).latest(x.spark, HOT_ITEM_SCHEMA)


@query
def hot_items_folded(x):
    """Eight batches, folded into the base after every third; then one folded batch is delivered once more, with older rows."""
    table = sinks.UpsertTable(scratch_path(x.spark, "hot-items"), messages.HOT_ITEM_KEY, fold_every=3)
    rows = stage(_hot_items(x), "hot-rows")
    serial = F.split_part("order_serial", F.lit("-"), F.lit(2)).cast("bigint")
    table.write(rows.withColumn("quantity", F.col("quantity") - 5), 1, 0)
    table.write(rows.where(serial % 2 == 0), 1, 1)
    for n in range(2, 7):
        table.write(rows.where((serial % 2 == 1) & (serial % 5 == n - 2)), 1, n)
    table.write(rows.where(serial % 4 == 0).withColumn("quantity", F.col("quantity") + 1), 2, 0)
    table.write(rows.withColumn("quantity", F.col("quantity") - 5), 1, 0)
    return table.latest(x.spark, HOT_ITEM_SCHEMA)


@query
def hot_items_stored_order(x):
    """Rows of each country and how many of them are stored after an older one in their file."""
    table = sinks.UpsertTable(scratch_path(x.spark, "hot-items"), messages.HOT_ITEM_KEY)
    table.write(_hot_items(x), 1, 0)
    stored = table.versions(x.spark, HOT_ITEM_SCHEMA).select(
        "store_country", "event_ts", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    before = F.lag("event_ts").over(Window.partitionBy("file").orderBy("place"))
    return stored.withColumn("before", before).groupBy("store_country").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") < F.col("event_ts")).alias("out_of_order"))


@query
def hot_items_by_country(x):
    return _item_table(x).latest(x.spark, HOT_ITEM_SCHEMA, COUNTRIES)


@query
def hot_orders_latest(x):
    """Two micro-batches touch the same orders; the later totals win."""
    table = sinks.UpsertTable(scratch_path(x.spark, "hot-orders"), messages.HOT_ORDER_KEY)
    items = _items(x)
    partial = items.where("order_number % 2 = 0")
    for n, part in enumerate((partial, items)):
        sent = messages.order_messages(orders.running(part))
        table.write(messages.read_orders(sent), 1, n)
    return table.latest(x.spark, HOT_ORDER_SCHEMA)


@query
def hot_items_recent(x):
    return hot.newest(_hot_items(x), 50, ["store_country", "order_serial"])


@query
def hot_orders_recent(x):
    return hot.newest(_hot_orders(x), 50, ["order_group_id", "event_type"])


@query
def order_totals_exact(x):
    """Prices with five decimals: lines and orders are summed exactly and rounded once."""
    eid = F.col("order_number")
    price = (F.col("unit_price_usd").cast("decimal(15,2)") + (eid % 1000).cast("decimal(10,0)") / F.lit(100000)).cast("decimal(20,5)")
    fine = x.events.withColumn("fine", price).withColumns({
        "unit_price_usd": F.col("fine").cast("double"), "line_total_amount": (F.col("fine") * F.col("quantity")).cast("double")}).drop("fine")
    items = enrich(fine, x.stores, x.products, F.col("arrived_at"), x.rows["supplier"], x.rows["part"])
    return orders.running(items).select("order_group_id", "event_type", "payment_method", "currency_code", "total_items_count", "total_order_local", "total_order_usd")


@query
def fx_large_rates(x):
    """Rates beyond a million units per dollar."""
    rates = x.natural_star.rates.select("currency_code", F.col("date_key").alias("order_date"),
                                        (F.col("rate") * 1_000_000 + F.lit("0.5").cast("decimal(2,1)")).cast(S.RATE).alias("rate"))
    lines = attach(x.silver_sales, x.natural_star.product.select("product_key", "unit_price_usd"), "product_key", rows=x.rows["part"])
    lines = lines.withColumn("price_usd", F.col("unit_price_usd") * F.col("quantity"))
    rated = attach(lines, rates, ["currency_code", "order_date"], rows=x.rows["rates"])
    return rated.groupBy("currency_code").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(local_amount(F.col("price_usd"), F.col("rate"))).alias("price_local"))


@query
def stream_read_back(x):
    """Item and order messages, some cut off, some with an unreadable time, some of an unknown topic: where each goes."""
    items = _items(x)
    sent = messages.item_messages(items).withColumn("topic", F.lit(messages.ITEM_TOPIC)).unionByName(
        messages.order_messages(orders.running(items)).withColumn("topic", F.lit(messages.ORDER_TOPIC)))
    number = F.length("key") + F.ascii(F.substring("key", -1, 1))
    broken = sent.withColumns({
        "value": F.when(number % 7 == 0, F.substring("value", 1, 20)).when(
            number % 7 == 1, F.regexp_replace("value", "T[0-9:.]+Z", "soon")).otherwise(F.col("value")),
        "topic": F.when(number % 7 == 2, "elsewhere").otherwise(F.col("topic"))})
    good_items, good_orders, rejected = messages.by_topic(broken)
    return good_items.select(F.lit("item").alias("kind"), F.col("order_serial").alias("key"), F.lit(None).cast("string").alias("reason")).unionByName(
        good_orders.select(F.lit("order").alias("kind"), F.col("order_group_id").alias("key"), F.lit(None).cast("string").alias("reason"))).unionByName(
        rejected.select(F.lit("rejected").alias("kind"), "key", "reason"))


@query
def hot_items_by_channel(x):
    return hot.at(_hot_items(x), sales_channel="Online")


@query
def hot_items_by_city(x):
    return hot.at(_hot_items(x), store_city="Online")


@query
def mart_total_revenue(x):
    return hot.total_revenue(_hot_items(x), *RANGE, COUNTRIES)


@query
def mart_top_products(x):
    return hot.top_products(_hot_items(x), *RANGE, COUNTRIES, k=10)


@query
def mart_revenue_over_time(x):
    return hot.revenue_over_time(_hot_items(x), *RANGE, COUNTRIES)


@query
def mart_order_ticker(x):
    return hot.order_ticker(_hot_orders(x))


@query
def mart_payment_mix(x):
    return hot.payment_mix(_hot_orders(x))


@query
def mart_return_impact(x):
    return hot.return_impact(
        _items(x).select("event_ts", "event_type", "total_sales_usd"))


@query
def mart_problem_skus(x):
    return hot.problem_skus(_hot_items(x))


@query
def mart_lag_monitor(x):
    return hot.lag_monitor(_hot_items(x))


@query
def mart_cancel_alerts(x):
    return hot.cancel_alerts(_hot_items(x))


# ---- quality -------------------------------------------------------------------------------


@query
def dq_unique(x):
    return Q.duplicate_keys(x.silver_sales, silver.SALES_KEY)


@query
def dq_not_null(x):
    return Q.null_counts(x.silver_sales)


@query
def dq_null_rate(x):
    return Q.null_rates(x.silver_sales)


@query
def dq_referential(x):
    """Orphans left when the dimensions lack some rows, per foreign key, and order days without a rate."""
    sales, key = stage(x.silver_sales, "checked-sales"), F.col
    checks = [
        ("product_key", silver.products(x.products).where(key("product_key") % 50 != 7)),
        ("store_key", silver.stores(x.stores).where("store_key <> 3")),
        ("customer_key", silver.customers(x.customers).where(key("customer_key") % 40 != 9)),
    ]
    found = [
        Q.orphans(sales, fk, dim, fk).select(F.lit(fk).alias("fk"), F.col("key_value").cast("string").alias("key_value"), "row_count")
        for fk, dim in checks]
    rates = Q.missing_rates(sales, x.natural_star.rates).select(
        F.lit("exchange_rate").alias("fk"), F.concat_ws("/", "currency_code", "date_key").alias("key_value"), "row_count")
    out = rates
    for part in found:
        out = out.unionByName(part)
    return out


@query
def dq_completeness(x):
    """Lines lost between bronze and the deduplicated silver layer, by order and line."""
    return Q.lost_rows(x.silver_sales, silver.sales_once(x.silver_sales), silver.SALES_KEY)


@query
def dq_completeness_rows(x):
    """Whole rows missing after a defective load that dropped the lines of one product in fifty."""
    loaded = x.silver_sales.where("product_key % 50 <> 7")
    return Q.lost_row_contents(x.silver_sales, loaded)


@query
def dq_reconciliation(x):
    """Lines that differ after a defective load: some lost, some doubled, some with another quantity."""
    sales = x.silver_sales
    quantity = (F.col("quantity") + F.when(F.col("order_number") % 23 == 0, 1).otherwise(0)).cast(sales.schema["quantity"].dataType)
    kept = sales.withColumn("quantity", quantity).where("product_key % 50 <> 7")
    loaded = kept.unionAll(kept.where("customer_key % 97 = 5"))
    return reconcile.reconciled(sales, loaded, silver.SALES_KEY)


@query
def dq_domain(x):
    eid = F.col("order_number")
    dirty = x.events.withColumns({
        "event_type": F.when(eid % 79 == 0, "REFUND").otherwise(F.col("event_type")),
        "currency_code": F.when(eid % 53 == 0, "XXX").otherwise(F.col("currency_code")),
        "order_serial": F.when(eid % 61 != 0, F.col("order_serial")),
    })
    _, bad = Q.split_by_domain(dirty, S.DOMAINS, decode.REQUIRED)
    return bad.select("order_number", "event_type", "currency_code", "reason")


@query
def dq_money_text(x):
    """Price texts that cannot be read, after some have been spoiled."""
    key = F.col("productkey")
    dirty = x.products.withColumn("unit_price_usd", F.when(key % 9 == 0, "abc").when(key % 9 == 1, " ").otherwise(F.col("unit_price_usd")))
    price = F.col("unit_price_usd")
    return dirty.select(
        F.col("productkey").alias("product_key"), money(price).alias("unit_price"),
        F.coalesce(is_bad_text(price), F.lit(False)).cast("int").alias("is_bad"))


def _documented(x: Inputs) -> dict[str, DataFrame]:
    return {"Sales": x.sales, "Customers": x.customers, "Products": x.products, "Stores": x.stores, "Exchange Rates": x.exchange_rates}


@query
def dq_dictionary(x):
    """The landed dictionary against the tables: which documented fields are there, and how many values each column holds."""
    return Q.dictionary_coverage(_documented(x), _landed(x, "data_dictionary", _as_landed(x, "data_dictionary")), with_values=True)


@query
def dq_dictionary_csv(x):
    """The same from the dictionary's CSV form, whose descriptions hold commas and quotes: fields that no table fills."""
    path = scratch_path(x.spark, "csv-dictionary")
    _as_landed(x, "data_dictionary").drop("id").write.options(header=True, escape='"').csv(path)
    words = bronze.csv_data_dictionary(x.spark, path)
    found = Q.dictionary_coverage(_documented(x), words, with_values=True).where("documented = 1")
    plain = [F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", "")).alias(c) for c in ("table_name", "field_name")]
    described = words.select(*plain, "description")
    return found.join(described, ["table_name", "field_name"]).select("description", F.coalesce("values", F.lit(0)).alias("filled"))


def _checks(x: Inputs) -> DataFrame:
    sales = stage(x.silver_sales, "checked-sales")
    customers, products, stores = silver.customers(x.customers), silver.products(x.products), silver.stores(x.stores)
    nulls = Q.null_counts(sales, ["order_number", "product_key", "quantity"]).where("null_count > 0")
    return Q.results([
        Q.finding("silver_customers", "unique", "customer_key", Q.duplicate_keys(customers, ["customer_key"])),
        Q.finding("silver_products", "unique", "product_key", Q.duplicate_keys(products, ["product_key"])),
        Q.finding("silver_stores", "unique", "store_key", Q.duplicate_keys(stores, ["store_key"])),
        Q.finding("silver_sales", "unique", "order_number,line_item", Q.duplicate_keys(sales, silver.SALES_KEY)),
        Q.finding("silver_sales", "not_null", "keys", nulls),
        Q.finding("silver_sales", "referential", "product_key", Q.orphans(sales, "product_key", products, "product_key")),
        Q.finding("silver_sales", "referential", "customer_key", Q.orphans(sales, "customer_key", customers, "customer_key")),
        Q.finding("silver_sales", "referential", "exchange_rate", Q.missing_rates(sales, x.natural_star.rates)),
    ])


@query
def dq_checks(x):
    return _checks(x)


@query
def dq_run_summary(x):
    return Q.run_summary(_checks(x))


@query
def dq_gate(x):
    """The checks that stand between the published facts and their readers."""
    sales = stage(x.silver_sales, "gated-sales")
    # The facts are built from the written lines that are checked against them.
    x.star = replace(x.star, sales=sales, apart=True, shared=True)
    p = x.published
    return Q.results([*batch.key_findings(sales, p), *batch.fact_findings(sales, p["fact_sales"], p["fact_product_sales"])])


@query
def dq_latest_per_key(x):
    """Newest event per customer, all columns."""
    rows = x.load("events").select("user_id", "event_id", "ts", "event_type", "value")
    return clean.latest_per_key(rows, ["user_id"], ["ts", "event_id"]).withColumn("ts", F.col("ts").cast("timestamp"))
