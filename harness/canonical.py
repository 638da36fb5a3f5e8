"""The driver's tables as bronze inputs of the engine (sales, products, customers, stores, rates, events)."""

from __future__ import annotations

from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloft import schemas as S
from tallyloft.functions.scalar import once
from tallyloft.operators.joins import attach
from tallyloft.plans import dims, facts, silver
from tallyloft.session import STORED, configure, scratch_path
from tallyloft.sources import bronze
from tallyloft.streaming import decode

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Currency, units per USD in thousandths.
BASE_RATES = [("USD", 1000), ("CAD", 1300), ("GBP", 800), ("AUD", 1500), ("EUR", 900)]


# Schemas by path, so that only the first query over a table reads a footer to plan.
_SCHEMAS: dict[str, StructType] = {}
# Folders of published gold tables by session, input folder and table.
_PUBLISHED: dict[tuple[str, str, str], str] = {}
# Rows per file of a feed, where it holds more than one file per part.
FEED_ROWS = 500_000


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def written_parts(df: DataFrame, part: Column, parts: int, path: str) -> int:
    """Write the rows of each part to a folder ``batch=<n>``, one after the other; every part has the same number of files, which is returned.

    As the limit of files per trigger this number makes one micro-batch of each part. A stream that took a part file by file would find
    the rows of its later files late wherever the rows of a part are not in order, and would start as many micro-batches as there are files.
    """
    sizes = {r.part: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}
    counts = [sizes.get(n, 0) for n in range(parts)]
    # A thousand rows a file in the smallest part: dealt out in turn, they leave no file without rows, which would not be written.
    files = max(1, min(ceil(max(counts) / FEED_ROWS), min(counts) // 1000))
    for n in range(parts):
        rows = df.where(part == n)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.parquet(f"{path}/batch={n}")
    return files


class Inputs:
    """All canonical inputs of one scale-factor folder, lazily built."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def load(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.dir}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._tables[name]

    # ---- bronze -------------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        places = self.load("nation").join(self.load("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.load("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("customerkey"),
            F.when(key % 2 == 0, "male").otherwise("female").alias("gender"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("CITY_"), key % 50).alias("city"),
            F.concat(F.lit("S"), F.col("n_nationkey")).alias("state_code"),
            F.concat(F.lit("STATE_"), F.col("n_nationkey")).alias("state"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("zip_code"),
            F.col("n_name").alias("country"),
            F.lower("r_name").alias("continent"),
            F.date_add(F.lit("1940-01-01").cast("date"), (key * 37 % 22000).cast("int")).alias("birthday"),
        )

    @cached_property
    def products(self) -> DataFrame:
        step = F.col("p_retailprice").cast("decimal(15,2)") - F.lit("895.00").cast("decimal(15,2)")
        price, cost = step * F.col("p_size"), step * (F.col("p_size") - 1)

        def text(amount: Column) -> Column:
            return F.concat(F.lit("$"), F.format_number(amount, 2), F.lit(" "))

        kinds = F.array(*[F.lit(t) for t in TYPES])
        return self.load("part").select(
            F.col("p_partkey").alias("productkey"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
            text(cost).alias("unit_cost_usd"),
            text(price).alias("unit_price_usd"),
            F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int").alias("subcategorykey"),
            F.col("p_brand").alias("subcategory"),
            F.array_position(kinds, F.col("p_type")).cast("int").alias("categorykey"),
            F.col("p_type").alias("category"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        key = F.col("s_suppkey")
        online = key == 0
        return self.load("supplier").join(self.load("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            key.alias("storekey"),
            F.when(online, "Online").otherwise(F.col("n_name")).alias("country"),
            F.when(online, "Online").otherwise(F.concat(F.lit("STATE_"), F.col("n_nationkey"))).alias("state"),
            F.when(~online, 500 + key * 13 % 1600).cast("decimal(18,2)").alias("square_meters"),
            F.date_add(F.lit("2005-01-01").cast("date"), (key * 97 % 4000).cast("int")).alias("open_date"),
        )

    @cached_property
    def order_days(self) -> DataFrame:
        return self.load("orders").select(F.to_date("o_orderdate").alias("day")).distinct()

    @cached_property
    def exchange_rates(self) -> DataFrame:
        """One row per order day and currency; some days lack the rates of all currencies but USD."""
        base = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(m).alias("base")) for c, m in BASE_RATES])
        doy = F.dayofyear("day")
        usd = F.col("currency") == "USD"
        milli = F.col("base") + F.when(usd, 0).otherwise(doy * 7 % 100)
        return (
            self.order_days.select("day", F.inline(base))
            .where(usd | (doy % 13 != 0))
            .select(
                (F.datediff("day", F.lit("1970-01-01")) * 100 + F.col("base") / 100).cast("bigint").alias("id"),
                F.date_format("day", "MM/dd/yyyy").alias("rate_date"),
                F.lower("currency").alias("currency"),
                (milli / 1000).cast(S.RATE).alias("exchange"),
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Order lines; the currency follows the customer's region."""
        regions = self.load("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), pick(S.CURRENCIES, F.col("n_regionkey")).alias("currency_code"))
        currency = self.load("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(
            regions, "c_nationkey").select("o_custkey", "currency_code")
        orders = self.load("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.to_date("o_orderdate").alias("order_date"))
        paid = attach(orders, currency, "o_custkey", rows=self.rows["customer"], hot_from=orders)
        lines = self.load("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
        shipped = F.to_date("l_shipdate")
        return attach(lines, paid, "l_orderkey", rows=self.rows["orders"], hot_from=lines).select(
            F.col("l_orderkey").alias("order_number"),
            F.col("l_linenumber").alias("line_item"),
            "order_date",
            F.when(shipped >= F.col("order_date"), shipped).alias("delivery_date"),
            F.col("o_custkey").alias("customerkey"),
            (F.col("o_custkey") % 10).alias("storekey"),
            F.col("l_partkey").alias("productkey"),
            F.col("l_quantity").cast("int").alias("quantity"),
            "currency_code",
        )

    # ---- events -------------------------------------------------------------------------

    def events_of(self, events: DataFrame) -> DataFrame:
        """The events table (batch or stream) as sales events, with the moment each one arrived."""
        eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
        ts = F.col("ts").cast("timestamp")
        price = F.col("value").cast("decimal(15,2)")
        quantity = (eid % 5 + 1).cast("int")
        return events.select(
            F.when(kind == "error", "CANCEL").when(kind == "signup", "RETURN").otherwise("ORDER").alias("event_type"),
            eid.alias("order_number"),
            (eid % 3 + 1).cast("int").alias("line_item"),
            F.concat(F.lit("O-"), eid).alias("order_serial"),
            F.date_format(ts, "dd-MM-yyyy 00:00:00").alias("order_date"),
            F.when(eid % 2 == 0, F.unix_millis(F.date_trunc("second", ts)) + 259_200_000).alias("delivery_date"),
            uid.alias("customerkey"),
            (uid % 10).alias("storekey"),
            (eid % 200).alias("productkey"),
            quantity.alias("quantity"),
            pick(S.CURRENCIES, uid % 5).alias("currency_code"),
            pick(S.PAYMENT_METHODS, eid % 4).alias("payment_method"),
            F.lit("CREATED").alias("status"),
            F.concat(uid, F.lit("-"), F.to_date(ts)).alias("order_group_id"),
            price.cast("double").alias("unit_price_usd"),
            (price * quantity).cast("double").alias("line_total_amount"),
            F.date_format(ts, S.EVENT_TIME_FORMAT).alias("event_timestamp"),
            (F.date_trunc("second", ts) + F.make_interval(secs=eid % 13)).alias("arrived_at"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.events_of(self.load("events"))

    def event_stream(self) -> DataFrame:
        # A pattern, because a stream takes a folder or a pattern and the table may be a single file.
        return bronze.file_stream(self.spark, f"{self.dir}/event[s].parquet", self.load("events").schema)

    def event_feed(self, parts: int = 3, days: int = 1) -> DataFrame:
        """The events as a stream of several parts, minutes out of order between them, and a last event ``days`` later.

        A micro-batch takes one part. The last event moves the watermark past all windows of the others; its own window stays open.
        """
        path, events = scratch_path(self.spark, "event-feed"), self.load("events")
        shifted = F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") * 37 % 240
        first, last = events.agg(F.min(shifted), F.max(shifted)).first()
        part = F.floor((shifted - first) * parts / (last - first + 1)).cast("int")
        closing = events.orderBy(F.desc("ts"), "event_id").limit(1).withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {days} DAY"))
        files = written_parts(events, part, parts, path)
        closing.select(*[F.col(f.name).cast(f.dataType) for f in events.schema.fields]).write.parquet(f"{path}/batch={parts}")
        return bronze.file_stream(self.spark, f"{path}/*", events.schema, max_files=files)

    def frames_of(self, events: DataFrame, seed_defects: bool = False) -> DataFrame:
        """Sales events as framed messages; ``seed_defects`` spoils some of them in five ways."""
        sales = self.events_of(events)
        eid = F.col("order_number")
        if seed_defects:
            sales = sales.withColumns({
                "event_type": F.when(eid % 79 == 0, "REFUND").otherwise(F.col("event_type")),
                "event_timestamp": F.when(eid % 73 == 0, "yesterday").otherwise(F.col("event_timestamp")),
            })
        payload = F.to_json(F.struct(*S.SALES_EVENT.names))
        sales = sales.select("*", once(decode.frame(payload), "framed"))
        value = F.col("framed")
        if seed_defects:
            value = (
                F.when(eid % 97 == 0, F.substring(value, 1, 3))
                .when(eid % 89 == 0, F.concat(F.unhex(F.lit("01")), F.substring(value, F.lit(2), F.length(value))))
                .when(eid % 83 == 0, F.substring(value, F.lit(1), F.floor(F.length(value) / 2).cast("int")))
                .otherwise(value)
            )
        return sales.select(F.col("order_serial").alias("key"), once(value, "value"), "arrived_at")

    # ---- silver and gold ----------------------------------------------------------------

    @cached_property
    def rows(self) -> dict[str, int]:
        return _Counts(self)

    @cached_property
    def silver_sales(self) -> DataFrame:
        return silver.sales(self.sales)

    @cached_property
    def silver_rates(self) -> DataFrame:
        return silver.exchange_rates(self.exchange_rates)

    @cached_property
    def days(self) -> DataFrame:
        """Whole years around the order dates."""
        return self.load("orders").agg(
            F.trunc(F.to_date(F.min("o_orderdate")), "year").alias("start"),
            F.add_months(F.trunc(F.to_date(F.max("o_orderdate")), "year"), 12).alias("end"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.customer(silver.customers(self.customers), self.rows["customer"])

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.product_info(silver.products(self.products), self.rows["part"])

    @cached_property
    def dim_stores(self) -> DataFrame:
        return dims.stores(silver.stores(self.stores), self.rows["supplier"])

    @cached_property
    def bounds(self) -> tuple:
        return tuple(self.days.first())

    @cached_property
    def known_days(self) -> DataFrame:
        """The bounds as literals, so that a calendar used twice does not read the orders twice."""
        first, after = self.bounds
        return self.spark.sql(f"SELECT DATE'{first}' AS start, DATE'{after}' AS end")

    def _star(self, product: DataFrame, store: DataFrame, customer: DataFrame, rates: DataFrame, date: DataFrame) -> facts.Star:
        return facts.Star(
            sales=self.silver_sales, product=product, store=store, customer=customer, rates=rates, date=date,
            rows={"product": self.rows["part"], "store": self.rows["supplier"], "customer": self.rows["customer"],
                  "rates": self.rows["rates"], "date": self.rows["days"]},
            hot_from={
                "order_number": self.load("lineitem").select(F.col("l_orderkey").alias("order_number")),
                "product_key": self.load("lineitem").select(F.col("l_partkey").alias("product_key")),
                "customer_key": self.load("orders").select(F.col("o_custkey").alias("customer_key")),
                "store_key": self.load("orders").select((F.col("o_custkey") % 10).alias("store_key"))})

    @cached_property
    def star(self) -> facts.Star:
        return self._star(
            self.dim_product, self.dim_stores, self.dim_customer,
            dims.exchange_rates(self.silver_rates, self.rows["rates"]), dims.date(self.known_days))

    @cached_property
    def star_compat(self) -> facts.Star:
        return self._star(
            self.dim_product, self.dim_stores, self.dim_customer,
            dims.exchange_rates_compat(self.silver_rates, self.rows["rates"]), dims.date_compat(self.known_days))

    @cached_property
    def published(self) -> dict[str, DataFrame]:
        """The gold tables as written, each on its first use; one build per folder serves all marts of a session."""
        return _Published(self)

    @cached_property
    def natural_star(self) -> facts.Star:
        """For marts, which never look at surrogate keys: the dimensions as they are before numbering."""
        def unkeyed(dim: DataFrame, key: str) -> DataFrame:
            return dim.withColumn(key, F.lit(None).cast("bigint"))

        return self._star(
            unkeyed(dims.product_columns(silver.products(self.products)), "product_sk"),
            unkeyed(dims.store_columns(silver.stores(self.stores)), "store_sk"),
            unkeyed(dims.customer_columns(silver.customers(self.customers)), "customer_sk"),
            unkeyed(dims.rate_columns(self.silver_rates), "exchange_sk"),
            dims.date(self.known_days))


class _Counts(dict):
    """Upper bounds for the sizes of the unique sides, counted on first use."""

    def __init__(self, inputs: Inputs):
        super().__init__()
        self.inputs = inputs

    def __missing__(self, name: str) -> int:
        if name in ("rates", "days"):
            first, after = self.inputs.bounds
            days = (after - first).days
            self.update(days=days, rates=days * len(BASE_RATES))
        else:
            self[name] = self.inputs.load(name).count()
        return self[name]


class _Published(dict):
    """Gold tables by name, built and written when first asked for: a mart over orders builds no product fact."""

    MAKE = {
        "dim_customer": lambda star: star.customer, "dim_product_info": lambda star: star.product, "dim_stores": lambda star: star.store,
        "dim_date": lambda star: star.date, "fact_sales": facts.order_fact, "fact_product_sales": facts.product_fact}

    def __init__(self, inputs: Inputs):
        super().__init__()
        self.inputs = inputs

    def __missing__(self, name: str) -> DataFrame:
        spark = self.inputs.spark
        place = spark.sparkContext.applicationId, self.inputs.dir, name
        if place not in _PUBLISHED:
            path = scratch_path(spark, f"gold-{name}")
            self.MAKE[name](self.inputs.star).write.option("compression", STORED).parquet(path)
            _PUBLISHED[place] = path
        self[name] = spark.read.parquet(_PUBLISHED[place])
        return self[name]
