"""Bronze readers: NDJSON and CSV files, database tables, topics. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloft import schemas as S
from tallyloft.functions.scalar import epoch_ms_date

CORRUPT = "_corrupt_record"


def location(root: str, table: str) -> str:
    """One folder per table below the landing root."""
    if table not in S.BRONZE:
        raise KeyError(f"unknown bronze table {table!r}; known: {sorted(S.BRONZE)}")
    return f"{root.rstrip('/')}/{table}/"


def ndjson(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Compression follows the file suffix; a broken line keeps its text in ``_corrupt_record``."""
    schema = T.StructType(S.BRONZE[table].fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def rejected_lines(raw: DataFrame) -> DataFrame:
    """Lines that are no JSON object; the other columns stay, since Spark reads this one only beside them."""
    return raw.where(F.col(CORRUPT).isNotNull())


def typed(raw: DataFrame, table: str) -> DataFrame:
    """The declared columns of a bronze table, out of its raw lines."""
    if table == "customers":
        raw = raw.withColumn("birthday", epoch_ms_date(F.col("birthday")))
    if table == "products":
        raw = raw.withColumnsRenamed({"Unit_Cost_USD": "unit_cost_usd", "Unit_Price_USD": "unit_price_usd"})
    return raw.drop(CORRUPT)


def variants(spark: SparkSession, path: str) -> DataFrame:
    """Landed lines, parsed once: ``line`` is kept where it is no JSON object, ``v`` holds the others as VARIANT."""
    parsed = spark.read.text(path).select(F.col("value").alias("line"), F.try_parse_json("value").alias("v"))
    # What is sound JSON and begins with a brace is an object; deriving a schema per line would cost as much as the parse.
    is_object = F.col("v").isNotNull() & F.ltrim("line", F.lit(" \t")).startswith("{")
    return parsed.where(F.trim("line") != "").select(F.when(~is_object, F.col("line")).alias("line"), F.when(is_object, F.col("v")).alias("v"))


def from_variants(lines: DataFrame, table: str) -> DataFrame:
    """The declared columns by path, NULL where a value is missing or does not fit its type."""
    fields = S.BRONZE[table].fields
    return typed(lines.where("v IS NOT NULL").select(*[
        F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]), table)


def rejected_variants(lines: DataFrame) -> DataFrame:
    return lines.where("line IS NOT NULL").select("line")


def drift(lines: DataFrame, table: str) -> DataFrame:
    """Fields that nobody declared, and declared ones whose value is there but does not fit: field, finding, lines."""
    fields = S.BRONZE[table].fields
    objects = lines.where("v IS NOT NULL")
    # Declared names are left out before the rows are multiplied.
    names = F.array_except(F.map_keys(F.col("v").cast("map<string,variant>")), F.array(*[F.lit(f.name) for f in fields]))
    unknown = objects.select(F.explode(names).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("lines"))

    def misfit(f: T.StructField) -> Column:
        kind, path = f.dataType.simpleString(), f"$.{f.name}"
        there = F.try_variant_get("v", path, "variant")
        # First what most values decide: they fit, and are not looked up again.
        return F.try_variant_get("v", path, kind).isNull() & there.isNotNull() & ~F.is_variant_null(there)

    # One pass for all fields: a row of counts, turned on its side.
    counts = objects.agg(*[F.count_if(misfit(f)).alias(f.name) for f in fields])
    turned = counts.select(F.inline(F.array(*[F.struct(
        F.lit(f.name).alias("field"), F.lit(f"not {f.dataType.simpleString()}").alias("finding"), F.col(f.name).alias("lines")) for f in fields])))
    return unknown.select("field", F.lit("unknown").alias("finding"), "lines").unionByName(turned.where("lines > 0"))


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return typed(ndjson(spark, location(root, name), name), name)


def csv_stores(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(S.BRONZE["stores"])
        .option("header", True)
        .option("enforceSchema", True)
        .option("dateFormat", "M/d/yyyy")
        .csv(path)
    )


def csv_data_dictionary(spark: SparkSession, path: str) -> DataFrame:
    schema = S.struct(table_name=S.STR, field_name=S.STR, description=S.STR)
    return spark.read.schema(schema).options(header=True, enforceSchema=True, escape='"').csv(path)


def register(spark: SparkSession, root: str) -> list[str]:
    """Give every bronze table its logical name, so SQL can say ``FROM sales_ext``."""
    names = []
    for name in S.BRONZE:
        view = f"{name}_ext"
        table(spark, root, name).createOrReplaceTempView(view)
        names.append(view)
    return names


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    properties: dict[str, str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 8,
) -> DataFrame:
    """A database table; with ``split_on`` it is read by several tasks at once."""
    if split_on is None:
        return spark.read.jdbc(url, name, properties=properties)
    low, high = bounds
    return spark.read.jdbc(
        url, name, column=split_on, lowerBound=low, upperBound=high, numPartitions=splits, properties=properties)


def topic_options(
    servers: str, topic: str, start: str = "earliest", min_partitions: int | None = None, max_messages: int | None = None
) -> dict[str, str]:
    """``max_messages`` bounds a micro-batch, so that the first one from the start does not take the whole topic."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_messages:
        options["maxOffsetsPerTrigger"] = str(max_messages)
    return options


def topic_stream(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Needs the Kafka connector on the classpath. A micro-batch takes ``max_messages`` at most, 10 million unless stated."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **{"max_messages": 10_000_000, **kwargs})).load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, **options) -> DataFrame:
    """Files dropped into a folder, read as a stream; stands in for a topic."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def date_spine(bounds: DataFrame, start: Column | str = "start", end: Column | str = "end") -> DataFrame:
    """One row per day from ``start`` up to, but not including, ``end``; ``bounds`` holds one row.

    ``date_sk`` is the day's place in the spine, so it is dense without any sort.
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    days = F.sequence(start, F.date_sub(end, 1))
    return bounds.select(F.posexplode(days).alias("pos", "date_key")).select(
        (F.col("pos") + 1).cast("bigint").alias("date_sk"), "date_key")
