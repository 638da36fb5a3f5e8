from __future__ import annotations

from pyspark.sql import functions as F

from tallyloft.plans import sketches


def test_quantiles_of_merged_sketches(spark):
    items = spark.range(200_000).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=(F.col("id") % 600).cast("int"))).alias("event_ts"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("N"), F.col("id") % 4)).alias("store_country"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(5000)).cast("int")).alias("processing_lag"))
    parts = sketches.lag_sketches(items).cache()
    assert parts.count() == parts.select("bucket", "store_country").distinct().count()
    hours = sketches.merged_lags(parts, F.date_trunc("hour", "bucket").alias("hour"))
    n = items.where("processing_lag IS NOT NULL").count()
    for whole in (sketches.merged_lags(parts), sketches.merged_lags(hours)):
        row = sketches.lag_quantiles(whole, p50=0.5, p95=0.95).first()
        assert (row.events, row.max_lag) == (n, 4999)
        for share, value in ((0.5, row.p50), (0.95, row.p95)):
            rank = items.where(F.col("processing_lag") <= value).count() / n
            assert abs(rank - share) <= sketches.LAG_RANK_ERROR + 1 / 5000
    assert sketches.lag_sketches(items.where("processing_lag IS NULL")).count() == 0


def test_reach_by_union_needs_no_orders(spark):
    orders = spark.range(120_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("order_date"), (F.col("id") % 8).alias("store_key"),
        F.lit(1).cast("decimal(19,2)").alias("total_price_usd"), F.pmod(F.xxhash64("id"), F.lit(30_000)).alias("customer_key"))
    stores = spark.range(8).select(F.col("id").alias("store_key"), F.when(F.col("id") < 6, F.concat(F.lit("N"), F.col("id") % 3)).alias("country"))
    daily = sketches.reach_sketches(orders, stores)
    assert daily.count() == daily.select("order_date", "country", "sales_channel").distinct().count()
    total = sketches.customer_reach(daily).where("level = 7").first()
    exact = orders.select("customer_key").distinct().count()
    assert total.orders == 120_000 and abs(total.customers - exact) <= 4 * sketches.REACH_ERROR * exact
    by_country = {r.country: r.customers for r in sketches.customer_reach(daily).where("level = 5").collect()}
    for r in orders.join(stores, "store_key").groupBy("country").agg(F.count_distinct("customer_key").alias("n")).collect():
        assert abs(by_country[r.country] - r.n) <= 4 * sketches.REACH_ERROR * r.n
