from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from harness.canonical import Inputs
from tallyloft.operators import quality as Q
from tallyloft.plans import batch, facts, gold_marts, incremental
from tallyloft.session import stage
from tallyloft.sources import bronze

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    x = Inputs(spark, SF)
    tables = {
        "customers": x.customers.withColumn("birthday", F.unix_millis(F.col("birthday").cast("timestamp"))),
        "products": x.products.withColumnsRenamed({"unit_cost_usd": "Unit_Cost_USD", "unit_price_usd": "Unit_Price_USD"}),
        "stores": x.stores, "exchange_rates": x.exchange_rates, "sales": x.sales}
    for name, df in tables.items():
        df.write.json(bronze.location(root, name))
    return root


def test_run_publishes_checked_layers(spark, landing, tmp_path):
    out = batch.run(spark, landing, str(tmp_path), "b1")
    assert out["silver_sales"].count() == 4599
    assert out["fact_sales"].count() == out["silver_sales"].select("order_number").distinct().count()
    price = out["fact_sales"].agg(F.sum("total_price_usd")).first()[0]
    assert price == out["fact_product_sales"].agg(F.sum("total_price_usd")).first()[0]
    assert "PartitionFilters: [isnotnull(year" in out["fact_sales"].where("year = 1999")._jdf.queryExecution().toString()
    again = batch.run(spark, landing, str(tmp_path), "b2")
    assert again["fact_sales"].drop("order_sk").exceptAll(out["fact_sales"].drop("order_sk")).count() == 0
    status = {(r.check, r.detail): r.status for r in batch.audit(again).collect()}
    assert status == {
        ("referential", "customer_key"): "passed", ("referential", "product_key"): "passed",
        ("referential", "store_key"): "passed", ("referential", "currency_code,order_date"): "failed",
        ("completeness", "order_number"): "passed", ("reconciliation", "quantity,total_price_usd"): "passed"}
    counted = {(r.model, r.column_name): (r.row_count, r.null_count) for r in out["null_rates"].collect()}
    assert counted["silver.sales", "quantity"] == (4599, 0) and counted["gold.fact_sales", "order_sk"][1] == 0
    assert out["mart_top_brands"].count() > 0 and out["mart_rfm"].count() == out["fact_sales"].select("customer_fk").distinct().count()
    bought = out["mart_revenue_quarter_category"].where("level = 7").first().revenue
    assert bought == price
    plan = gold_marts.product_mix(gold_marts.published_products(
        out["fact_product_sales"], out["dim_date"], out["dim_stores"], out["dim_product_info"]))._jdf.queryExecution().toString()
    assert "/landing" not in plan and "silver" not in plan


def test_unknown_keys_and_differing_facts_are_found(spark, landing, tmp_path):
    out = batch.run(spark, landing, str(tmp_path), "b1")
    poor = out | {"dim_product_info": out["dim_product_info"].where("product_key % 2 = 0")}
    with pytest.raises(Q.GateFailed, match="product_key"):
        Q.gate(Q.results(batch.key_findings(out["silver_sales"], poor)))
    short = out["fact_product_sales"].where("product_sale_sk > 1")
    found = {r.check: r.violations for r in Q.results(batch.fact_findings(out["silver_sales"], out["fact_sales"], short)).collect()}
    assert found == {"completeness": 0, "reconciliation": 1}


def test_failed_gate_keeps_the_live_build(spark, tmp_path):
    check = batch._key_checks("t", ["k"])
    good = spark.range(3).withColumnRenamed("id", "k")
    batch.Warehouse(spark, str(tmp_path), "1").publish("silver", "t", good, check)
    with pytest.raises(Q.GateFailed):
        batch.Warehouse(spark, str(tmp_path), "2").publish("silver", "t", good.unionAll(good), check)
    assert batch.Warehouse(spark, str(tmp_path), "3").read("silver", "t").count() == 3


def test_nulls_are_counted_by_the_write_and_gate_it(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") >= 3, F.lit("x")).alias("v"))
    wh = batch.Warehouse(spark, str(tmp_path), "1")
    with pytest.raises(Q.GateFailed, match=r"t.null_rate\(v\): 3 of 100"):
        wh.publish("silver", "t", df, required=["id"], nullable=[])
    assert wh.live("silver", "t") is None
    with pytest.raises(Q.GateFailed, match=r"t.not_null\(v\): 3"):
        wh.publish("silver", "t", df, required=["v"])
    # Below the limit, or allowed to be empty.
    assert wh.publish("silver", "t", df.where("id > 1"), required=["id"], nullable=[]).count() == 98
    assert wh.publish("silver", "u", df, nullable=["v"]).count() == 100
    assert {tuple(r) for r in wh.null_rates().where("model = 'silver.u'").collect()} == {("silver.u", "id", 100, 0), ("silver.u", "v", 100, 3)}
    assert wh.publish("silver", "none", df.limit(0), required=["id"], nullable=[]).count() == 0


def test_orders_are_shuffled_once(spark):
    plan = facts.order_measures(Inputs(spark, SF).natural_star)._jdf.queryExecution().toString()
    assert plan.count("hashpartitioning(order_number") == 1 and "SortMergeJoin" not in plan


def test_second_load_writes_changed_months_only(spark, tmp_path):
    x = Inputs(spark, SF)
    day = x.silver_sales.agg(F.min("order_date")).first()[0]
    first_month = [(day.year, day.month)]
    in_first = incremental.in_months(first_month, F.year("order_date"), F.month("order_date"))

    def load(sales):
        star = replace(x.star, sales=sales, hot_from={})
        return batch.load_facts(spark, str(tmp_path), star, ("fact_sales",))["fact_sales"]

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "gold/fact_sales_monthly/months").rglob("*.parquet")}

    without = x.silver_sales.where(~in_first)
    fact, written = load(without)
    assert len(written) > 12 and not set(first_month) & set(written)
    old, keys = files(), {r.order_number_bk: r.order_sk for r in fact.collect()}
    assert sorted(keys.values()) == list(range(1, len(keys) + 1))
    assert load(without)[1] == [] and files() == old

    fact, written = load(x.silver_sales)
    assert written == first_month
    assert {p: t for p, t in files().items() if p in old} == old
    rows = {r.order_number_bk: r.order_sk for r in fact.collect()}
    assert {n: k for n, k in rows.items() if n in keys} == keys
    assert sorted(k for n, k in rows.items() if n not in keys) == list(range(len(keys) + 1, len(rows) + 1))
    whole = facts.order_fact(replace(x.star, hot_from={})).drop("order_sk")
    assert fact.select(*whole.columns).exceptAll(whole).count() == 0 and fact.count() == whole.count()

    # A month that loses its orders disappears, and its orders get their keys back when they return.
    fact, written = load(without)
    assert written == [] and fact.count() == len(keys)
    assert {r.order_number_bk: r.order_sk for r in fact.collect()} == keys


def test_a_failed_check_leaves_the_fact_as_it_was(spark, tmp_path):
    fact = incremental.MonthlyFact(spark, str(tmp_path / "f"), "sk", ["n"])
    rows = spark.sql("SELECT n, DATE'2020-01-01' + CAST(n * 20 AS INT) AS order_date FROM VALUES (1), (2), (3) AS t(n)")
    make = lambda df: lambda months: incremental.with_month(df).where(incremental.in_months(months)).drop("order_date")
    assert fact.load(rows, make(rows)) == [(2020, 1), (2020, 2), (2020, 3)]

    def refuse(df):
        raise Q.GateFailed("no")

    more = rows.union(spark.sql("SELECT 4, DATE'2020-01-02'"))
    with pytest.raises(Q.GateFailed):
        fact.load(more, make(more), refuse)
    assert sorted((r.n, r.sk) for r in fact.read().collect()) == [(1, 1), (2, 2), (3, 3)]
    assert fact.load(more, make(more)) == [(2020, 1)]
    assert sorted((r.n, r.sk) for r in fact.read().collect()) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_nightly_run_by_month_keeps_all_keys(spark, landing, tmp_path):
    first = batch.run(spark, landing, str(tmp_path), "b1", monthly=True)
    sales, stores = ({(r[0], r[1]) for r in first[n].select(*c).collect()} for n, c in (
        ("fact_sales", ["order_number_bk", "order_sk"]), ("dim_stores", ["store_key", "store_sk"])))
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold/fact_sales_monthly/months").rglob("*.parquet")}
    again = batch.run(spark, landing, str(tmp_path), "b2", monthly=True)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "gold/fact_sales_monthly/months").rglob("*.parquet")} == files
    assert {(r[0], r[1]) for r in again["fact_sales"].select("order_number_bk", "order_sk").collect()} == sales
    assert {(r[0], r[1]) for r in again["dim_stores"].select("store_key", "store_sk").collect()} == stores
    grown = spark.createDataFrame([(k, None) for k in (-5, *[k for k, _ in stores])], "store_key bigint, store_sk bigint")
    kept = batch.same_keys(batch.Warehouse(spark, str(tmp_path), "b3"), "dim_stores", grown)
    assert {(r.store_key, r.store_sk) for r in kept.collect()} == stores | {(-5, len(stores) + 1)} and grown.columns == kept.columns


def test_a_broken_line_and_a_new_field_do_not_stop_the_night(spark, landing, tmp_path):
    root = str(tmp_path / "landing")
    for name in ("customers", "products", "stores", "exchange_rates", "sales"):
        spark.read.text(bronze.location(landing, name)).write.text(bronze.location(root, name))
    spark.createDataFrame([('{"storekey": 1, "coun',), ("[1]",), ("",)], "value string").write.mode("append").text(bronze.location(root, "stores"))
    line = '{"storekey": 990, "country": "X", "state": "Y", "square_meters": "wide", "open_date": "2005-01-01", "floor": 2}'
    spark.createDataFrame([(line,)], "value string").write.mode("append").text(bronze.location(root, "stores"))
    out = batch.run(spark, root, str(tmp_path / "wh"), "b1")
    assert sorted(r.line for r in out["rejected_stores"].collect()) == ["[1]", '{"storekey": 1, "coun']
    assert {(r.field, r.finding, r.lines) for r in out["drift_stores"].collect()} == {("floor", "unknown", 1), ("square_meters", "not decimal(18,2)", 1)}
    assert out["rejected_sales"].count() == 0 and out["drift_sales"].count() == 0
    assert out["dim_stores"].where("store_key = 990").count() == 1 and out["fact_sales"].count() > 0


def test_a_changed_member_loads_its_months_only(spark, tmp_path):
    x = Inputs(spark, SF)
    star = replace(x.star, hot_from={})
    product = stage(star.product, "product")
    orders = x.silver_sales.groupBy("product_key").agg(F.collect_set(F.struct(F.year("order_date"), F.month("order_date"))).alias("m"))
    key, months = orders.orderBy(F.size("m"), "product_key").first()

    def load(product):
        return batch.load_facts(spark, str(tmp_path), replace(star, product=product), ("fact_product_sales",))["fact_product_sales"]

    before, written = load(product)
    assert len(written) > 12
    keys = {r[:3]: r[3] for r in before.select("order_number_bk", "product_fk", "local_currency", "product_sale_sk").collect()}
    assert load(product)[1] == []
    dearer = product.withColumn("unit_price_usd", F.when(F.col("product_key") == key, F.col("unit_price_usd") + 1).otherwise(F.col("unit_price_usd")))
    after, written = load(dearer)
    assert written == sorted(tuple(m) for m in months)
    assert {r[:3]: r[3] for r in after.select("order_number_bk", "product_fk", "local_currency", "product_sale_sk").collect()} == keys
    whole = facts.product_fact(replace(star, product=dearer)).drop("product_sale_sk")
    assert after.select(*whole.columns).exceptAll(whole).count() == 0 and after.count() == whole.count()


def test_key_states_by_identity(frame):
    after = frame("a long, b long, c long, sk long, v string", (1, 1, None, 1, "x"), (1, None, 1, 2, "x"), (2, 1, 1, 3, "y"), (None, 1, 1, 4, "z"))
    before = frame("a long, b long, c long, first long", (1, 1, None, 1), (2, 1, 1, 9), (2, 1, 1, 3), (None, 1, 1, 5))
    got = incremental.with_key_state(after, before, ["a", "b", "c"], "sk", "first")
    assert sorted((r.sk, r.v, r.key_state) for r in got.collect()) == [(1, "x", "kept"), (2, "x", "new"), (3, "y", "kept"), (3, "y", "lost"), (4, "z", "lost")]
