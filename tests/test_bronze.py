from __future__ import annotations

import gzip
from datetime import date
from decimal import Decimal

import pytest

from tallyloft.sources import bronze


def test_ndjson_mixed_case_and_broken_line(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    good = ('{"productkey":1,"product_name":"TV","brand":"B","color":"red","Unit_Cost_USD":"$1.00 ","Unit_Price_USD":"$2.00 ",'
            '"subcategorykey":1,"subcategory":"S","categorykey":1,"category":"C"}')
    (folder / "a.json").write_text(good + "\n{broken\n")
    raw = bronze.ndjson(spark, str(folder), "products")
    assert [r[bronze.CORRUPT] for r in bronze.rejected_lines(raw).collect()] == ["{broken"]
    rows = bronze.table(spark, str(tmp_path), "products").where("productkey IS NOT NULL").collect()
    assert [(r.unit_cost_usd, r.unit_price_usd) for r in rows] == [("$1.00 ", "$2.00 ")]


def test_ndjson_compressed_customers(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    line = '{"customerkey":7,"gender":"Male","name":"N","birthday":0}\n{"customerkey":8,"birthday":"86400000"}\n'
    with gzip.open(folder / "a.json.gz", "wt") as f:
        f.write(line)
    rows = bronze.table(spark, str(tmp_path), "customers").orderBy("customerkey").collect()
    assert [(r.customerkey, r.birthday) for r in rows] == [(7, date(1970, 1, 1)), (8, date(1970, 1, 2))]


def test_unknown_table():
    with pytest.raises(KeyError):
        bronze.location("/landing", "nothing")


def test_registered_names(spark, tmp_path):
    for name in bronze.S.BRONZE:
        (tmp_path / name).mkdir()
    (tmp_path / "stores" / "a.json").write_text(
        '{"storekey":0,"country":"Online","state":"Online","square_meters":null,"open_date":"2010-01-01"}\n')
    assert "stores_ext" in bronze.register(spark, str(tmp_path))
    assert spark.sql("SELECT storekey, open_date FROM stores_ext").collect() == [(0, date(2010, 1, 1))]


def test_csv_files(spark, tmp_path):
    stores = tmp_path / "stores.csv"
    stores.write_text("StoreKey,Country,State,Square Meters,Open Date\n1,Spain,Soria,595,1/12/2008\n0,Online,Online,,1/1/2010\n")
    rows = bronze.csv_stores(spark, str(stores)).orderBy("storekey").collect()
    assert [tuple(r) for r in rows] == [
        (0, "Online", "Online", None, date(2010, 1, 1)), (1, "Spain", "Soria", Decimal("595.00"), date(2008, 1, 12))]
    words = tmp_path / "dictionary.csv"
    words.write_text('Table,Field,Description\nSales,Quantity,"Items, all of them"\n')
    assert bronze.csv_data_dictionary(spark, str(words)).collect() == [("Sales", "Quantity", "Items, all of them")]


def test_topic_options():
    options = bronze.topic_options("h:1", "t", start="latest", min_partitions=24)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "minPartitions": "24"}
    assert bronze.topic_options("h:1", "t", max_messages=500)["maxOffsetsPerTrigger"] == "500"


def test_spine_stops_before_its_end(spark):
    from tallyloft.plans import dims

    days = bronze.date_spine(dims.standard_bounds(spark.range(1)))
    low, high, n, top = days.selectExpr("min(date_key)", "max(date_key)", "count(*)", "max(date_sk)").first()
    assert (low, high, n, top) == (date(2015, 1, 1), date(2021, 12, 30), 2556, 2556)


def test_only_objects_are_variants(spark, tmp_path):
    lines = [' \t{"order_number": 1, "coupon": "C"}', '{"order_number": "x"}', '{"order_number": null}', "[{}]", '"{}"', "7", '{"order', "null", " "]
    spark.createDataFrame([(s,) for s in lines], "value string").coalesce(1).write.text(str(tmp_path / "sales"))
    found = bronze.variants(spark, str(tmp_path / "sales"))
    assert sorted(r.line for r in bronze.rejected_variants(found).collect()) == sorted(["[{}]", '"{}"', "7", '{"order', "null"])
    assert found.where("v IS NOT NULL").count() == 3
    assert sorted(map(tuple, bronze.drift(found, "sales").collect())) == [("coupon", "unknown", 1), ("order_number", "not bigint", 1)]
