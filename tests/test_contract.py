from __future__ import annotations

import pytest

import __spark_entry__ as entry
from harness.compare import compare, database
from harness.oracles import ORACLES
from harness.queries import QUERIES

SF = "/root/testdata/sf0.001"
# One query per family; the whole set runs through ``python -m harness.compare``.
SAMPLE = [
    "bronze_ndjson_customers", "silver_products", "silver_sales_dedup", "dim_date", "scd2_customer", "fact_sales",
    "fact_product_sales_compat", "fx_asof_sales", "fx_large_rates", "order_totals_exact", "stream_read_back", "mart_revenue_quarter_category", "mart_rfm", "stream_item_enrich",
    "stream_order_agg_windowed", "stream_dlq", "hot_items_latest", "mart_cancel_alerts", "dq_referential", "dq_run_summary"]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLES.keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "quarter", "category", "revenue", "growth", "level"] and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    same, note = compare(spark, database(SF), name, SF)
    assert same, note
