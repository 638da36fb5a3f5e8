from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloft.functions import scalar
from tallyloft.operators import clean
from tallyloft.plans import dims, silver


def test_money_strings(frame):
    df = frame("raw string", ("$6.62 ",), (" $1,234.50",), ("",), ("abc",), (None,))
    rows = df.select(scalar.money(F.col("raw")).alias("m"), scalar.is_bad_text(F.col("raw")).alias("bad")).collect()
    assert [r.m for r in rows] == [Decimal("6.62"), Decimal("1234.50"), None, None, None]
    assert [bool(r.bad) for r in rows] == [False, False, False, True, False]


def test_expensive_flag(frame):
    df = frame("p decimal(15,2)", (Decimal("100.00"),), (Decimal("100.01"),), (None,))
    assert [r.f for r in df.select(scalar.expensive_flag(F.col("p")).alias("f")).collect()] == ["No", "Yes", "No"]


def test_epoch_birthday(frame):
    df = frame("b string", ("946684800000",), ("-86400000",), ("x",))
    assert [r.b for r in df.select(scalar.epoch_ms_date(F.col("b")).alias("b")).collect()] == [date(2000, 1, 1), date(1969, 12, 31), None]


def test_rate_days_of_any_century(frame):
    bronze = frame("rate_date string, currency string, exchange string", ("02/03/2071", "eur", "1"), ("02/03/1969", "eur", "1"))
    rows = dims.exchange_rates(silver.exchange_rates(bronze), 2).orderBy("exchange_sk").collect()
    assert [r.date_key for r in rows] == [date(1969, 2, 3), date(2071, 2, 3)]


def test_amounts_are_exact(frame):
    df = frame("q int, p double", (100, 1.005), (3, 0.335), (1, float("nan")), (1, float("inf")), (7, 123456789012.34))
    assert [r.t for r in df.select(scalar.line_amount(F.col("q"), F.col("p")).alias("t")).collect()] == [100.5, 1.01, None, None, 864197523086.38]
    row = frame("u string, r string", ("123456789012345.67", "1100000.5")).select(
        scalar.local_amount(F.col("u").cast("decimal(36,2)"), F.col("r").cast("decimal(18,6)")).alias("x")).first()
    assert row.x == Decimal("123456789012345.67") * Decimal("1100000.5")


def test_iso_time(frame):
    df = frame("t string", ("2025-01-02T03:04:05.000Z",), ("2025-01-02T03:04:05+02:00",), ("",), ("soon",))
    rows = df.select(F.date_format(scalar.iso_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [r.t for r in rows] == ["2025-01-02 03:04:05", "2025-01-02 01:04:05", None, None]


def test_margin_of_zero_price_is_null(frame):
    df = frame("c decimal(15,2), p decimal(15,2)", (Decimal("1"), Decimal("0")), (Decimal("1"), Decimal("4")))
    assert [r.m for r in df.select(scalar.margin(F.col("c"), F.col("p")).alias("m")).collect()] == [None, 0.75]


def test_channel(frame):
    df = frame("k long", (0,), (5,), (None,))
    assert [r.c for r in df.select(scalar.sales_channel(F.col("k")).alias("c")).collect()] == [
        "Online", "In-Store", "In-Store"]


def test_rates_reformatted(frame):
    df = frame("id long, rate_date string, currency string, exchange decimal(18,6)", (1, "02/15/2016", "gbp", Decimal("0.7")))
    row = silver.exchange_rates(df).first()
    assert (row.rate_date, row.currency, row.exchange_rate_usd) == ("15-02-16", "GBP", Decimal("0.700000"))


def test_trim_and_defaults(frame):
    df = frame("a string, b string, n int", ("  x ", "   ", 1), (None, "y", None))
    assert [tuple(r) for r in clean.fill_nulls(clean.trim_strings(df), {"b": "?"}).collect()] == [
        ("x", "?", 1), (None, "y", None)]


def test_sales_once_keeps_one_row_per_line(frame):
    schema = ("order_number long, line_item int, order_date date, delivery_date date, customer_key long, store_key long, "
              "product_key long, quantity int, currency_code string")
    d = date(2020, 1, 1)
    df = frame(schema, (1, 1, d, None, 1, 1, 1, 1, "USD"), (1, 1, d, date(2020, 1, 5), 1, 1, 9, 2, "USD"),
               (1, 1, d, date(2020, 1, 5), 1, 1, 9, 2, "USD"), (1, 2, d, None, 1, 1, 3, 1, "USD"))
    rows = silver.sales_once(df).orderBy("line_item").collect()
    assert [(r.line_item, r.product_key) for r in rows] == [(1, 9), (2, 3)]
    assert silver.sales_once(df).columns == df.columns
