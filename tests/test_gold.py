from __future__ import annotations

from collections import Counter
from dataclasses import replace
from datetime import date as _date

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloft.operators import fx, joins, scd2
from tallyloft.session import stage
from tallyloft.plans import dims, facts, gold_marts

SALES = ("order_number long, line_item int, order_date date, delivery_date date, customer_key long, store_key long, "
         "product_key long, quantity int, currency_code string")
DAY = date(2020, 3, 2)


@pytest.fixture
def star(spark, frame):
    def make(*lines, prices=((1, "4.00", "10.00"), (2, "1.00", "2.00")), rates=((DAY, "GBP", "0.8"),), compat=False):
        rows = [(n, i, d, s, c, st, p, q, cur) for n, i, d, s, c, st, p, q, cur in lines]
        product = frame("product_key long, c string, p string", *prices).select(
            "product_key", F.col("product_key").alias("product_sk"), F.col("c").cast("decimal(15,2)").alias("unit_cost_usd"),
            F.col("p").cast("decimal(15,2)").alias("unit_price_usd"))
        rate = frame("date_key date, currency_code string, r string", *rates).select(
            "date_key", "currency_code", F.col("r").cast("decimal(18,6)").alias("rate"), F.lit(5).cast("bigint").alias("exchange_sk"))
        bounds = spark.sql("SELECT DATE'2020-01-01' AS start, DATE'2021-01-01' AS end")
        return facts.Star(
            sales=frame(SALES, *rows), product=product,
            store=frame("store_key long, store_sk long", (0, 1), (3, 2)),
            customer=frame("customer_key long, customer_sk long", (8, 1)),
            rates=rate, date=dims.date_compat(bounds) if compat else dims.date(bounds),
            rows={"product": 2, "store": 2, "customer": 1, "rates": 1, "date": 366})

    return make


def line(order=1, item=1, delivered=None, product=1, quantity=1, currency="GBP", day=DAY):
    return (order, item, day, delivered, 8, 3, product, quantity, currency)


def test_split_delivery(star):
    lines = (line(item=1, delivered=date(2020, 3, 5), quantity=3), line(item=2, delivered=date(2020, 3, 9), quantity=5))
    new = facts.order_fact(star(*lines)).first()
    assert (new.total_quantity, new.total_price_usd, new.number_of_items, new.line_count) == (8, Decimal("80.00"), 2, 2)
    assert new.delivery_date_fk == 69 and new.order_date_fk == 62
    assert new.total_price_local == Decimal("64.00") and new.total_profit_local == Decimal("38.40")
    old = facts.order_fact_compat(star(*lines, compat=True)).first()
    assert (old.total_quantity, old.order_date_fk, old.delivery_date_fk) == (5, 62 * 8, 69 * 8)


@pytest.mark.parametrize("second,new_q,old_q,old_lines", [(2, 4, 2, 1), (3, 5, 3, 2)])
def test_repeated_product(star, second, new_q, old_q, old_lines):
    lines = (line(item=1, quantity=2), line(item=2, quantity=second))
    new = facts.product_fact(star(*lines)).first()
    assert (new.p_quantity, new.total_line_items) == (new_q, 2)
    old = facts.product_fact_compat(star(*lines, compat=True)).first()
    assert (old.p_quantity, old.total_line_items) == (old_q, old_lines)


def test_missing_rate(star):
    lines = (line(day=date(2020, 3, 3)),)
    assert facts.order_fact(star(*lines)).first().total_price_local is None
    assert facts.product_fact(star(*lines)).first().total_price_local is None
    assert facts.product_fact_compat(star(*lines, compat=True)).count() == 0


def test_zero_price_and_sparse_lines(star):
    lines = (line(item=1), line(item=4))
    s = star(*lines, prices=((1, "0.00", "0.00"), (2, "1.00", "1.00")))
    assert facts.product_fact(s).first().profit_margin is None
    row = facts.order_fact(s).first()
    assert (row.number_of_items, row.line_count) == (4, 2)


def test_large_product_side_gives_the_same_orders(star):
    lines = [line(order=o, item=i, product=1 + (o + i) % 2, quantity=i, delivered=date(2020, 3, 4 + i)) for o in range(40) for i in (1, 2, 3)]
    s = star(*lines)
    small = facts.order_measures(s)
    s.rows["product"] = None
    big = facts.order_measures(s)
    assert small.select(*big.columns).exceptAll(big).count() == 0 and big.count() == 40
    kinds = {f.name: f.dataType for f in small.schema.fields}
    assert kinds == {f.name: f.dataType for f in big.schema.fields}
    assert kinds["total_price_usd"].simpleString() == "decimal(19,2)" and kinds["total_price_local"].simpleString() == "decimal(38,8)"


def test_revenue_is_kept(star):
    lines = [line(order=o, item=i, product=1 + (o * i) % 2, quantity=o + i) for o in range(1, 30) for i in (1, 2)]
    s = star(*lines)
    want = sum((10 if p == 1 else 2) * q for _, _, _, _, _, _, p, q, _ in lines)
    for fact in (facts.order_fact(s), facts.product_fact(s)):
        assert fact.agg(F.sum("total_price_usd")).first()[0] == want
    keys = facts.product_fact(s)
    assert keys.selectExpr("min(product_sale_sk)", "max(product_sale_sk)", "count(*)").first() == (1, keys.count(), keys.count())


def test_calendar_holidays(spark):
    bounds = dims.standard_bounds(spark.range(1))
    by_day = {r.date_key: r for r in dims.date(bounds).where("date_key IN ('2015-01-01', '2015-07-04', '2015-03-02')").collect()}
    assert by_day[date(2015, 1, 1)].holiday_names == [
        "FR - New Year's Day", "NL - New Year's Day", "UK - New Year's Day", "US - New Year's Day"]
    assert by_day[date(2015, 7, 4)].holiday_names == ["US - Independence Day"]
    assert by_day[date(2015, 3, 2)].holiday_names == [] and by_day[date(2015, 3, 2)].is_holiday == 0
    compat = dims.date_compat(bounds)
    assert compat.count() == 20_448 and compat.groupBy("date_key").count().where("count <> 8").count() == 0
    assert compat.selectExpr("count(DISTINCT date_sk)", "max(date_sk)").first() == (20_448, 20_448)
    assert dims.holiday(bounds).where("date_key = '2015-01-01'").count() == 4


def test_rate_key_order(frame):
    silver = frame("rate_date string, currency string, e string", ("01-02-15", "EUR", "1"), ("02-01-15", "EUR", "1")).withColumns({
        "exchange_rate_usd": F.col("e").cast("decimal(18,6)"), "rate_day": F.to_date("rate_date", "dd-MM-yy")})
    assert [r.date_key for r in dims.exchange_rates(silver, 2).orderBy("exchange_sk").collect()] == [date(2015, 1, 2), date(2015, 2, 1)]
    assert [r.date_key for r in dims.exchange_rates_compat(silver, 2).orderBy("exchange_sk").collect()] == [
        date(2015, 2, 1), date(2015, 1, 2)]


def test_last_known_rate(frame):
    rates = frame("currency_code string, date_key date, r string", ("GBP", date(2020, 1, 1), "0.8"), ("GBP", date(2020, 1, 4), "0.9")).select(
        "currency_code", "date_key", F.col("r").cast("decimal(18,6)").alias("rate"))
    daily = fx.daily_rates(rates, F.lit("2020-01-06").cast("date"))
    assert daily.count() == 6
    lines = frame("currency_code string, order_date date, usd int", ("GBP", date(2020, 1, 3), 20), ("GBP", date(2020, 1, 6), 10),
                  ("GBP", date(2019, 12, 31), 10)).withColumn("price_usd", F.col("usd").cast("decimal(15,2)"))
    rows = fx.normalise(lines, daily, ["price_usd"]).orderBy("order_date").collect()
    assert [(r.rate_date_used, r.price_local) for r in rows] == [
        (None, None), (date(2020, 1, 1), Decimal("16.00000000")), (date(2020, 1, 4), Decimal("9.00000000"))]


def test_scd2(frame):
    schema = "customer_key long, city string, name string"
    history = scd2.opening(frame(schema, (1, "A", "n"), (2, None, "m")), "2020-01-01")

    def fold(h, day, *rows):
        return scd2.apply_snapshot(h, frame(schema, *rows), "customer_key", ["city"], day)

    moved = fold(history, "2020-02-01", (1, "B", "n"), (2, None, "m"), (3, "C", "k"))
    rows = [tuple(r) for r in moved.orderBy("customer_key", "valid_from").collect()]
    first, second = date(2020, 1, 1), date(2020, 2, 1)
    assert rows == [(1, "A", "n", first, second, False), (1, "B", "n", second, None, True),
                    (2, None, "m", first, None, True), (3, "C", "k", second, None, True)]
    again = fold(moved, "2020-03-01", (1, "B", "n"), (2, None, "m"), (3, "C", "k"))
    assert sorted(map(str, again.collect())) == sorted(map(str, moved.collect()))
    late = fold(again, "2020-01-15", (1, "Z", "n"))
    assert sorted(map(str, late.collect())) == sorted(map(str, moved.collect()))
    back = fold(again, "2020-04-01", (2, "D", "m"))
    assert back.where("customer_key = 2").count() == 2
    overlaps = back.alias("a").join(back.alias("b"), F.expr(
        "a.customer_key = b.customer_key AND a.valid_from < b.valid_from AND coalesce(a.valid_to, DATE'9999-01-01') > b.valid_from"))
    assert overlaps.count() == 0


def test_scd2_null_key_and_columns_that_are_not_tracked(frame):
    schema = "customer_key long, city string, name string"
    history = scd2.opening(frame(schema, (None, "A", "n"), (1, "B", "old")), "2020-01-01")
    for day in ("2020-02-01", "2020-03-01"):
        history = scd2.apply_snapshot(history, frame(schema, (None, "A", "n"), (1, "B", "new")), "customer_key", ["city"], day)
    assert sorted(((r.customer_key, r.name, r.is_current) for r in history.collect()), key=str) == [(1, "new", True), (None, "n", True)]
    late = scd2.apply_snapshot(history, frame(schema, (1, "B", "older")), "customer_key", ["city"], "2019-01-01")
    assert late.where("customer_key = 1").first().name == "new"


def test_growth_needs_the_quarter_before(frame):
    sold = frame("order_date date, category string, usd int", (date(2020, 1, 5), "a", 10), (date(2020, 4, 5), "a", 15), (date(2020, 12, 5), "a", 30),
                 (date(2021, 2, 1), "a", 60)).withColumn("total_price_usd", F.col("usd").cast("decimal(19,2)"))
    rows = gold_marts.revenue_by_quarter_category(sold).where("level = 0").orderBy("year", "quarter").collect()
    assert [r.growth for r in rows] == [None, 0.5, None, 1.0]


def test_rfm_scores_are_fifths_without_a_sort(spark):
    orders = spark.range(3000).select(
        (F.col("id") % 97).alias("customer_key"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
        (F.pmod(F.xxhash64("id"), F.lit(100))).cast("decimal(15,2)").alias("total_price_usd"),
        F.lit(1).cast("decimal(15,2)").alias("total_profit_usd"))
    day = F.lit("2021-01-01").cast("date")
    scored = gold_marts.rfm(orders, day)
    assert scored.count() == 97
    for score, order in (("r_score", F.desc("recency_days")), ("f_score", F.asc("frequency")), ("m_score", F.asc("monetary"))):
        want = scored.withColumn("want", F.ntile(5).over(Window.orderBy(order, "customer_key")))
        assert want.where(F.col("want") != F.col(score)).count() == 0
    plan = scored._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


def test_age_bands(frame):
    df = frame("b date", (date(1977, 1, 2),), (date(1977, 1, 1),), (date(1930, 1, 1),), (None,))
    bands = [r[0] for r in df.select(gold_marts.age_band(F.col("b"), F.lit("2002-01-01").cast("date"))).collect()]
    assert bands == ["under 25", "25-34", "65 and over", "unknown"]


def test_history_from_snapshots_in_any_order(spark, frame):
    """Every order of arrival, one by one or together, gives the history of the sorted snapshots."""
    schema = "k int, city string, note string, day string"
    days = {1: [(1, "A", "a"), (None, "X", "x")], 2: [(1, "A", "b"), (2, "P", "p")], 3: [(1, "B", "c"), (None, "Y", "y")],
            4: [(1, "A", "d")], 5: [(1, "A", "e"), (2, "P", "q"), (None, "Y", "z")]}

    def snapshots(*numbers):
        return frame(schema, *[(*row, f"2020-01-0{n}") for n in numbers for row in days[n]])

    def rows(df):
        return sorted(map(str, df.select("k", "city", "note", "valid_from", "valid_to", "is_current").collect()))

    want = rows(scd2.merged(snapshots(1, 2, 3, 4, 5), "k", ["city"], "day"))
    assert len(want) == 3 + 1 + 2
    for groups in ([(5,), (3, 1), (4, 2)], [(1, 2), (5, 4), (3,), (3, 1)], [(4,), (5,), (1,), (2,), (3,)]):
        history = None
        for numbers in groups:
            history = stage(scd2.merged(snapshots(*numbers), "k", ["city"], "day", history), "history")
        assert rows(history) == want
    late = scd2.merged(frame(schema, (2, "R", "r", "2020-01-03")), "k", ["city"], "day", history)
    assert sorted((r.city, str(r.valid_from), str(r.valid_to)) for r in late.where("k = 2").collect()) == [
        ("P", "2020-01-02", "2020-01-03"), ("P", "2020-01-05", "None"), ("R", "2020-01-03", "2020-01-05")]
    assert late.where("k = 1").count() == 3

    facts_ = frame("n int, k int, d date", *[(i, k, _date(2020, 1, d)) for i, (k, d) in enumerate([(1, 1), (1, 3), (1, 9), (2, 1), (2, 4), (3, 4)])])
    got = scd2.valid_on(facts_, late, "k", "d", ["city"])
    assert [r.city for r in got.orderBy("n").collect()] == ["A", "B", "A", None, "R", None]
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_a_snapshot_row_that_comes_many_times_and_rows_without_a_day(spark, frame):
    many = spark.range(3000).selectExpr("1 AS k", "'A' AS city", "CAST(id % 3 AS STRING) AS note", "'2020-01-01' AS day")
    none = frame("k int, city string, note string, day string", (1, "Z", "z", None))
    assert [(r.city, r.note) for r in scd2.merged(many.unionByName(none), "k", ["city"], "day").collect()] == [("A", "2")]
    assert scd2.merged(none, "k", ["city"], "day").count() == 0


def test_product_fact_moves_lines_once(star, spark):
    lines = [line(order=o, item=i, product=1 + (o + i) % 3, quantity=o % 7 + i, delivered=date(2020, 3, 4 + i)) for o in range(300) for i in (1, 2, 3, 4)]
    s = star(*lines)
    plan = facts.product_parts(s)._jdf.queryExecution().toString()
    plan = plan[plan.index("== Physical Plan"):]
    assert plan.count("rangepartitioning(order_number") == 1 and "hashpartitioning" not in plan
    assert "total_price_usd" not in plan

    together = facts.product_fact(s).collect()
    apart = star(*lines)
    apart.rows["product"], apart.apart = None, True
    hot = star(*lines)
    hot.hot_orders = True
    for other in (apart, hot):
        assert not other.in_ranges and sorted(facts.product_fact(other).collect()) == sorted(together)
    # Product 3 is unknown: its lines count in their order, and make no row.
    assert {r.total_line_items for r in together} == {4} and {r.product_fk for r in together} == {1, 2}
    keys = [r.product_sale_sk for r in sorted(together, key=lambda r: (r.order_number_bk, r.product_fk))]
    assert keys == list(range(1, len(together) + 1))


def test_lines_without_an_order_number_are_left_out(star):
    lines = [line(order=o, item=1) for o in [*range(200), None]]
    assert facts.product_fact(star(*lines)).count() == 200


def _with_many_members(star, frame, compat=False):
    """Products and customers too many for a broadcast by their counts; some come twice, some are unknown, as are some stores and days."""
    lines = [(o, i, date(2019, 5, 5) if o % 41 == 7 else DAY, date(2020, 3, 4 + i % 3) if i % 2 else None, None if o % 29 == 3 else 6 + o % 5,
              4 if o % 31 == 5 else 3, None if o % 37 == 2 else 1 + (o + i // 2) % 4, 1 + (o * i) % 5, "EUR" if o % 23 == 4 else "GBP")
             for o in range(200) for i in (1, 2, 3, 4, 5)]
    small = star(*lines, *lines[:40], (None, 1, DAY, None, 8, 3, 1, 2, "GBP"), compat=compat)
    product = small.product.unionByName(small.product.where("product_key = 1").withColumns({
        "product_sk": F.lit(7).cast("bigint"), "unit_price_usd": F.lit("12.00").cast("decimal(15,2)")})).unionByName(
        small.product.limit(1).withColumns({"product_sk": F.lit(8).cast("bigint"), "product_key": F.lit(None).cast("bigint")}))
    customer = frame("customer_key long, customer_sk long", (6, 1), (7, 2), (8, 3), (8, 4), (None, 5), (10, 6))
    small = replace(small, product=product, customer=customer)
    beyond = joins.BROADCAST_ROWS + 1
    return small, replace(small, rows=small.rows | {"product": beyond, "customer": beyond})


def _plan(df):
    plan = df._jdf.queryExecution().toString()
    return plan[plan.index("== Physical Plan"):]


def test_many_products_and_customers_give_the_same_facts(star, frame):
    small, large = _with_many_members(star, frame)
    hot = replace(large)
    hot.hot_orders = True
    assert large.in_late_ranges and large.orders_in_ranges and not large.in_ranges and not hot.in_late_ranges
    together = replace(large, shared=True)
    for make, key in ((facts.product_fact, "product_sale_sk"), (facts.order_fact, "order_sk")):
        want = Counter(make(hot).drop(key).collect())
        assert sum(want.values()) > 100 and want == Counter(make(small).drop(key).collect())
        for other in (large, together):
            got = make(other)
            rows = got.orderBy(key).collect()
            assert Counter(got.drop(key).collect()) == want and [r[key] for r in rows] == list(range(1, len(rows) + 1))
            numbers = [r.order_number_bk for r in rows]
            if make is facts.product_fact:
                assert numbers == sorted(numbers)
    # Lines whose product or customer is unknown count in their order, and one with two customers counts once.
    assert {r.total_line_items for r in facts.product_fact(large).where("order_number_bk BETWEEN 50 AND 199").collect()} == {5}


def test_lines_meet_many_products_and_customers_before_their_ranges(star, frame):
    _, large = _with_many_members(star, frame)
    for df in (facts.product_parts(large), facts.order_rows(large)):
        plan = _plan(df)
        assert plan.count("rangepartitioning(order_number") == 1 and "hashpartitioning(order_number" not in plan


def test_compat_product_fact_moves_single_lines_and_writes_no_local_amounts(star, frame, spark):
    small, large = _with_many_members(star, frame, compat=True)
    hot = replace(small)
    hot.hot_orders = True
    want = Counter(facts.product_fact_compat(hot).drop("product_sale_sk").collect())
    assert sum(want.values()) > 100
    for other in (small, large):
        got = facts.product_fact_compat(other)
        assert Counter(got.drop("product_sale_sk").collect()) == want
        assert sorted(r[0] for r in got.select("product_sale_sk").collect()) == list(range(1, sum(want.values()) + 1))
        written = set(spark.read.parquet(next(f for f in got.inputFiles() if "dense-product_sale_sk" in f)).columns)
        assert "rate" in written and not written & {"total_cost_local", "total_price_local", "total_profit_usd"}
