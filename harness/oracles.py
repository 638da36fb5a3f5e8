"""The same results in plain SQL over the driver's tables, written independently of the Spark plans."""

from __future__ import annotations

from tallyloft.schemas import DICTIONARY

BASE = """
WITH
span AS (
  SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS s,
         CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR AS DATE) AS e
  FROM orders),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_key
  FROM span),
b_customers AS (
  SELECT c_custkey AS customerkey, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender, c_name AS name,
         'CITY_' || (c_custkey % 50) AS city, 'S' || n_nationkey AS state_code, 'STATE_' || n_nationkey AS state,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code, n_name AS country, lower(r_name) AS continent,
         CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 22000 AS INTEGER) AS DATE) AS birthday
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
part_price AS (
  SELECT *, (CAST(p_retailprice AS DECIMAL(15,2)) - 895.00) * p_size AS price,
            (CAST(p_retailprice AS DECIMAL(15,2)) - 895.00) * (p_size - 1) AS cost
  FROM part),
b_products AS (
  SELECT p_partkey AS productkey, p_name AS product_name, p_brand AS brand, split_part(p_name, ' ', 1) AS color,
         '$' || format('{:,.2f}', CAST(cost AS DOUBLE)) || ' ' AS unit_cost_usd,
         '$' || format('{:,.2f}', CAST(price AS DOUBLE)) || ' ' AS unit_price_usd,
         CAST(split_part(p_brand, '#', 2) AS INTEGER) AS subcategorykey, p_brand AS subcategory,
         CAST(list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) AS INTEGER) AS categorykey,
         p_type AS category, CAST(price AS DECIMAL(15,2)) AS price, CAST(cost AS DECIMAL(15,2)) AS cost
  FROM part_price),
b_stores AS (
  SELECT s_suppkey AS storekey, CASE WHEN s_suppkey = 0 THEN 'Online' ELSE n_name END AS country,
         CASE WHEN s_suppkey = 0 THEN 'Online' ELSE 'STATE_' || n_nationkey END AS state,
         CASE WHEN s_suppkey <> 0 THEN CAST(500 + (s_suppkey * 13) % 1600 AS DECIMAL(18,2)) END AS square_meters,
         CAST(DATE '2005-01-01' + CAST((s_suppkey * 97) % 4000 AS INTEGER) AS DATE) AS open_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
fx_days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
fx_base(currency, base) AS (VALUES ('USD', 1000), ('CAD', 1300), ('GBP', 800), ('AUD', 1500), ('EUR', 900)),
fx AS (
  SELECT day AS date_key, currency AS currency_code, base,
         CAST((base + CASE WHEN currency = 'USD' THEN 0 ELSE (dayofyear(day) * 7) % 100 END) / 1000 AS DECIMAL(18,6)) AS rate
  FROM fx_days CROSS JOIN fx_base WHERE currency = 'USD' OR dayofyear(day) % 13 <> 0),
sales AS (
  SELECT l_orderkey AS order_number, l_linenumber AS line_item, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) THEN CAST(l_shipdate AS DATE) END AS delivery_date,
         o_custkey AS customer_key, o_custkey % 10 AS store_key, l_partkey AS product_key,
         CAST(l_quantity AS INTEGER) AS quantity, ['USD','CAD','GBP','AUD','EUR'][n_regionkey + 1] AS currency_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey),
d_customer AS (SELECT row_number() OVER (ORDER BY customerkey) AS customer_sk, * FROM b_customers),
d_product AS (SELECT row_number() OVER (ORDER BY productkey) AS product_sk, * FROM b_products),
d_store AS (SELECT row_number() OVER (ORDER BY storekey) AS store_sk, * FROM b_stores),
d_fx AS (SELECT row_number() OVER (ORDER BY date_key, currency_code) AS exchange_sk, * FROM fx),
d_fx_compat AS (
  SELECT row_number() OVER (ORDER BY strftime(date_key, '%d-%m-%y'), currency_code) AS exchange_sk, * FROM fx),
d_date AS (SELECT row_number() OVER (ORDER BY date_key) AS date_sk, date_key FROM spine),
rules(country_no, country, m, d, holiday_name) AS (VALUES
  (1, 'US', 1, 1, 'US - New Year''s Day'), (1, 'US', 7, 4, 'US - Independence Day'), (1, 'US', 12, 25, 'US - Christmas'),
  (2, 'UK', 1, 1, 'UK - New Year''s Day'), (2, 'UK', 12, 25, 'UK - Christmas'),
  (3, 'NL', 1, 1, 'NL - New Year''s Day'), (3, 'NL', 4, 27, 'NL - King''s Day'),
  (4, 'FR', 1, 1, 'FR - New Year''s Day'), (4, 'FR', 7, 14, 'FR - Bastille Day'),
  (5, 'DE', 10, 3, 'DE - Unity Day'), (6, 'IT', 6, 2, 'IT - Republic Day'),
  (7, 'CA', 7, 1, 'CA - Canada Day'), (8, 'AU', 1, 26, 'AU - Australia Day')),
d_date_compat AS (
  SELECT row_number() OVER (ORDER BY s.date_key, c.country_no) AS date_sk, s.date_key, r.holiday_name
  FROM spine s CROSS JOIN (SELECT DISTINCT country_no FROM rules) c
  LEFT JOIN rules r ON r.country_no = c.country_no AND r.m = month(s.date_key) AND r.d = day(s.date_key)),
priced AS (
  SELECT s.*, p.product_sk, p.product_name, p.brand, p.category, p.price, p.cost, st.store_sk, st.country AS store_country,
         p.price * s.quantity AS price_usd, p.cost * s.quantity AS cost_usd
  FROM sales s JOIN d_product p ON s.product_key = p.productkey JOIN d_store st ON s.store_key = st.storekey),
om AS (
  SELECT order_number, customer_key, store_key, store_sk, currency_code, order_date, max(line_item) AS number_of_items,
         count(*) AS line_count, max(delivery_date) AS delivery_date, CAST(sum(quantity) AS BIGINT) AS total_quantity,
         CAST(sum(cost_usd) AS DECIMAL(20,2)) AS cost_usd, CAST(sum(price_usd) AS DECIMAL(20,2)) AS price_usd
  FROM priced GROUP BY ALL),
pm AS (
  SELECT order_number, customer_key, store_key, store_sk, currency_code, order_date, product_key, product_sk,
         product_name, brand, category, price, cost, max(delivery_date) AS delivery_date,
         CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(sum(cost_usd) AS DECIMAL(20,2)) AS cost_usd, CAST(sum(price_usd) AS DECIMAL(20,2)) AS price_usd
  FROM priced GROUP BY ALL),
activity AS (
  SELECT customer_key, min(order_date) AS first_order, max(order_date) AS last_order, count(*) AS frequency,
         CAST(sum(price_usd) AS DECIMAL(20,2)) AS monetary, CAST(sum(price_usd - cost_usd) AS DECIMAL(20,2)) AS profit
  FROM om GROUP BY customer_key),
ev AS (
  SELECT CASE event_type WHEN 'error' THEN 'CANCEL' WHEN 'signup' THEN 'RETURN' ELSE 'ORDER' END AS event_type,
         event_id AS order_number, CAST(event_id % 3 + 1 AS INTEGER) AS line_item, 'O-' || event_id AS order_serial,
         strftime(ts, '%d-%m-%Y') || ' 00:00:00' AS order_date, user_id AS customerkey, user_id % 10 AS storekey,
         event_id % 200 AS productkey, CAST(event_id % 5 + 1 AS INTEGER) AS quantity,
         ['USD','CAD','GBP','AUD','EUR'][user_id % 5 + 1] AS currency_code,
         ['CASH','WALLET','DEBIT_CARD','CREDIT_CARD'][event_id % 4 + 1] AS payment_method,
         user_id || '-' || strftime(ts, '%Y-%m-%d') AS order_group_id, CAST(value AS DECIMAL(15,2)) AS price,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_ts, strftime(ts, '%d-%m-%Y %H:%M:%S') AS event_timestamp,
         event_id % 13 AS lag
  FROM events),
items AS (
  SELECT e.*, s.country AS store_country, s.state AS store_city, s.square_meters, s.open_date, p.product_name, p.category,
         CAST(price_total AS DOUBLE) AS total_sales_usd, CAST(price_total AS DOUBLE) AS line_total_amount,
         CAST(e.price AS DOUBLE) AS unit_price_usd,
         CASE WHEN event_type = 'RETURN' THEN 1 ELSE 0 END AS is_return,
         CASE WHEN event_type = 'CANCEL' THEN 1 ELSE 0 END AS is_cancel,
         CASE WHEN e.storekey = 0 THEN 'Online' ELSE 'In-Store' END AS sales_channel
  FROM (SELECT *, price * quantity AS price_total FROM ev) e
  LEFT JOIN b_stores s ON e.storekey = s.storekey
  LEFT JOIN b_products p ON e.productkey = p.productkey),
hot_items AS (
  SELECT coalesce(store_country, 'UNKNOWN') AS store_country, store_city, product_name, category, event_ts, order_serial,
         quantity, total_sales_usd, line_total_amount, is_return, is_cancel, CAST(lag AS INTEGER) AS processing_lag,
         customerkey, payment_method, sales_channel, order_number, price_total
  FROM items),
order_groups AS (
  SELECT order_group_id, event_type, store_country, store_city, currency_code, order_date, customerkey, payment_method,
         CAST(sum(quantity) AS BIGINT) AS total_items_count, CAST(sum(price_total) AS DECIMAL(18,2)) AS total,
         max(is_return) AS is_return_flag, max(is_cancel) AS is_cancel_flag, max(lag) AS max_lag, max(event_ts) AS last_update
  FROM items GROUP BY ALL),
hot_orders AS (
  SELECT currency_code, last_update AS event_ts, order_group_id, total_items_count,
         CAST(total AS DOUBLE) AS total_order_local, CAST(total AS DOUBLE) AS total_order_usd, is_return_flag, is_cancel_flag,
         CAST(max_lag AS INTEGER) AS max_lag_seconds, order_date, customerkey, payment_method,
         coalesce(store_country, 'UNKNOWN') AS store_country, event_type, coalesce(store_city, 'UNKNOWN') AS store_city, total
  FROM order_groups),
in_range AS (
  SELECT * FROM hot_items
  WHERE event_ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND is_cancel = 0 AND is_return = 0
    AND (store_country = 'Online' OR (store_country LIKE 'NATION_%' AND CAST(substr(store_country, 8) AS INTEGER) % 2 = 0)))
"""

ORACLES: dict[str, str] = {}


def sql(name: str, body: str) -> None:
    ORACLES[name] = BASE + body


_S_CUSTOMER = """SELECT customerkey AS customer_key, upper(gender) AS gender, name, city, state_code, state, zip_code, country,
       upper(continent) AS continent, birthday FROM b_customers"""
_B_PRODUCT = """SELECT productkey, product_name, brand, color, unit_cost_usd, unit_price_usd, subcategorykey, subcategory,
       categorykey, category FROM b_products"""
_B_STORE = "SELECT storekey, country, state, CAST(square_meters AS DOUBLE) AS square_meters, open_date FROM b_stores"
_S_SALES = """SELECT order_number, line_item, order_date, delivery_date, customer_key, store_key, product_key, quantity,
       currency_code FROM sales"""

sql("bronze_ndjson_customers", "SELECT * FROM b_customers")
sql("bronze_ndjson_products", _B_PRODUCT)
sql("bronze_ndjson_sales", """SELECT order_number, line_item, order_date, delivery_date, customer_key AS customerkey,
       store_key AS storekey, product_key AS productkey, quantity, currency_code FROM sales""")
sql("bronze_ndjson_stores", _B_STORE)
sql("bronze_csv_stores", _B_STORE)
sql("bronze_ndjson_exchange_rates", """
SELECT CAST(date_diff('day', DATE '1970-01-01', date_key) * 100 + base // 100 AS BIGINT) AS id,
       strftime(date_key, '%m/%d/%Y') AS rate_date, lower(currency_code) AS currency, CAST(rate AS DOUBLE) AS exchange FROM fx""")
_DRIFTING = """, l AS (SELECT *, order_number * 10 + line_item AS n FROM sales)"""
sql("bronze_variant_sales", _DRIFTING + """
SELECT order_number, line_item, order_date, delivery_date, customer_key AS customerkey, store_key AS storekey, product_key AS productkey,
       CASE WHEN n % 17 = 0 OR n % 19 <> 0 THEN quantity END AS quantity, currency_code FROM l WHERE n % 97 <> 0""")
sql("bronze_variant_rejected", _DRIFTING + " SELECT CAST(30 AS INTEGER) AS length, count(*) AS lines FROM l WHERE n % 97 = 0")
sql("bronze_drift", _DRIFTING + """
SELECT 'coupon' AS field, 'unknown' AS finding, count(*) AS lines FROM l WHERE n % 97 <> 0 AND n % 17 = 0
UNION ALL SELECT 'quantity', 'not int', count(*) FROM l WHERE n % 97 <> 0 AND n % 17 <> 0 AND n % 19 = 0""")
sql("bronze_named_sources", """
SELECT b.country, p.category, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units
FROM sales s JOIN b_stores b ON s.store_key = b.storekey JOIN b_products p ON s.product_key = p.productkey GROUP BY ALL""")
sql("date_spine", "SELECT date_sk, date_key FROM d_date")

sql("silver_customers", _S_CUSTOMER)
sql("silver_products", """
SELECT productkey AS product_key, product_name, brand, upper(color) AS color, CAST(cost AS DOUBLE) AS unit_cost,
       CAST(price AS DOUBLE) AS unit_price, CASE WHEN price > 100 THEN 'Yes' ELSE 'No' END AS expensive_flag,
       subcategorykey AS subcategory_key, subcategory, categorykey AS category_key, category FROM b_products""")
sql("silver_sales", _S_SALES)
sql("silver_stores", """SELECT storekey AS store_key, country, state, CAST(square_meters AS DOUBLE) AS square_meters,
       strftime(open_date, '%d-%m-%y') AS open_date FROM b_stores""")
sql("silver_exchange_rates", """SELECT strftime(date_key, '%d-%m-%y') AS rate_date, date_key AS rate_day, currency_code AS currency,
       CAST(rate AS DOUBLE) AS exchange_rate_usd FROM fx""")
sql("silver_null_trim", """
SELECT customerkey AS customer_key, CASE WHEN customerkey % 11 = 0 THEN 'UNKNOWN' ELSE upper(gender) END AS gender, name,
       CASE WHEN customerkey % 7 = 0 THEN 'Unknown' ELSE city END AS city, state_code, state, zip_code, country,
       upper(continent) AS continent, birthday FROM b_customers""")
sql("silver_sales_dedup", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_number, line_item
    ORDER BY delivery_date NULLS LAST, product_key, quantity, customer_key, store_key, currency_code, order_date) AS rn
  FROM ({_S_SALES})) WHERE rn = 1""")

sql("dim_customer", """SELECT customer_sk, customerkey AS customer_key, name, upper(gender) AS gender, city, state, country,
       upper(continent) AS continent, birthday FROM d_customer""")
sql("dim_product_info", """
SELECT product_sk, productkey AS product_key, product_name, brand, CAST(cost AS DOUBLE) AS unit_cost_usd,
       CAST(price AS DOUBLE) AS unit_price_usd, subcategorykey AS subcategory_key, subcategory,
       categorykey AS category_key, category FROM d_product""")
sql("dim_stores", """SELECT store_sk, storekey AS store_key, state, country, CAST(square_meters AS DOUBLE) AS square_meters,
       strftime(open_date, '%d-%m-%y') AS open_date FROM d_store""")
for _name, _table in (("dim_exchange_rates", "d_fx"), ("dim_exchange_rates_compat", "d_fx_compat")):
    sql(_name, f"""SELECT exchange_sk, currency_code, currency_code AS currency_name, date_key,
       CAST(rate AS DOUBLE) AS rate FROM {_table}""")
_PARTS = """CAST(year(d.date_key) AS INTEGER) AS year, CAST(month(d.date_key) AS INTEGER) AS month,
       CAST(day(d.date_key) AS INTEGER) AS day, CAST(quarter(d.date_key) AS INTEGER) AS quarter"""
sql("dim_date", f"""
SELECT d.date_sk, d.date_key, {_PARTS}, CASE WHEN count(r.holiday_name) > 0 THEN 1 ELSE 0 END AS is_holiday,
       coalesce(string_agg(r.holiday_name, '; ' ORDER BY r.holiday_name), '') AS holiday_names
FROM d_date d LEFT JOIN rules r ON r.m = month(d.date_key) AND r.d = day(d.date_key) GROUP BY d.date_sk, d.date_key""")
sql("dim_date_compat", f"""SELECT d.date_sk, d.date_key, {_PARTS},
       CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END AS is_holiday, holiday_name FROM d_date_compat d""")
sql("dim_holiday", """SELECT date_key, country, holiday_name FROM spine
       JOIN rules ON m = month(date_key) AND d = day(date_key)""")
sql("scd2_customer", f"""
, c AS ({_S_CUSTOMER})
SELECT customer_key, name, city, state, country,
       CASE WHEN customer_key % 20 = 5 THEN DATE '2001-07-01' ELSE DATE '2001-01-01' END AS valid_from,
       CASE WHEN customer_key % 10 = 3 THEN DATE '2001-07-01' END AS valid_to,
       CASE WHEN customer_key % 10 = 3 THEN 0 ELSE 1 END AS is_current FROM c
UNION ALL
SELECT customer_key, name, 'NEW_' || city, state, country, DATE '2001-07-01', CAST(NULL AS DATE), 1
FROM c WHERE customer_key % 10 = 3""")

_HISTORY = f"""
, c AS (SELECT customer_key, name, city, state, country FROM ({_S_CUSTOMER})),
moved AS (SELECT * REPLACE (CASE WHEN customer_key % 10 = 3 THEN 'NEW_' || city ELSE city END AS city) FROM c),
taken AS (
  SELECT *, DATE '2001-01-01' AS day FROM c WHERE customer_key % 20 <> 5
  UNION ALL SELECT *, DATE '2001-04-01' FROM moved
  UNION ALL SELECT * REPLACE (CASE WHEN customer_key % 7 = 0 THEN 'LATE' ELSE city END AS city), DATE '2001-06-01' FROM moved
  UNION ALL SELECT *, DATE '2001-09-01' FROM c WHERE customer_key % 6 <> 1
  UNION ALL SELECT *, DATE '2001-11-01' FROM c),
starts AS (
  SELECT *, lag(city) OVER (PARTITION BY customer_key ORDER BY day) IS DISTINCT FROM city AS opens FROM taken),
history AS (
  SELECT customer_key, name, city, state, country, day AS valid_from,
         lead(day) OVER (PARTITION BY customer_key ORDER BY day) AS valid_to FROM starts WHERE opens)"""
sql("scd2_late_snapshots", _HISTORY + " SELECT *, CAST(valid_to IS NULL AS INTEGER) AS is_current FROM history")
sql("fact_customer_as_of", _HISTORY + """
SELECT s.order_number, s.line_item, s.customer_key, s.day, h.valid_from, h.city, h.country
FROM (SELECT order_number, line_item, customer_key, DATE '2001-01-01' + CAST(order_number % 365 AS INTEGER) AS day FROM sales) s
LEFT JOIN history h ON h.customer_key = s.customer_key AND h.valid_from <= s.day AND (h.valid_to IS NULL OR s.day < h.valid_to)""")

sql("fact_sales", """
SELECT row_number() OVER (ORDER BY o.order_number) AS order_sk, o.order_number AS order_number_bk, number_of_items, line_count,
       od.date_sk AS order_date_fk, dd.date_sk AS delivery_date_fk, o.store_sk AS store_fk, o.customer_key AS customer_fk,
       c.customer_sk, f.exchange_sk AS exchange_rate_fk, total_quantity,
       CAST(cost_usd AS DOUBLE) AS total_cost_usd, CAST(price_usd AS DOUBLE) AS total_price_usd,
       CAST(price_usd - cost_usd AS DOUBLE) AS total_profit_usd,
       CAST(cost_usd * CAST(rate AS DECIMAL(12,6)) AS DOUBLE) AS total_cost_local,
       CAST(price_usd * CAST(rate AS DECIMAL(12,6)) AS DOUBLE) AS total_price_local,
       CAST(price_usd * CAST(rate AS DECIMAL(12,6)) - cost_usd * CAST(rate AS DECIMAL(12,6)) AS DOUBLE) AS total_profit_local,
       o.currency_code
FROM om o JOIN d_customer c ON o.customer_key = c.customerkey JOIN d_date od ON o.order_date = od.date_key
LEFT JOIN d_date dd ON o.delivery_date = dd.date_key
LEFT JOIN d_fx f ON f.currency_code = o.currency_code AND f.date_key = o.order_date""")
sql("fact_sales_compat", """
, cte AS (
  SELECT order_number, max(line_item) AS max_line, customer_key, order_date, store_sk, delivery_date, sum(quantity) AS q,
         CAST(sum(cost_usd) AS DECIMAL(20,2)) AS cu, CAST(sum(price_usd) AS DECIMAL(20,2)) AS pu,
         CAST(sum(cost_usd) AS DECIMAL(20,2)) * CAST(rate AS DECIMAL(12,6)) AS cl,
         CAST(sum(price_usd) AS DECIMAL(20,2)) * CAST(rate AS DECIMAL(12,6)) AS pl, priced.currency_code
  FROM priced LEFT JOIN d_fx_compat f ON f.currency_code = priced.currency_code AND f.date_key = order_date
  GROUP BY order_number, customer_key, order_date, delivery_date, store_sk, priced.currency_code, rate)
SELECT row_number() OVER (ORDER BY s.order_number) AS order_sk, s.order_number AS order_number_bk, max(max_line) AS number_of_items,
       max(od.date_sk) AS order_date_fk, max(dd.date_sk) AS delivery_date_fk, s.store_sk AS store_fk,
       s.customer_key AS customer_fk, f.exchange_sk AS exchange_rate_fk, CAST(max(q) AS BIGINT) AS total_quantity,
       CAST(max(cu) AS DOUBLE) AS total_cost_usd, CAST(max(pu) AS DOUBLE) AS total_price_usd,
       CAST(max(pu) - max(cu) AS DOUBLE) AS total_profit_usd, CAST(max(cl) AS DOUBLE) AS total_cost_local,
       CAST(max(pl) AS DOUBLE) AS total_price_local, CAST(max(pl) - max(cl) AS DOUBLE) AS total_profit_local, s.currency_code
FROM cte s JOIN b_customers c ON s.customer_key = c.customerkey JOIN d_date_compat od ON s.order_date = od.date_key
LEFT JOIN d_date_compat dd ON s.delivery_date = dd.date_key
LEFT JOIN d_fx_compat f ON f.currency_code = s.currency_code AND f.date_key = s.order_date
GROUP BY s.order_number, s.store_sk, s.customer_key, f.exchange_sk, s.currency_code""")
sql("fact_product_sales", """
, n AS (SELECT order_number, count(*) AS total_line_items FROM sales GROUP BY order_number)
SELECT row_number() OVER (ORDER BY o.order_number, o.product_sk) AS product_sale_sk, o.order_number AS order_number_bk,
       n.total_line_items, od.date_sk AS order_date_fk, dd.date_sk AS delivery_date_fk, o.store_sk AS store_fk,
       o.customer_key AS customer_fk, c.customer_sk, o.product_sk AS product_fk, f.exchange_sk AS exchange_fk,
       o.quantity AS p_quantity, CAST(cost_usd AS DOUBLE) AS total_cost_usd, CAST(price_usd AS DOUBLE) AS total_price_usd,
       CAST(price_usd - cost_usd AS DOUBLE) AS total_profit_usd,
       CAST(cost_usd * CAST(rate AS DECIMAL(12,6)) AS DOUBLE) AS total_cost_local,
       CAST(price_usd * CAST(rate AS DECIMAL(12,6)) AS DOUBLE) AS total_price_local,
       CAST(price_usd * CAST(rate AS DECIMAL(12,6)) - cost_usd * CAST(rate AS DECIMAL(12,6)) AS DOUBLE) AS total_profit_local,
       CASE WHEN price <> 0 THEN CAST(price - cost AS DOUBLE) / CAST(price AS DOUBLE) END AS profit_margin,
       o.currency_code AS local_currency
FROM pm o JOIN n ON n.order_number = o.order_number JOIN d_customer c ON o.customer_key = c.customerkey
JOIN d_date od ON o.order_date = od.date_key LEFT JOIN d_date dd ON o.delivery_date = dd.date_key
LEFT JOIN d_fx f ON f.currency_code = o.currency_code AND f.date_key = o.order_date""")
sql("fact_product_sales_compat", """
, grouped AS (
  SELECT order_number, product_key, product_sk, customer_key, order_date, delivery_date, store_sk, cost, price, quantity,
         priced.currency_code, rate, exchange_sk, CAST(cost * quantity AS DECIMAL(20,2)) AS cu,
         CAST(price * quantity AS DECIMAL(20,2)) AS pu, count(*) OVER (PARTITION BY order_number) AS total_line_items
  FROM priced JOIN d_fx_compat f ON f.currency_code = priced.currency_code AND f.date_key = order_date
  GROUP BY order_number, product_key, product_sk, customer_key, order_date, delivery_date, store_sk, cost, price, quantity,
           priced.currency_code, rate, exchange_sk)
SELECT row_number() OVER (ORDER BY s.order_number, s.product_sk) AS product_sale_sk, s.order_number AS order_number_bk,
       s.total_line_items, max(od.date_sk) AS order_date_fk, max(dd.date_sk) AS delivery_date_fk, s.store_sk AS store_fk,
       s.customer_key AS customer_fk, s.product_sk AS product_fk, s.exchange_sk AS exchange_fk,
       CAST(max(quantity) AS INTEGER) AS p_quantity, CAST(max(cu) AS DOUBLE) AS total_cost_usd,
       CAST(max(pu) AS DOUBLE) AS total_price_usd, CAST(max(pu) - max(cu) AS DOUBLE) AS total_profit_usd,
       CAST(max(cu * CAST(rate AS DECIMAL(12,6))) AS DOUBLE) AS total_cost_local,
       CAST(max(pu * CAST(rate AS DECIMAL(12,6))) AS DOUBLE) AS total_price_local,
       CAST(max(pu * CAST(rate AS DECIMAL(12,6))) - max(cu * CAST(rate AS DECIMAL(12,6))) AS DOUBLE) AS total_profit_local,
       max(CASE WHEN price <> 0 THEN CAST(price - cost AS DOUBLE) / CAST(price AS DOUBLE) END) AS profit_margin,
       max(s.currency_code) AS local_currency
FROM grouped s JOIN b_customers c ON s.customer_key = c.customerkey JOIN d_date_compat od ON s.order_date = od.date_key
LEFT JOIN d_date_compat dd ON s.delivery_date = dd.date_key
GROUP BY s.order_number, s.total_line_items, s.store_sk, s.customer_key, s.product_sk, s.exchange_sk""")
# Two loads: orders that came late are numbered on from the first load, and only months with a difference were written.
_AGE = "date_diff('day', o.order_date, (SELECT e FROM span))"
_LATE = f"(o.order_number % 7 = 0 AND {_AGE} <= 40)"
_CORRECTED = f"(o.order_number % 11 = 0 AND {_AGE} BETWEEN 80 AND 90)"
for _name, _order, _key in (("fact_sales", "o.order_number", "order_sk"), ("fact_product_sales", "o.order_number, o.product_sk", "product_sale_sk")):
    ORACLES[f"{_name}_incremental"] = ORACLES[_name].replace(f"row_number() OVER (ORDER BY {_order}) AS {_key}", f"""
       CASE WHEN {_LATE} THEN count(*) FILTER (NOT {_LATE}) OVER () ELSE 0 END + row_number() OVER (PARTITION BY {_LATE} ORDER BY {_order}) AS {_key},
       CASE WHEN {_LATE} THEN 'new' ELSE 'kept' END AS key_state,
       CAST(bool_or({_LATE} OR {_CORRECTED}) OVER (PARTITION BY year(o.order_date), month(o.order_date)) AS INTEGER) AS written""")
sql("fx_asof_sales", """
SELECT l.order_number, l.line_item, l.product_key, l.quantity, l.currency_code, l.order_date, f.date_key AS rate_date_used,
       CAST(f.rate AS DOUBLE) AS rate, CAST(l.price_usd AS DOUBLE) AS price_usd,
       CAST(CAST(l.price_usd AS DECIMAL(20,2)) * CAST(f.rate AS DECIMAL(12,6)) AS DOUBLE) AS price_local
FROM priced l ASOF LEFT JOIN fx f ON f.currency_code = l.currency_code AND l.order_date >= f.date_key""")

sql("mart_shipping", """
, w AS (SELECT st.country, date_diff('day', order_date, delivery_date) AS days
        FROM om JOIN d_store st ON st.storekey = om.store_key WHERE delivery_date IS NOT NULL)
SELECT country, count(*) AS delivered_orders, CAST(sum(days) AS DOUBLE) / count(*) AS avg_days,
       CAST(quantile_cont(days, 0.5) AS DOUBLE) AS p50_days, CAST(quantile_cont(days, 0.95) AS DOUBLE) AS p95_days
FROM w GROUP BY country""")
sql("mart_revenue_quarter_category", """
, leaves AS (
  SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter, category,
         CAST(sum(price_usd) AS DECIMAL(30,2)) AS revenue FROM pm GROUP BY ALL),
grown AS (
  SELECT *, sum(revenue) OVER (PARTITION BY category ORDER BY year * 4 + quarter RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS before
  FROM leaves)
SELECT year, quarter, category, CAST(revenue AS DOUBLE) AS revenue,
       CAST(revenue - before AS DOUBLE) / CAST(before AS DOUBLE) AS growth, 0 AS level FROM grown
UNION ALL SELECT year, quarter, NULL, CAST(sum(revenue) AS DOUBLE), NULL, 1 FROM leaves GROUP BY year, quarter
UNION ALL SELECT year, NULL, NULL, CAST(sum(revenue) AS DOUBLE), NULL, 3 FROM leaves GROUP BY year
UNION ALL SELECT NULL, NULL, NULL, CAST(sum(revenue) AS DOUBLE), NULL, 7 FROM leaves""")
sql("mart_aov_margin", """
SELECT CAST(year(order_date) AS INTEGER) AS year, count(*) AS orders, CAST(sum(price_usd) AS DOUBLE) AS revenue,
       CAST(sum(price_usd - cost_usd) AS DOUBLE) AS profit, CAST(sum(price_usd) AS DOUBLE) / count(*) AS avg_order_value,
       CAST(sum(price_usd - cost_usd) AS DOUBLE) / CAST(sum(price_usd) AS DOUBLE) AS profit_margin
FROM om GROUP BY 1""")
sql("mart_top_brands", """
, b AS (SELECT category, brand, CAST(sum(price_usd) AS DECIMAL(30,2)) AS rev, CAST(sum(quantity) AS BIGINT) AS units
        FROM pm GROUP BY ALL)
SELECT category, brand, CAST(rev AS DOUBLE) AS revenue, units,
       row_number() OVER (PARTITION BY category ORDER BY rev DESC, brand) AS brand_rank,
       CAST(rev AS DOUBLE) / CAST(sum(rev) OVER (PARTITION BY category) AS DOUBLE) AS category_share,
       CAST(rev AS DOUBLE) / CAST(sum(rev) OVER () AS DOUBLE) AS total_share FROM b""")
sql("mart_demographics", """
, p AS (
  SELECT country, datesub('year', birthday, DATE '2002-01-01') AS age, frequency, monetary
  FROM activity JOIN b_customers ON customerkey = customer_key),
banded AS (
  SELECT *, CASE WHEN age < 25 THEN 'under 25' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54'
                 WHEN age < 65 THEN '55-64' ELSE '65 and over' END AS age_band FROM p)
SELECT age_band, country, count(*) AS customers, CAST(sum(frequency) AS BIGINT) AS orders, CAST(sum(monetary) AS DOUBLE) AS revenue,
       CAST(grouping(age_band, country) AS INTEGER) AS level
FROM banded GROUP BY CUBE (age_band, country)""")
sql("mart_store_performance", """
, s AS (SELECT store_key, st.country, st.square_meters, count(*) AS orders, CAST(sum(price_usd) AS DECIMAL(30,2)) AS rev
        FROM om JOIN d_store st ON st.storekey = store_key GROUP BY ALL)
SELECT store_key, country, orders, CAST(rev AS DOUBLE) AS revenue, CAST(rev AS DOUBLE) / CAST(square_meters AS DOUBLE) AS revenue_per_m2,
       rank() OVER (PARTITION BY country ORDER BY rev DESC) AS best_rank, rank() OVER (PARTITION BY country ORDER BY rev) AS worst_rank
FROM s""")
sql("mart_channel_geo", """
, g AS (SELECT CASE WHEN store_key = 0 THEN 'Online' ELSE 'In-Store' END AS sales_channel, st.country,
               count(DISTINCT store_key) AS stores, count(*) AS orders, CAST(sum(price_usd) AS DECIMAL(30,2)) AS rev
        FROM om JOIN d_store st ON st.storekey = store_key GROUP BY ALL)
SELECT sales_channel, country, stores, orders, CAST(rev AS DOUBLE) AS revenue,
       CAST(rev AS DOUBLE) / CAST(sum(rev) OVER () AS DOUBLE) AS revenue_share FROM g""")
sql("mart_rfm", """
, s AS (
  SELECT customer_key, CAST(date_diff('day', last_order, DATE '2002-01-01') AS INTEGER) AS recency_days, frequency, monetary,
         CAST(ntile(5) OVER (ORDER BY date_diff('day', last_order, DATE '2002-01-01') DESC, customer_key) AS INTEGER) AS r,
         CAST(ntile(5) OVER (ORDER BY frequency, customer_key) AS INTEGER) AS f,
         CAST(ntile(5) OVER (ORDER BY monetary, customer_key) AS INTEGER) AS m
  FROM activity)
SELECT customer_key, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r AS r_score, f AS f_score, m AS m_score,
       CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'champion' WHEN r >= 3 AND f >= 3 THEN 'loyal' WHEN r >= 4 AND f <= 2 THEN 'new'
            WHEN r <= 2 AND f >= 3 THEN 'at risk' WHEN r <= 2 AND f <= 2 THEN 'lost' ELSE 'regular' END AS segment FROM s""")
sql("mart_customer_reach", """
, g AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, st.country,
               CASE WHEN store_key = 0 THEN 'Online' ELSE 'In-Store' END AS sales_channel, price_usd, customer_key
        FROM om JOIN d_store st ON st.storekey = store_key)
SELECT month, country, sales_channel, count(*) AS orders, CAST(CAST(sum(price_usd) AS DECIMAL(30,2)) AS DOUBLE) AS revenue,
       count(DISTINCT customer_key) AS exact, CAST(grouping(month, country, sales_channel) AS INTEGER) AS level, CAST(1 AS INTEGER) AS within
FROM g GROUP BY CUBE (month, country, sales_channel)""")
sql("mart_clv", """
, t AS (SELECT *, CAST(greatest(date_diff('day', first_order, DATE '2002-01-01'), 1) AS INTEGER) AS tenure_days FROM activity)
SELECT customer_key, tenure_days, frequency, CAST(monetary AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS margin,
       CAST(profit AS DOUBLE) + CAST(profit AS DOUBLE) / tenure_days * 1095 AS clv FROM t""")
sql("mart_product_mix", """
SELECT product_key, product_name, category, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS orders,
       CAST(sum(price_usd) AS DOUBLE) AS revenue, CAST(sum(price_usd - cost_usd) AS DOUBLE) AS profit FROM pm GROUP BY 1, 2, 3""")

sql("stream_item_enrich", """
SELECT event_type, order_number, line_item, order_serial, order_date, customerkey, storekey, productkey, quantity, currency_code,
       payment_method, order_group_id, unit_price_usd, line_total_amount, event_timestamp, store_country, store_city,
       CAST(square_meters AS DOUBLE) AS square_meters, open_date, product_name, category, event_ts, total_sales_usd,
       lag AS processing_lag, is_return, is_cancel, sales_channel, store_city AS store_state FROM items""")
# The one query whose dimensions lack rows.
ORACLES["stream_item_enrich"] = ORACLES["stream_item_enrich"].replace(
    "LEFT JOIN b_stores s", "LEFT JOIN (SELECT * FROM b_stores WHERE storekey <> 3) s").replace(
    "LEFT JOIN b_products p", "LEFT JOIN (SELECT * FROM b_products WHERE productkey % 50 <> 7) p")
sql("stream_item_json", """
SELECT order_serial AS key, order_serial, order_date, event_type, product_name, category, quantity, unit_price_usd, total_sales_usd,
       line_total_amount, storekey, store_country, store_city, customerkey, payment_method, is_return, is_cancel,
       lag AS processing_lag, sales_channel, event_ts FROM items""")
sql("stream_order_agg_update", "SELECT * EXCLUDE (total) FROM hot_orders")
sql("hot_orders_latest", "SELECT * EXCLUDE (total) FROM hot_orders")
sql("stream_order_json", """
SELECT order_group_id AS key, order_group_id, order_date, event_type, total_items_count, CAST(total AS DOUBLE) AS total_order_local,
       CAST(total AS DOUBLE) AS total_order_usd, store_country, store_city, currency_code, customerkey, payment_method,
       is_return_flag, is_cancel_flag, max_lag AS max_lag_seconds, last_update FROM order_groups""")
sql("stream_order_agg_windowed", """
, w AS (
  SELECT time_bucket(INTERVAL '10 minutes', event_ts) AS window_start, order_group_id, event_type, store_country, store_city,
         currency_code, order_date, customerkey, payment_method, CAST(sum(quantity) AS BIGINT) AS total_items_count,
         CAST(sum(price_total) AS DOUBLE) AS total_order_local, CAST(sum(price_total) AS DOUBLE) AS total_order_usd,
         max(is_return) AS is_return_flag, max(is_cancel) AS is_cancel_flag, max(lag) AS max_lag_seconds, max(event_ts) AS last_update
  FROM items GROUP BY ALL)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, * EXCLUDE (window_start) FROM w""")
ORACLES["stream_order_redelivered"] = ORACLES["stream_order_agg_windowed"]
sql("stream_order_sessions", """
, g AS (
  SELECT *, CASE WHEN epoch(event_ts) - epoch(lag(event_ts) OVER o) <= 21600 THEN 0 ELSE 1 END AS opens FROM items
  WINDOW o AS (PARTITION BY order_group_id, event_type, store_country, store_city, currency_code, order_date, customerkey, payment_method
               ORDER BY event_ts)),
s AS (
  SELECT *, sum(opens) OVER (PARTITION BY order_group_id, event_type, store_country, store_city, currency_code, order_date, customerkey,
                             payment_method ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT min(event_ts) AS first_event, order_group_id, event_type, store_country, store_city, currency_code, order_date, customerkey, payment_method,
       CAST(sum(quantity) AS BIGINT) AS total_items_count, CAST(sum(price_total) AS DOUBLE) AS total_order_local,
       CAST(sum(price_total) AS DOUBLE) AS total_order_usd, max(is_return) AS is_return_flag, max(is_cancel) AS is_cancel_flag,
       max(lag) AS max_lag_seconds, max(event_ts) AS last_update
FROM s GROUP BY order_group_id, event_type, store_country, store_city, currency_code, order_date, customerkey, payment_method, n""")
sql("stream_dedup", "SELECT order_serial, event_type, quantity, event_ts, total_sales_usd FROM items")
sql("stream_dlq", """
, f AS (
  SELECT order_serial AS key, order_number AS eid, 5 + octet_length(encode(
      '{"event_type":"' || CASE WHEN order_number % 79 = 0 THEN 'REFUND' ELSE event_type END || '","order_number":' || order_number
      || ',"line_item":' || line_item || ',"order_serial":"' || order_serial || '","order_date":"' || order_date || '"'
      || CASE WHEN order_number % 2 = 0 THEN ',"delivery_date":' || (epoch_ms(event_ts) + 259200000) ELSE '' END
      || ',"customerkey":' || customerkey || ',"storekey":' || storekey || ',"productkey":' || productkey || ',"quantity":' || quantity
      || ',"currency_code":"' || currency_code || '","payment_method":"' || payment_method || '","status":"CREATED","order_group_id":"'
      || order_group_id || '","unit_price_usd":' || CAST(price AS DOUBLE) || ',"line_total_amount":'
      || CAST(price * quantity AS DOUBLE) || ',"event_timestamp":"'
      || CASE WHEN order_number % 73 = 0 THEN 'yesterday' ELSE event_timestamp END || '"}')) AS n
  FROM ev)
SELECT key, CASE WHEN eid % 97 = 0 THEN 'short frame' WHEN eid % 89 = 0 THEN 'wrong magic byte' WHEN eid % 83 = 0 THEN 'unreadable body'
       WHEN eid % 79 = 0 THEN 'event_type not allowed' ELSE 'event_timestamp unreadable' END AS reason,
       CAST(CASE WHEN eid % 97 = 0 THEN 3 WHEN eid % 89 = 0 THEN n WHEN eid % 83 = 0 THEN n // 2 ELSE n END AS INTEGER) AS bytes
FROM f WHERE eid % 97 = 0 OR eid % 89 = 0 OR eid % 83 = 0 OR eid % 79 = 0 OR eid % 73 = 0""")
sql("stream_archive_hourly", """
, a AS (
  SELECT event_ts + lag * INTERVAL 1 SECOND AS t, 5 + octet_length(encode(
      '{"event_type":"' || event_type || '","order_number":' || order_number || ',"line_item":' || line_item || ',"order_serial":"'
      || order_serial || '","order_date":"' || order_date || '"'
      || CASE WHEN order_number % 2 = 0 THEN ',"delivery_date":' || (epoch_ms(event_ts) + 259200000) ELSE '' END
      || ',"customerkey":' || customerkey || ',"storekey":' || storekey || ',"productkey":' || productkey || ',"quantity":' || quantity
      || ',"currency_code":"' || currency_code || '","payment_method":"' || payment_method || '","status":"CREATED","order_group_id":"'
      || order_group_id || '","unit_price_usd":' || CAST(price AS DOUBLE) || ',"line_total_amount":'
      || CAST(price * quantity AS DOUBLE) || ',"event_timestamp":"' || event_timestamp || '"}')) AS n
  FROM ev)
SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
       CAST(hour(t) AS INTEGER) AS hour, count(*) AS messages, CAST(sum(n) AS BIGINT) AS bytes FROM a GROUP BY ALL""")

_HOT = """store_country, store_city, product_name, category, event_ts, order_serial, quantity, total_sales_usd, line_total_amount,
       is_return, is_cancel, processing_lag, customerkey, payment_method, sales_channel"""
_HOT_FIXED = _HOT.replace("quantity,", "CAST(quantity + CASE WHEN order_number % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS quantity,", 1)
sql("hot_items_latest", f"SELECT {_HOT_FIXED} FROM hot_items")
ORACLES["stream_order_updates_once"] = ORACLES["stream_order_agg_update"]
ORACLES["hot_items_folded"] = ORACLES["hot_items_latest"]
sql("hot_items_stored_order", "SELECT store_country, count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM hot_items GROUP BY 1")
sql("stream_restarted", """
SELECT 'item' AS kind, store_country, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS units FROM items GROUP BY 2
UNION ALL SELECT 'order', store_country, count(*), CAST(sum(total_items_count) AS BIGINT) FROM hot_orders GROUP BY 2""")
sql("hot_items_by_country", f"""SELECT {_HOT_FIXED} FROM hot_items WHERE store_country = 'Online'
  OR (store_country LIKE 'NATION_%' AND CAST(substr(store_country, 8) AS INTEGER) % 2 = 0)""")
sql("hot_items_recent", f"SELECT {_HOT} FROM hot_items ORDER BY event_ts DESC, store_country, order_serial LIMIT 50")
sql("hot_orders_recent", "SELECT * EXCLUDE (total) FROM hot_orders ORDER BY event_ts DESC, order_group_id, event_type LIMIT 50")
sql("order_totals_exact", """
, fine AS (SELECT *, price + CAST(order_number % 1000 AS DECIMAL(10,0)) * CAST(0.00001 AS DECIMAL(6,5)) AS p FROM items)
SELECT order_group_id, event_type, payment_method, currency_code, CAST(sum(quantity) AS BIGINT) AS total_items_count,
       CAST(round(sum(p * quantity), 2) AS DOUBLE) AS total_order_local,
       CAST(sum(round(p * quantity, 2)) AS DOUBLE) AS total_order_usd
FROM fine GROUP BY order_group_id, event_type, store_country, store_city, currency_code, order_date, customerkey, payment_method""")
sql("fx_large_rates", """
SELECT p.currency_code, count(*) AS lines,
       CAST(sum(CAST(price_usd AS DECIMAL(19,2)) * CAST(rate * 1000000 + 0.5 AS DECIMAL(18,6))) AS DOUBLE) AS price_local
FROM priced p JOIN fx ON fx.currency_code = p.currency_code AND fx.date_key = p.order_date GROUP BY 1""")
sql("stream_read_back", """
, sent AS (
  SELECT 'item' AS kind, order_serial AS key FROM items
  UNION ALL SELECT 'order', order_group_id FROM order_groups),
n AS (SELECT *, (length(key) + ascii(right(key, 1))) % 7 AS n FROM sent)
SELECT CASE WHEN n < 3 THEN 'rejected' ELSE kind END AS kind, key,
       CASE WHEN n = 2 THEN 'topic unknown' WHEN n < 2 AND kind = 'item' THEN 'event_ts unreadable'
            WHEN n < 2 THEN 'last_update unreadable' END AS reason FROM n""")
sql("hot_items_by_channel", f"SELECT {_HOT} FROM hot_items WHERE sales_channel = 'Online'")
sql("hot_items_by_city", f"SELECT {_HOT} FROM hot_items WHERE store_city = 'Online'")
sql("mart_total_revenue", "SELECT CAST(sum(price_total) AS DOUBLE) AS revenue FROM in_range")
sql("mart_top_products", """SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units FROM in_range GROUP BY product_name
       ORDER BY units DESC, product_name NULLS FIRST LIMIT 10""")
sql("mart_revenue_over_time", """SELECT time_bucket(INTERVAL '1 hour', event_ts) AS bucket, CAST(sum(price_total) AS DOUBLE) AS revenue
       FROM in_range GROUP BY 1""")
sql("mart_order_ticker", """SELECT time_bucket(INTERVAL '1 day', event_ts) AS bucket, count(*) AS orders,
       CAST(sum(total) AS DOUBLE) AS revenue FROM hot_orders WHERE event_type = 'ORDER' GROUP BY 1""")
sql("mart_payment_mix", """
, m AS (SELECT payment_method, count(*) AS orders, CAST(sum(total) AS DECIMAL(30,2)) AS rev FROM hot_orders
        WHERE event_type = 'ORDER' GROUP BY 1)
SELECT payment_method, orders, CAST(rev AS DOUBLE) AS revenue, CAST(orders AS DOUBLE) / CAST(sum(orders) OVER () AS DOUBLE) AS order_share,
       CAST(rev AS DOUBLE) / CAST(sum(rev) OVER () AS DOUBLE) AS revenue_share FROM m""")
sql("mart_return_impact", """
SELECT time_bucket(INTERVAL '1 day', event_ts) AS bucket, count(*) FILTER (event_type = 'CANCEL') AS cancels,
       count(*) FILTER (event_type = 'RETURN') AS returns,
       CAST(coalesce(sum(price_total) FILTER (event_type = 'CANCEL'), 0) AS DOUBLE) AS lost_before_delivery,
       CAST(coalesce(sum(price_total) FILTER (event_type = 'RETURN'), 0) AS DOUBLE) AS lost_after_delivery
FROM items GROUP BY 1""")
sql("mart_problem_skus", """
, s AS (SELECT coalesce(product_name, 'UNKNOWN') AS product_name, CAST(sum(quantity) AS BIGINT) AS units,
               CAST(sum(CASE WHEN is_cancel + is_return > 0 THEN quantity ELSE 0 END) AS BIGINT) AS bad_units
        FROM hot_items GROUP BY 1)
SELECT product_name, units, bad_units, CAST(bad_units AS DOUBLE) / CAST(units AS DOUBLE) AS bad_rate FROM s
ORDER BY bad_rate DESC, units DESC, product_name LIMIT 20""")
sql("mart_lag_monitor", """
SELECT time_bucket(INTERVAL '1 day', event_ts) AS bucket, count(*) AS events,
       CAST(quantile_cont(processing_lag, 0.5) AS DOUBLE) AS p50_lag, CAST(quantile_cont(processing_lag, 0.95) AS DOUBLE) AS p95_lag,
       max(processing_lag) AS max_lag, CAST(count(*) FILTER (processing_lag > 5) AS DOUBLE) / count(*) AS breach_share
FROM hot_items GROUP BY 1""")
sql("stream_lag_sketches", """
SELECT time_bucket(INTERVAL '1 day', event_ts) AS bucket, count(processing_lag) AS events, CAST(max(processing_lag) AS BIGINT) AS max_lag,
       CAST(1 AS INTEGER) AS p50_within, CAST(1 AS INTEGER) AS p95_within
FROM hot_items WHERE processing_lag IS NOT NULL GROUP BY 1""")
sql("mart_cancel_alerts", """
, placed AS (
  SELECT time_bucket(INTERVAL '3 hours', event_ts) - k * INTERVAL 3 HOUR AS window_start, store_country, is_cancel + is_return AS bad
  FROM hot_items CROSS JOIN (VALUES (0), (1)) AS v(k)),
r AS (
  SELECT window_start, store_country, count(*) AS events, CAST(sum(bad) AS BIGINT) AS bad_events,
         CAST(CAST(sum(bad) AS BIGINT) * 1000000 // count(*) AS BIGINT) AS rate_ppm FROM placed GROUP BY 1, 2),
t AS (
  SELECT *, count(*) OVER w AS n, CAST(sum(rate_ppm) OVER w AS BIGINT) AS s, CAST(sum(rate_ppm * rate_ppm) OVER w AS BIGINT) AS q
  FROM r WINDOW w AS (PARTITION BY store_country ORDER BY window_start RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 3 HOUR PRECEDING)),
z AS (
  SELECT *, CASE WHEN n = 8 THEN CAST(s AS DOUBLE) / n END AS mean,
         CASE WHEN n = 8 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * (n - 1))) END AS std FROM t)
SELECT window_start, store_country, events, bad_events, rate_ppm, mean AS trailing_mean_ppm, std AS trailing_std_ppm,
       CASE WHEN rate_ppm > mean + 2.0 * std THEN 1 ELSE 0 END AS alert FROM z""")

sql("stream_fresh_stores", """
SELECT order_serial, event_type, event_ts, store_city, total_sales_usd,
       CASE WHEN storekey % 3 = 1 AND event_ts >= TIMESTAMP '2024-01-12 09:30:00' THEN 'NEW_' || store_country ELSE store_country END AS store_country
FROM items""")
for _name in ("order_ticker", "cancel_alerts"):
    ORACLES[f"stream_{_name}"] = ORACLES[f"mart_{_name}"]
sql("stream_revenue_over_time", """SELECT time_bucket(INTERVAL '1 hour', event_ts) AS bucket, CAST(sum(price_total) AS DOUBLE) AS revenue
       FROM hot_items WHERE is_cancel = 0 AND is_return = 0 GROUP BY 1""")

sql("dq_unique", """SELECT order_number, line_item, count(*) AS row_count FROM sales GROUP BY 1, 2 HAVING count(*) > 1""")
_SALES_COLUMNS = ["order_number", "line_item", "order_date", "delivery_date", "customer_key", "store_key", "product_key",
                  "quantity", "currency_code"]
_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM sales" for c in _SALES_COLUMNS)
sql("dq_not_null", _NULLS)
sql("dq_null_rate", f"""SELECT *, CAST(null_count AS DOUBLE) / row_count AS null_rate,
       CASE WHEN CAST(null_count AS DOUBLE) / row_count < 0.02 THEN 1 ELSE 0 END AS passed FROM ({_NULLS})""")
sql("dq_referential", """
SELECT 'product_key' AS fk, CAST(product_key AS VARCHAR) AS key_value, count(*) AS row_count FROM sales WHERE product_key % 50 = 7 GROUP BY ALL
UNION ALL SELECT 'store_key', CAST(store_key AS VARCHAR), count(*) FROM sales WHERE store_key = 3 GROUP BY ALL
UNION ALL SELECT 'customer_key', CAST(customer_key AS VARCHAR), count(*) FROM sales WHERE customer_key % 40 = 9 GROUP BY ALL
UNION ALL SELECT 'exchange_rate', currency_code || '/' || strftime(order_date, '%Y-%m-%d'), count(*) FROM sales s
WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.currency_code = s.currency_code AND fx.date_key = s.order_date)
GROUP BY currency_code, order_date""")
sql("dq_completeness", """SELECT order_number, line_item, count(*) AS rows_before, CAST(1 AS BIGINT) AS rows_after FROM sales
       GROUP BY 1, 2 HAVING count(*) > 1""")
sql("dq_completeness_rows", f"{_S_SALES} WHERE product_key % 50 = 7")
sql("dq_reconciliation", f"""
, a AS ({_S_SALES}),
kept AS (SELECT * REPLACE (CAST(quantity + CASE WHEN order_number % 23 = 0 THEN 1 ELSE 0 END AS INTEGER) AS quantity)
         FROM a WHERE product_key % 50 <> 7),
b AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE customer_key % 97 = 5),
pa AS (SELECT order_number, line_item, count(*) AS n, list_sort(list(CAST(t AS VARCHAR))) AS c FROM a AS t GROUP BY 1, 2),
pb AS (SELECT order_number, line_item, count(*) AS n, list_sort(list(CAST(t AS VARCHAR))) AS c FROM b AS t GROUP BY 1, 2)
SELECT order_number, line_item, coalesce(pa.n, 0) AS rows_before, coalesce(pb.n, 0) AS rows_after
FROM pa FULL JOIN pb USING (order_number, line_item) WHERE pa.c IS DISTINCT FROM pb.c""")
sql("dq_domain", """
, d AS (SELECT order_number, CASE WHEN order_number % 79 = 0 THEN 'REFUND' ELSE event_type END AS event_type,
               CASE WHEN order_number % 53 = 0 THEN 'XXX' ELSE currency_code END AS currency_code FROM ev)
SELECT order_number, event_type, currency_code,
       CASE WHEN order_number % 61 = 0 THEN 'order_serial missing' WHEN order_number % 79 = 0 THEN 'event_type not allowed'
            ELSE 'currency_code not allowed' END AS reason
FROM d WHERE order_number % 61 = 0 OR order_number % 79 = 0 OR order_number % 53 = 0""")
sql("dq_money_text", """SELECT productkey AS product_key,
       CASE WHEN productkey % 9 > 1 THEN CAST(price AS DOUBLE) END AS unit_price,
       CASE WHEN productkey % 9 = 0 THEN 1 ELSE 0 END AS is_bad FROM b_products""")

_REAL = {
    "sales": ("sales", {"ordernumber": "order_number", "lineitem": "line_item", "orderdate": "order_date",
                        "deliverydate": "delivery_date", "customerkey": "customer_key", "storekey": "store_key",
                        "productkey": "product_key", "quantity": "quantity", "currencycode": "currency_code"}),
    "customers": ("b_customers", {c.replace("_", ""): c for c in (
        "customerkey", "gender", "name", "city", "state_code", "state", "zip_code", "country", "continent", "birthday")}),
    "products": ("b_products", {c.replace("_", ""): c for c in (
        "productkey", "product_name", "brand", "color", "unit_cost_usd", "unit_price_usd", "subcategorykey",
        "subcategory", "categorykey", "category")}),
    "stores": ("b_stores", {c.replace("_", ""): c for c in ("storekey", "country", "state", "square_meters", "open_date")}),
    "exchangerates": ("fx", {"id": "date_key", "ratedate": "date_key", "currency": "currency_code", "exchange": "rate"}),
}
_REAL_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{f}' AS f, count({c}) AS n FROM {source}" for t, (source, cols) in _REAL.items() for f, c in cols.items())
_DOC_SQL = ", ".join(
    f"('{t.lower().replace(' ', '')}', '{f.lower().replace(' ', '')}', '{f}, of \"{t}\"')" for t, fields in DICTIONARY.items() for f in fields)
_DICTIONARY = f", doc(t, f, d) AS (VALUES {_DOC_SQL}), real_columns AS ({_REAL_SQL})"
sql("dq_dictionary", _DICTIONARY + """
SELECT coalesce(doc.t, r.t) AS table_name, coalesce(doc.f, r.f) AS field_name, CASE WHEN doc.t IS NULL THEN 0 ELSE 1 END AS documented,
       CASE WHEN r.t IS NULL THEN 0 ELSE 1 END AS present, r.n AS "values"
FROM doc FULL OUTER JOIN real_columns r ON doc.t = r.t AND doc.f = r.f""")
sql("dq_dictionary_csv", _DICTIONARY + """
SELECT doc.d AS description, coalesce(r.n, 0) AS filled FROM doc LEFT JOIN real_columns r ON doc.t = r.t AND doc.f = r.f""")
_CHECKS = """
, k AS (
  SELECT 'silver_customers' AS model, 'unique' AS "check", 'customer_key' AS detail,
         (SELECT count(*) - count(DISTINCT customerkey) FROM b_customers) AS violations
  UNION ALL SELECT 'silver_products', 'unique', 'product_key', (SELECT count(*) - count(DISTINCT productkey) FROM b_products)
  UNION ALL SELECT 'silver_stores', 'unique', 'store_key', (SELECT count(*) - count(DISTINCT storekey) FROM b_stores)
  UNION ALL SELECT 'silver_sales', 'unique', 'order_number,line_item',
         (SELECT count(*) FROM (SELECT 1 FROM sales GROUP BY order_number, line_item HAVING count(*) > 1))
  UNION ALL SELECT 'silver_sales', 'not_null', 'keys',
         (SELECT count(*) FROM sales WHERE order_number IS NULL OR product_key IS NULL OR quantity IS NULL)
  UNION ALL SELECT 'silver_sales', 'referential', 'product_key',
         (SELECT count(DISTINCT product_key) FROM sales WHERE product_key NOT IN (SELECT productkey FROM b_products))
  UNION ALL SELECT 'silver_sales', 'referential', 'customer_key',
         (SELECT count(DISTINCT customer_key) FROM sales WHERE customer_key NOT IN (SELECT customerkey FROM b_customers))
  UNION ALL SELECT 'silver_sales', 'referential', 'exchange_rate',
         (SELECT count(*) FROM (SELECT DISTINCT currency_code, order_date FROM sales s
           WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.currency_code = s.currency_code AND fx.date_key = s.order_date)))),
checks AS (SELECT *, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status FROM k)
"""
sql("dq_checks", _CHECKS + "SELECT * FROM checks")
sql("dq_run_summary", _CHECKS + """
SELECT count(*) AS total, count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'failed') AS failed,
       string_agg(model || '.' || "check" || '.' || detail, ', ' ORDER BY model || '.' || "check" || '.' || detail)
         FILTER (status = 'failed') AS failed_checks FROM checks""")
sql("dq_gate", """
, k AS (
  SELECT 'silver_sales' AS model, 'referential' AS "check", 'customer_key' AS detail,
         (SELECT count(DISTINCT customer_key) FROM sales WHERE customer_key NOT IN (SELECT customerkey FROM b_customers)) AS violations
  UNION ALL SELECT 'silver_sales', 'referential', 'product_key',
         (SELECT count(DISTINCT product_key) FROM sales WHERE product_key NOT IN (SELECT productkey FROM b_products))
  UNION ALL SELECT 'silver_sales', 'referential', 'store_key',
         (SELECT count(DISTINCT store_key) FROM sales WHERE store_key NOT IN (SELECT storekey FROM b_stores))
  UNION ALL SELECT 'fact_sales', 'completeness', 'order_number',
         (SELECT count(*) FROM (SELECT order_number, count(*) AS n FROM om GROUP BY 1) o FULL JOIN (SELECT DISTINCT order_number FROM sales) s
          ON o.order_number = s.order_number WHERE n IS NULL OR n <> 1 OR s.order_number IS NULL)
  UNION ALL SELECT 'fact_product_sales', 'reconciliation', 'quantity,total_price_usd',
         (SELECT count(*) FROM (SELECT order_number, sum(total_quantity) AS q, sum(price_usd) AS p FROM om GROUP BY 1) a
          FULL JOIN (SELECT order_number, sum(quantity) AS q, sum(price_usd) AS p FROM pm GROUP BY 1) b ON a.order_number = b.order_number
          WHERE a.q IS DISTINCT FROM b.q OR a.p IS DISTINCT FROM b.p))
SELECT *, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status FROM k""")
sql("dq_latest_per_key", """SELECT user_id, event_id, ts, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
