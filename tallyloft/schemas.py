"""Declared schemas and enum domains."""

from __future__ import annotations

import json

from pyspark.sql import types as T

LONG, INT, STR, DATE, TS, DBL = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampType(), T.DoubleType(),
)
MONEY = T.DecimalType(15, 2)
# Totals in USD; times a rate they fill decimal(38,8) exactly.
TOTAL = T.DecimalType(19, 2)
RATE = T.DecimalType(18, 6)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Bronze tables, one JSON object per line. The price fields are mixed case in the files
# and Spark's JSON reader matches names case-sensitively.
BRONZE = {
    "customers": struct(
        customerkey=LONG, gender=STR, name=STR, city=STR, state_code=STR, state=STR,
        zip_code=STR, country=STR, continent=STR, birthday=STR),
    "data_dictionary": struct(id=LONG, table_name=STR, field_name=STR, description=STR),
    "exchange_rates": struct(id=LONG, rate_date=STR, currency=STR, exchange=RATE),
    "sales": struct(
        order_number=LONG, line_item=INT, order_date=DATE, delivery_date=DATE, customerkey=LONG,
        storekey=LONG, productkey=LONG, quantity=INT, currency_code=STR),
    "stores": struct(storekey=LONG, country=STR, state=STR, square_meters=T.DecimalType(18, 2), open_date=DATE),
    "products": struct(
        productkey=LONG, product_name=STR, brand=STR, color=STR, Unit_Cost_USD=STR, Unit_Price_USD=STR,
        subcategorykey=INT, subcategory=STR, categorykey=INT, category=STR),
}

# Enum domains of the event contract.
EVENT_TYPES = ["ORDER", "CANCEL", "RETURN"]
CURRENCIES = ["USD", "CAD", "GBP", "AUD", "EUR"]
PAYMENT_METHODS = ["CASH", "WALLET", "DEBIT_CARD", "CREDIT_CARD"]

DOMAINS = {"event_type": EVENT_TYPES, "currency_code": CURRENCIES, "payment_method": PAYMENT_METHODS}

# The sales event, in wire order.
SALES_EVENT = struct(
    event_type=STR, order_number=LONG, line_item=INT, order_serial=STR, order_date=STR,
    delivery_date=LONG, customerkey=LONG, storekey=LONG, productkey=LONG, quantity=INT,
    currency_code=STR, payment_method=STR, status=STR, order_group_id=STR,
    unit_price_usd=DBL, line_total_amount=DBL, event_timestamp=STR)

NULLABLE_EVENT_FIELDS = {"delivery_date"}
EVENT_TIME_FORMAT = "dd-MM-yyyy HH:mm:ss"

# The two processed messages and the key of an order group.
ITEM_MESSAGE = struct(
    order_serial=STR, order_date=STR, event_type=STR, product_name=STR, category=STR, quantity=INT,
    unit_price_usd=DBL, total_sales_usd=DBL, line_total_amount=DBL, storekey=LONG, store_country=STR,
    store_city=STR, customerkey=LONG, payment_method=STR, is_return=INT, is_cancel=INT,
    processing_lag=LONG, sales_channel=STR, event_ts=STR)

ORDER_MESSAGE = struct(
    order_group_id=STR, order_date=STR, event_type=STR, total_items_count=LONG, total_order_local=DBL,
    total_order_usd=DBL, store_country=STR, store_city=STR, currency_code=STR, customerkey=LONG,
    payment_method=STR, is_return_flag=INT, is_cancel_flag=INT, max_lag_seconds=LONG, last_update=STR)

ORDER_KEYS = [
    "order_group_id", "event_type", "store_country", "store_city", "currency_code", "order_date",
    "customerkey", "payment_method"]

_AVRO_PRIMITIVES = {"bigint": "long", "int": "int", "string": "string", "double": "double"}


def sales_event_avro() -> str:
    """The Avro form of SALES_EVENT, for readers with the Avro package on the classpath."""
    enum_names = {"event_type": "EventType", "currency_code": "CurrencyCode", "payment_method": "PaymentMethod"}
    fields = []
    for field in SALES_EVENT.fields:
        kind = _AVRO_PRIMITIVES[field.dataType.simpleString()]
        if field.name in DOMAINS:
            kind = {"type": "enum", "name": enum_names[field.name], "symbols": DOMAINS[field.name]}
        elif field.name in NULLABLE_EVENT_FIELDS:
            kind = ["null", kind]
        fields.append({"name": field.name, "type": kind})
    return json.dumps({"type": "record", "name": "SalesEvent", "fields": fields})


# Documented (table, field) pairs of the business data dictionary.
DICTIONARY = {
    "Sales": ["Order Number", "Line Item", "Order Date", "Delivery Date", "CustomerKey", "StoreKey",
              "ProductKey", "Quantity", "Currency Code"],
    "Customers": ["CustomerKey", "Gender", "Name", "City", "State Code", "State", "Zip Code", "Country",
                  "Continent", "Birthday"],
    "Products": ["ProductKey", "Product Name", "Brand", "Color", "Unit Cost USD", "Unit Price USD",
                 "SubcategoryKey", "Subcategory", "CategoryKey", "Category"],
    "Stores": ["StoreKey", "Country", "State", "Square Meters", "Open Date"],
    "Exchange Rates": ["Date", "Currency", "Exchange"],
}
