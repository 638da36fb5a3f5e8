"""From framed bytes to sales events, with a reason for every message that cannot be used.

A frame is one zero byte, a four-byte schema id, then the body.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloft import schemas as S
from tallyloft.functions.scalar import event_time, is_amount, once
from tallyloft.operators.quality import domain_reason

HEADER_BYTES = 5
_CORRUPT = "_corrupt_record"
REQUIRED = [f.name for f in S.SALES_EVENT.fields if f.name not in S.NULLABLE_EVENT_FIELDS]

BodyReader = Callable[[Column], Column]


def magic_byte(value: Column) -> Column:
    return F.hex(F.substring(value, 1, 1))


def schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def body(value: Column) -> Column:
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value) - HEADER_BYTES)


def json_body(raw: Column) -> Column:
    """JSON bodies; an unreadable one is kept as text in an extra field."""
    schema = T.StructType(S.SALES_EVENT.fields + [T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(
        raw.cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def avro_body(raw: Column) -> Column:
    """Avro bodies; needs the Avro package on the classpath."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(raw, S.sales_event_avro(), {"mode": "PERMISSIVE"})


def decode(raw: DataFrame, read_body: BodyReader = json_body) -> DataFrame:
    """Keep the message columns, add ``event`` and ``reason`` (NULL for a usable message)."""
    value = F.col("value")
    # The body is parsed once per message, not once per field that is read from it.
    parsed = raw.select("*", once(F.when(F.length(value) > HEADER_BYTES, read_body(body(value))), "event"))
    unreadable = F.col("event").isNull()
    if _CORRUPT in parsed.schema["event"].dataType.names:
        unreadable = unreadable | F.col(f"event.{_CORRUPT}").isNotNull()
    contract = domain_reason(S.DOMAINS, REQUIRED, lambda name: F.col(f"event.{name}"))
    reason = (
        F.when(value.isNull() | (F.length(value) <= HEADER_BYTES), "short frame")
        .when(magic_byte(value) != "00", "wrong magic byte")
        .when(unreadable, "unreadable body")
        .when(contract.isNotNull(), contract)
        .when(~is_amount(F.col("event.unit_price_usd")), "unit_price_usd no amount")
        .when(~is_amount(F.col("event.line_total_amount")), "line_total_amount no amount")
        .when(event_time(F.col("event.event_timestamp")).isNull(), "event_timestamp unreadable")
    )
    return parsed.select("*", once(reason, "reason"))


def good(decoded: DataFrame) -> DataFrame:
    """Usable events; message columns such as the arrival time stay beside the event fields."""
    carried = [c for c in decoded.columns if c not in ("value", "event", "reason", "key")]
    return decoded.where("reason IS NULL").select(*carried, *[f"event.{name}" for name in S.SALES_EVENT.names])


def rejected(decoded: DataFrame) -> DataFrame:
    """Dead letters: the untouched message with its reason and schema id."""
    return decoded.where("reason IS NOT NULL").withColumn("schema_id", schema_id(F.col("value"))).drop("event")


def frame(payload: Column, schema: int = 1) -> Column:
    """The inverse: header bytes before a payload."""
    return F.concat(F.unhex(F.lit("00" + format(schema, "08X"))), payload.cast("binary"))
