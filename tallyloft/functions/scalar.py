"""Column expressions shared by the layers. Everything stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloft.schemas import EVENT_TIME_FORMAT, RATE, TOTAL

# A price or line total as it was sent; times a quantity no digit is lost.
EXACT = "decimal(26,10)"


def money(raw: Column) -> Column:
    """``' $1,234.50 '`` to decimal(15,2); unreadable text becomes NULL and is reported by the quality checks."""
    return F.regexp_replace(F.trim(raw), "[$,]", "").try_cast("decimal(15,2)")


def expensive_flag(price: Column) -> Column:
    return F.when(price > 100, "Yes").otherwise("No")


def epoch_ms_date(raw: Column) -> Column:
    return F.to_date(F.timestamp_millis(raw.try_cast("bigint")))


def parse_date(raw: Column, fmt: str) -> Column:
    return F.try_to_timestamp(raw, F.lit(fmt)).cast("date")


def event_time(raw: Column) -> Column:
    return F.try_to_timestamp(raw, F.lit(EVENT_TIME_FORMAT))


def iso_time(raw: Column) -> Column:
    """ISO-8601 with ``Z`` or an offset; empty and unreadable text become NULL."""
    return F.nullif(F.trim(raw), F.lit("")).try_cast("timestamp")


def margin(cost: Column, price: Column) -> Column:
    """Share of the price kept; NULL where the price is zero."""
    return F.try_divide((price - cost).cast("double"), price.cast("double"))


def local_amount(usd: Column, rate: Column) -> Column:
    """USD total times rate, as decimal(38,8): no digit is lost."""
    return usd.cast(TOTAL) * rate.cast(RATE)


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """quantity * price, computed on decimals, rounded once to cents and handed out as double."""
    return F.round(quantity * unit_price.try_cast(EXACT), 2).cast("double")


def is_amount(raw: Column) -> Column:
    """Neither NaN nor infinite nor beyond all bounds."""
    return raw.try_cast(EXACT).isNotNull()


def lag_seconds(seen_at: Column, event_ts: Column) -> Column:
    return F.unix_timestamp(seen_at) - F.unix_timestamp(event_ts)


def sales_channel(store_key: Column) -> Column:
    return F.when(store_key == 0, "Online").otherwise("In-Store")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def is_bad_text(raw: Column) -> Column:
    """Text that is there but cannot be read as money."""
    return (F.trim(raw) != "") & money(raw).isNull()


def once(column: Column, name: str) -> Column:
    """A one-row generator: the optimizer cannot copy ``column`` into each of its later uses."""
    return F.explode(F.array(column)).alias(name)
