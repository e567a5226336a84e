"""Scalar building blocks, each a function from columns to a column; all stay in JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shapes that typed text must have before it is cast.
INTEGER = r"^-?[0-9]+$"
DECIMAL = r"^-?[0-9]+(\.[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
OFFSET = r"(Z|[+-][0-9]{2}:[0-9]{2})$"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def date_key(value: Column) -> Column:
    """yyyymmdd as bigint; null stays null."""
    return F.date_format(value, "yyyyMMdd").cast("bigint")


def deterministic_key(namespace: str, **fields: Column) -> Column:
    """sha256 of a JSON object of the namespace and the fields, nulls kept."""
    body = F.struct(F.lit(namespace).alias("key_namespace"), *(c.alias(n) for n, c in fields.items()))
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)


def optional_key(key: Column, *pointers: Column) -> Column:
    """The key if all pointers are there, else null."""
    there = F.lit(True)
    for p in pointers:
        there = there & p.isNotNull()
    return F.when(there, key)


def evidence(**fields: Column) -> Column:
    """name=<bytes>:value of each field, -1 for null, joined by | and hashed."""
    parts = [F.concat(F.lit(f"{n}="), F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-1:"))) for n, c in fields.items()]
    return F.sha2(F.concat_ws("|", *parts), 256)


def stable_integer(low: int, high: int, *parts: Column) -> Column:
    """low + first 8 bytes of sha256(parts joined by :) modulo the range; the same on every engine."""
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (F.lit(low) + F.pmod(drawn, F.lit(high - low + 1).cast("decimal(20,0)")).cast("bigint")).cast("bigint")


def list_members(text: Column, separator: str = "|") -> Column:
    """Members of a delimited list; null or empty text has none."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "\\" + separator))


def signed_amount(direction: Column, amount: Column, credit: str = "credit") -> Column:
    """Credits count up, everything else (a null direction too) down."""
    return F.when(direction == credit, amount).otherwise(-amount)


def strict_integer(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def strict_decimal(text: Column, precision: int = 18, scale: int = 2) -> Column:
    """Plain decimals that fit the shape; others become null instead of being rounded."""
    fits = text.rlike(DECIMAL) & (F.length(F.regexp_extract(text, r"\.([0-9]+)$", 1)) <= scale)
    return F.when(fits, text.try_cast(f"decimal({precision},{scale})"))


def strict_date(text: Column) -> Column:
    return F.when(text.rlike(DATE), text.try_cast("date"))


def strict_timestamp(text: Column) -> Column:
    """ISO timestamps with an offset; others become null."""
    return F.when(text.rlike(OFFSET), text.try_cast("timestamp"))


def boolean_text(text: Column) -> Column:
    lowered = F.lower(text)
    return F.when(lowered.isin("true", "1"), True).when(lowered.isin("false", "0"), False)


def typed(text: Column, kind: str) -> Column:
    """Blank-aware cast of contract text: STRING, STRING_LIST, INTEGER, NUMERIC(p,s), DATE, TIMESTAMP, BOOLEAN."""
    if kind == "STRING_LIST":
        return list_members(text)
    value = blank_to_null(text)
    if kind.startswith("NUMERIC"):
        precision, scale = map(int, kind[8:-1].split(","))
        return strict_decimal(value, precision, scale)
    return {"STRING": lambda x: x, "INTEGER": strict_integer, "DATE": strict_date, "TIMESTAMP": strict_timestamp, "BOOLEAN": boolean_text}[kind](value)


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of a date; weeks begin on Monday, day_of_week counts from Sunday = 1."""
    long = lambda c: c.cast("bigint")
    return {
        "date_key": date_key(day), "calendar_year": long(F.year(day)), "calendar_quarter": long(F.quarter(day)), "calendar_month": long(F.month(day)), "day_of_month": long(F.day(day)), "day_of_week": long(F.dayofweek(day)),
        "iso_year": long(F.extract(F.lit("YEAROFWEEK"), day)), "iso_week": long(F.weekofyear(day)), "month_name": F.date_format(day, "MMMM"), "day_name": F.date_format(day, "EEEE"),
        "week_start": F.trunc(day, "week"), "month_start": F.trunc(day, "month"), "quarter_start": F.trunc(day, "quarter"), "year_start": F.trunc(day, "year"), "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def half_up(value: Column, scale: int) -> Column:
    return F.round(value, scale)
