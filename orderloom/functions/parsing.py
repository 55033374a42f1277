"""Typed values from raw text: failures become null, never an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for any contract value; rounding to the stored scale happens later.
WIDE_MONEY = T.DecimalType(22, 10)
WIDE_RATE = T.DecimalType(16, 10)


def is_text(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.StringType)


def whole_number(frame: DataFrame, name: str) -> Column:
    """Integer value; text such as '2.0' is whole, '2.5' is not a number here."""
    if not is_text(frame, name):
        return F.col(name).cast("int")
    number = F.col(name).try_cast(T.DecimalType(38, 10))
    return F.when(number == F.floor(number), number.try_cast("int"))


def money(frame: DataFrame, name: str) -> Column:
    return F.col(name).try_cast(WIDE_MONEY) if is_text(frame, name) else F.col(name)


def rate(frame: DataFrame, name: str) -> Column:
    return F.col(name).try_cast(WIDE_RATE) if is_text(frame, name) else F.col(name)


def calendar_date(frame: DataFrame, name: str) -> Column:
    if is_text(frame, name):
        return F.try_to_date(F.col(name), "yyyy-MM-dd")
    return F.col(name).cast("date")


# Contract columns that are not plain text.
PARSERS = {
    "line_number": whole_number,
    "order_date": calendar_date,
    "unit_price": money,
    "quantity": whole_number,
    "discount": rate,
    "revenue": money,
    "unit_cost": money,
    "total_cost": money,
    "profit": money,
}


def typed_columns(frame: DataFrame, names: list[str]) -> list[Column]:
    return [
        (PARSERS[name](frame, name) if name in PARSERS else F.col(name)).alias(name)
        for name in names
    ]
