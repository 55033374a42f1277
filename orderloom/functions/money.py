"""Decimal money, null-safe ratios and display text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schema import AMOUNT, PRICE, RATE

MISSING = "—"


def line_revenue(price: Column, quantity: Column, discount: Column) -> Column:
    """price x quantity x (1 - discount), rounded half up to cents."""
    return F.round(price * quantity * (F.lit(1) - discount), 2)


def line_cost(cost: Column, quantity: Column) -> Column:
    return F.round(cost * quantity, 2)


def as_price(value: Column) -> Column:
    """Round half even to cents; null when the value does not fit the column."""
    return F.bround(value, 2).try_cast(PRICE)


def as_amount(value: Column) -> Column:
    return F.bround(value, 2).try_cast(AMOUNT)


def as_rate(value: Column) -> Column:
    return F.bround(value, 4).try_cast(RATE)


def sum_cents(name: str) -> Column:
    """Sum of an amount in whole cents.

    Adding 64-bit integers avoids a decimal object per row; ANSI mode reports an overflow.
    """
    return F.sum((F.col(name) * 100).cast("bigint")).alias(name)


def dollars(cents: Column) -> Column:
    return (cents.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; null when the denominator is zero or null."""
    divisor = denominator.cast("double")
    return numerator.cast("double") / F.nullif(divisor, F.lit(0.0))


def growth(current: Column, prior: Column) -> Column:
    return ratio(current.cast("double") - prior.cast("double"), prior)


def short_money(value: Column) -> Column:
    """$1.23M, $4.5K or $6.78, by size."""
    number = value.cast("double")
    text = (
        F.when(F.abs(number) >= 1_000_000, F.format_string("$%.2fM", number / 1_000_000))
        .when(F.abs(number) >= 1_000, F.format_string("$%.1fK", number / 1_000))
        .otherwise(F.format_string("$%,.2f", number))
    )
    return F.when(number.isNull(), MISSING).otherwise(text)


def exact_money(value: Column) -> Column:
    number = value.cast("double")
    return F.when(number.isNull(), MISSING).otherwise(F.format_string("$%,.2f", number))


def percent(value: Column) -> Column:
    """One decimal, computed from the scaled double."""
    return F.when(value.isNull(), MISSING).otherwise(
        F.format_string("%.1f%%", value.cast("double") * 100)
    )


def grouped(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_string("%,d", value.cast("bigint"))
