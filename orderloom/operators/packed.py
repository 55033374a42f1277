"""Fact lines as few 64-bit words while they travel between tasks.

A shuffle sends every column of a row in at least eight bytes and compresses runs of zeros badly, so a
line's small numbers share words and its ids travel as the numbers in them. This holds any line: one
with a value that is missing, too large, of another form, or off its formula carries its columns whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ids of this form, with 1 to 17 digits, are numbers; the prefixes are those of schema.Limits.
PREFIXES = {"transaction_id": "TXN", "customer_id": "CUST", "product_id": "PROD"}

# Word -> column -> bits. Decimals count in units of their last digit. Signed words keep 63 bits.
WORDS = {
    "_counts": {"date_key": 25, "line_number": 10, "quantity": 14, "discount": 14},
    "_prices": {"unit_price": 28, "unit_cost": 27, "channel_key": 8},
}

# Nearly always zero: what the line's amounts differ from their formulas.
ZEROS = ["revenue", "total_cost", "profit"]

WHOLE = "_whole"


def number_of(name: str) -> str:
    """Name of the column with an id's number."""
    return f"_{name}"


def id_number(name: str, text: Column) -> Column:
    """An id as a number to join on: its digits after a 1, or a negative hash for another form.

    Numbers above zero are equal for equal ids only. Null stays null.
    """
    prefix = PREFIXES[name]
    digits = F.substring(text, len(prefix) + 1, 17)
    number = F.concat(F.lit("1"), digits).try_cast("bigint")
    other = F.xxhash64(text).bitwiseOR(F.lit(-(1 << 63)))
    return F.when(text.rlike(f"^{prefix}[0-9]{{1,17}}\\z"), number).when(text.isNotNull(), other)


def _id_text(name: str) -> Column:
    digits = F.substring(F.col(number_of(name)).cast("string"), 2, 18)
    return F.concat(F.lit(PREFIXES[name]), digits)


def _scale(kind: T.DataType) -> int:
    return kind.scale if isinstance(kind, T.DecimalType) else 0


def _units(column: Column, kind: T.DataType) -> Column:
    scale = _scale(kind)
    return (column * F.lit(10**scale) if scale else column).cast("bigint")


def _value(units: Column, kind: T.DataType) -> Column:
    scale = _scale(kind)
    if not scale:
        return units.cast(kind)
    step = F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(scale, scale))
    return (units.cast(T.DecimalType(18, 0)) * step).cast(kind)


def _places(word: str) -> Iterator[tuple[str, int, int]]:
    """(column, bits, bits above its place), the first column highest."""
    above = sum(WORDS[word].values())
    for name, bits in WORDS[word].items():
        above -= bits
        yield name, bits, above


def pack(lines: DataFrame) -> DataFrame:
    """Lines with the columns of WORDS, PREFIXES and ZEROS in words; other columns stay."""
    kinds = {field.name: field.dataType for field in lines.schema.fields}
    small = [(name, bits) for columns in WORDS.values() for name, bits in columns.items()]
    fits = [
        *[F.col(name).rlike(f"^{prefix}[0-9]{{1,17}}\\z") for name, prefix in PREFIXES.items()],
        *[F.col(name).between(0, F.lit(Decimal((1 << bits) - 1).scaleb(-_scale(kinds[name])))) for name, bits in small],
        *[F.col(name) == 0 for name in ZEROS],
    ]
    plain = F.coalesce(reduce(and_, fits), F.lit(False))
    packed = [*PREFIXES, *[name for name, _ in small], *ZEROS]

    def word(name: str) -> Column:
        parts = [
            F.shiftleft(_units(F.col(column), kinds[column]), above)
            for column, _, above in _places(name)
        ]
        return F.when(plain, reduce(lambda a, b: a.bitwiseOR(b), parts)).otherwise(F.lit(0).cast("bigint"))

    return lines.select(
        *[name for name in lines.columns if name not in packed],
        *[id_number(name, F.col(name)).alias(number_of(name)) for name in PREFIXES],
        *[word(name).alias(name) for name in WORDS],
        F.when(~plain, F.struct(*packed)).alias(WHOLE),
    )


def unpacked(lines: DataFrame, name: str) -> Column:
    """One column of packed lines."""
    kind = next(f.dataType for f in lines.schema[WHOLE].dataType.fields if f.name == name)
    if name in PREFIXES:
        value = _id_text(name)
    elif name in ZEROS:
        value = F.lit(0).cast(kind)
    else:
        word = next(word for word, columns in WORDS.items() if name in columns)
        bits, above = next((bits, above) for column, bits, above in _places(word) if column == name)
        units = F.shiftright(F.col(word), above).bitwiseAND(F.lit((1 << bits) - 1))
        value = _value(units, kind)
    return F.when(F.col(WHOLE).isNull(), value).otherwise(F.col(f"{WHOLE}.{name}"))


def unpack(lines: DataFrame) -> DataFrame:
    """All columns of packed lines but the ids that are gone."""
    kept = {*PREFIXES} - {name for name in PREFIXES if number_of(name) not in lines.columns}
    names = [
        field.name
        for field in lines.schema[WHOLE].dataType.fields
        if (field.name not in PREFIXES or field.name in kept) and field.name not in lines.columns
    ]
    hidden = [*WORDS, WHOLE, *[number_of(name) for name in PREFIXES]]
    return lines.select(
        *[name for name in lines.columns if name not in hidden],
        *[unpacked(lines, name).alias(name) for name in names],
    )


def with_key(lines: DataFrame, owners: DataFrame, name: str, key: str) -> DataFrame:
    """Left join of packed lines with the key of their id; the id goes."""
    number, text = number_of(name), "_text"
    known = owners.select(id_number(name, F.col(name)).alias("_number"), F.col(name).alias(text), key)
    whole = F.col(f"{WHOLE}.{name}")
    # Numbers above zero say it all; lines with other ids are whole.
    same = (F.col(number) == F.col("_number")) & ((F.col(number) > 0) | (whole == F.col(text)))
    return lines.join(known, same, "left").drop(number, "_number", text)
