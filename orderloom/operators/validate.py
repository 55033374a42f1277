"""Source rules of raw order lines and model rules of the built warehouse."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.parsing import PARSERS, typed_columns
from orderloom.operators import keys
from orderloom.operators.model import Warehouse
from orderloom.schema import FOREIGN_KEYS, PRIMARY_KEYS, RAW_COLUMNS, RawDataError
from orderloom.sources.raw_csv import contract_errors

# Natural key -> attributes that every row of the key must agree on.
RELATIONSHIPS = {
    "customer_id": ["customer_region"],
    "product_id": ["product_name", "product_category"],
    "transaction_id": ["order_date", "customer_id", "customer_region", "sales_channel"],
}

# Checks in the order in which the first failure is reported.
MESSAGES = {
    "empty_dataset": "there are no order lines",
    "null_values": "order lines lack values",
    "duplicate_lines": "an order has two lines with one number",
    "invalid_order_date": "an order_date is no calendar date",
    "invalid_numbers": "an amount, count or rate is no number",
    "nonpositive_counts": "a line_number or quantity is below one",
    "nonpositive_prices": "a unit_price or unit_cost is not above zero",
    "negative_amounts": "a revenue or total_cost is below zero",
    "discount_out_of_range": "a discount lies outside 0 to 1",
    "financial_mismatch": "an amount differs from its formula",
    **{f"unstable_{key}": f"one {key} has several values" for key in RELATIONSHIPS},
}
CHECK_NUMBERS = {name: number for number, name in enumerate(MESSAGES, 1)}


def _with_types(raw: DataFrame) -> DataFrame:
    """Raw values, and the typed values in the struct `t`."""
    plain = raw.select(*RAW_COLUMNS)
    return plain.select("*", F.struct(*typed_columns(plain, RAW_COLUMNS)).alias("t"))


# Amounts of a line as their formulas give them, from the typed values.
EXPECTED = {
    "revenue": "round(t.unit_price * t.quantity * (1 - t.discount), 2)",
    "total_cost": "round(t.unit_cost * t.quantity, 2)",
    "profit": (
        "round(t.unit_price * t.quantity * (1 - t.discount), 2)"
        " - round(t.unit_cost * t.quantity, 2)"
    ),
}

FINANCIAL_MISMATCH = " OR ".join(
    f"bround(t.{name}, 2) <> {formula}" for name, formula in EXPECTED.items()
)

# Violations on single rows; a null value breaks the null rule only.
ROW_RULES = {
    "null_values": " OR ".join(f"{name} IS NULL" for name in RAW_COLUMNS),
    "invalid_order_date": "order_date IS NOT NULL AND t.order_date IS NULL",
    "invalid_numbers": " OR ".join(
        f"({name} IS NOT NULL AND t.{name} IS NULL)" for name in PARSERS if name != "order_date"
    ),
    "nonpositive_counts": "t.line_number <= 0 OR t.quantity <= 0",
    "nonpositive_prices": "t.unit_price <= 0 OR t.unit_cost <= 0",
    "negative_amounts": "t.revenue < 0 OR t.total_cost < 0",
    "discount_out_of_range": "t.discount NOT BETWEEN 0 AND 1",
    "financial_mismatch": FINANCIAL_MISMATCH,
}


def row_checks(raw: DataFrame) -> DataFrame:
    """Counts of all single-row rules in one pass."""
    counts = _with_types(raw).selectExpr(
        "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS empty_dataset",
        *[f"count_if({rule}) AS {name}" for name, rule in ROW_RULES.items()],
    )
    return _as_rows(counts, ["empty_dataset", *ROW_RULES])


def _as_rows(counts: DataFrame, names: list[str]) -> DataFrame:
    """One wide row of counts to (check_no, check_name, violation_count) rows."""
    entries = ", ".join(
        f"{CHECK_NUMBERS[name]}, '{name}', coalesce(CAST({name} AS BIGINT), 0)" for name in names
    )
    return counts.selectExpr(
        f"stack({len(names)}, {entries}) AS (check_no, check_name, violation_count)"
    )


def null_columns(raw: DataFrame) -> DataFrame:
    """Null count of every contract column."""
    counts = raw.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in RAW_COLUMNS])
    return counts.unpivot([], RAW_COLUMNS, "column_name", "null_count")


def duplicate_lines(raw: DataFrame) -> DataFrame:
    """Line keys that occur more than once.

    Numbers are compared as numbers: 1, 01 and 1.0 are one line. What is no number is compared as text.
    """
    number = PARSERS["line_number"](raw, "line_number").cast("string")
    return (
        raw.groupBy("transaction_id", F.coalesce(number, "line_number").alias("line_number"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def financial_mismatches(raw: DataFrame) -> DataFrame:
    """Lines whose amounts differ from their formulas, with the expected amounts."""
    return (
        _with_types(raw)
        .where(FINANCIAL_MISMATCH)
        .selectExpr(
            "transaction_id",
            "line_number",
            *[f"bround(t.{name}, 2) AS {name}" for name in EXPECTED],
            *[f"{formula} AS expected_{name}" for name, formula in EXPECTED.items()],
        )
    )


def unstable_keys(raw: DataFrame, key: str) -> DataFrame:
    """Keys with more than one value of an attribute, one flag per attribute.

    Distinct rows come first: map-side they shrink to about one row per key, and a hot key costs
    no more than any other. Null counts as a value of its own.
    """
    attributes = RELATIONSHIPS[key]
    plain = _distinct_values(raw, key)
    flags = [
        (
            (F.min(name) != F.max(name))
            | ((F.count_if(F.col(name).isNull()) > 0) & (F.count(name) > 0))
        )
        for name in attributes
    ]
    unstable = [
        F.coalesce(flag, F.lit(False)).alias(f"unstable_{name}")
        for flag, name in zip(flags, attributes)
    ]
    grouped = plain.groupBy(key).agg(*unstable)
    return grouped.where(reduce(or_, [F.col(f"unstable_{name}") for name in attributes]))


def _distinct_values(raw: DataFrame, key: str) -> DataFrame:
    """Distinct rows of a key and its attributes; dates are compared as dates, not as texts."""
    return raw.select(key, *typed_columns(raw, RELATIONSHIPS[key])).distinct()


def _unstable(raw: DataFrame, key: str) -> DataFrame:
    """The keys of `unstable_keys` alone: those with several distinct rows. No value is sorted or sent."""
    return keys.repeated_keys(_distinct_values(raw, key), [key])


def validate_source(raw: DataFrame) -> DataFrame:
    """All source checks: (check_no, check_name, violation_count)."""
    report = row_checks(raw)
    grouped = {
        "duplicate_lines": duplicate_lines(raw),
        **{f"unstable_{key}": _unstable(raw, key) for key in RELATIONSHIPS},
    }
    for name, rows in grouped.items():
        report = report.unionByName(_as_rows(rows.agg(F.count(F.lit(1)).alias(name)), [name]))
    return report


def require_valid(raw: DataFrame) -> DataFrame:
    """Return the lines, or raise for the first broken rule."""
    with contract_errors():
        rows = validate_source(raw).collect()
    failed = [row for row in sorted(rows, key=lambda row: row.check_no) if row.violation_count]
    if failed:
        raise RawDataError(_explain(raw, failed[0].check_name))
    return raw


def _explain(raw: DataFrame, check: str) -> str:
    message = MESSAGES[check]
    if check == "null_values":
        found = {
            row.column_name for row in null_columns(raw).where("null_count > 0").collect()
        }
        names = [name for name in RAW_COLUMNS if name in found]
        return f"{message} of {', '.join(names)}"
    key = check.removeprefix("unstable_")
    if key in RELATIONSHIPS:
        attributes = RELATIONSHIPS[key]
        counts = unstable_keys(raw, key).agg(
            *[F.max(f"unstable_{name}").alias(name) for name in attributes]
        )
        found = counts.first()
        return f"{message} of {', '.join(name for name in attributes if found[name])}"
    return message


def model_nulls(warehouse: Warehouse) -> DataFrame:
    """Rows with any null value, per table."""
    parts = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count_if(reduce(or_, [F.col(c).isNull() for c in table.columns])).alias("null_rows"),
        )
        for name, table in warehouse.tables().items()
    ]
    return reduce(DataFrame.unionByName, parts)


def model_foreign_keys(warehouse: Warehouse) -> DataFrame:
    """Distinct unresolved keys and the rows that use them, per reference."""
    rules = {f"{table}.{key}": (table, key, owner) for table, key, owner in FOREIGN_KEYS}
    zeros = keys.zero_counts(warehouse.spark, list(rules)).select(
        "rule", F.lit(0).alias("keys"), F.col("violations").alias("rows")
    )
    found = keys.unresolved_keys(warehouse.tables(), rules).select(
        "rule", F.lit(1).alias("keys"), "rows"
    )
    totals = found.unionByName(zeros).groupBy("rule").agg(
        F.sum("keys").alias("unresolved_keys"), F.sum("rows").alias("unresolved_rows")
    )
    return totals.select(
        F.substring_index("rule", ".", 1).alias("table_name"),
        F.substring_index("rule", ".", -1).alias("key_name"),
        "unresolved_keys",
        "unresolved_rows",
    )


def require_valid_model(warehouse: Warehouse) -> Warehouse:
    """Raise for nulls, unresolved keys or repeated dimension keys."""
    for row in model_nulls(warehouse).where("null_rows > 0").collect():
        raise RawDataError(f"rows of {row.table_name} lack values")
    for row in model_foreign_keys(warehouse).where("unresolved_keys > 0").collect():
        raise RawDataError(f"{row.table_name} has a {row.key_name} without its dimension row")
    for name, table in warehouse.dimensions().items():
        if not keys.repeated_keys(table, [PRIMARY_KEYS[name]]).isEmpty():
            raise RawDataError(f"{name} repeats {PRIMARY_KEYS[name]} values")
    return warehouse
