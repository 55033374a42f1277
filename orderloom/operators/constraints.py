"""Declared table constraints, which Spark does not enforce, as one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators import keys
from orderloom.operators.model import Warehouse
from orderloom.schema import (
    FOREIGN_KEYS,
    MAX_LINES,
    NATURAL_KEYS,
    PRIMARY_KEYS,
    TABLES,
    TEXT_LIMITS,
    Limits,
)


def _value_rules(limits: Limits) -> dict[str, dict[str, str]]:
    """Conditions that hold for a valid row; as in SQL, null satisfies a check."""
    return {
        "dim_date": {
            "day_range": "day BETWEEN 1 AND 31",
            "month_range": "month BETWEEN 1 AND 12",
            "quarter_range": "quarter BETWEEN 1 AND 4",
            "year_range": f"year BETWEEN {limits.min_year} AND {limits.max_year}",
            "date_key_matches_date": (
                "date_key = year(full_date) * 10000 + month(full_date) * 100 + day(full_date)"
            ),
        },
        "dim_customer": {
            "customer_key_positive": "customer_key > 0",
            "customer_id_format": f"customer_id RLIKE '{limits.customer_id}'",
        },
        "dim_category": {"category_key_positive": "category_key > 0"},
        "dim_product": {
            "product_key_positive": "product_key > 0",
            "product_id_format": f"product_id RLIKE '{limits.product_id}'",
        },
        "dim_channel": {"channel_key_positive": "channel_key > 0"},
        "fact_sales": {
            "sales_key_positive": "sales_key > 0",
            "transaction_id_format": f"transaction_id RLIKE '{limits.transaction_id}'",
            "line_number_positive": "line_number > 0",
            "line_number_range": f"line_number BETWEEN -{MAX_LINES + 1} AND {MAX_LINES}",
            "quantity_positive": "quantity > 0",
            "unit_price_positive": "unit_price > 0",
            "discount_range": "discount BETWEEN 0 AND 1",
            "revenue_nonnegative": "revenue >= 0",
            "unit_cost_nonnegative": "unit_cost >= 0",
            "total_cost_nonnegative": "total_cost >= 0",
            "revenue_calculation": "revenue = round(unit_price * quantity * (1 - discount), 2)",
            "cost_calculation": "total_cost = round(unit_cost * quantity, 2)",
            "profit_calculation": "profit = revenue - total_cost",
        },
    }


def _declared_rules(table: str) -> dict[str, str]:
    """Not-null, text-length and decimal-precision rules that follow from the schema."""
    rules: dict[str, str] = {}
    for field in TABLES[table].fields:
        name, kind = field.name, field.dataType
        rules[f"{name}_not_null"] = f"{name} IS NOT NULL"
        if isinstance(kind, T.DecimalType):
            rules[f"{name}_precision"] = _fits(field)
    for column, length in TEXT_LIMITS[table].items():
        rules[f"{column}_length"] = f"length({column}) <= {length}"
    return rules


def row_rules(table: str, limits: Limits) -> dict[str, str]:
    """All single-row constraints of a table, by name, as SQL conditions."""
    return {**_declared_rules(table), **_value_rules(limits)[table]}


def row_counts(table: str, limits: Limits) -> list[Column]:
    """Broken rows of each single-row constraint, as aggregates."""
    rules = row_rules(table, limits)
    return [F.expr(f"count_if(NOT ({rule}))").alias(name) for name, rule in rules.items()]


def row_constraints(table: str, frame: DataFrame, limits: Limits) -> DataFrame:
    """All single-row constraints of a table in one pass."""
    counts = frame.select(*row_counts(table, limits))
    return counts.unpivot([], counts.columns, "constraint_name", "violations").select(
        F.lit(table).alias("table_name"), "constraint_name", "violations"
    )


def unfit_rows(table: str, frame: DataFrame) -> DataFrame:
    """Rows with values that their declared type cannot hold: table_name, reasons, row (as JSON).

    Nothing is cast: a value is named as it is, with the type it does not fit.
    """
    reasons = [
        F.when(
            F.col(field.name).isNotNull() & ~F.expr(rule),
            F.format_string(f"{field.name} = %s does not fit {_declared(field)}", F.col(field.name).cast("string")),
        )
        for field in TABLES[table].fields
        if (rule := _fits(field))
    ]
    if not reasons:
        reasons = [F.lit(None).cast("string")]
    return frame.select(
        F.lit(table).alias("table_name"),
        F.array_compact(F.array(*reasons)).alias("reasons"),
        F.to_json(F.struct(*frame.columns)).alias("row"),
    ).where(F.size("reasons") > 0)


def _declared(field: T.StructField) -> str:
    return "smallint" if field.name == "line_number" else field.dataType.simpleString()


def _fits(field: T.StructField) -> str | None:
    """Condition under which a decimal, or a line number, fits its declared type."""
    if isinstance(field.dataType, T.DecimalType):
        return f"try_cast({field.name} AS {field.dataType.simpleString()}) <=> {field.name}"
    if field.name == "line_number":
        return f"line_number BETWEEN -{MAX_LINES + 1} AND {MAX_LINES}"
    return None


def constraint_report(warehouse: Warehouse, limits: Limits = Limits()) -> DataFrame:
    """(table_name, constraint_name, violations) of every declared constraint.

    Unique constraints count repeated keys, references count rows with a known but missing key.
    """
    tables = warehouse.tables()
    rows = [row_constraints(table, frame, limits) for table, frame in tables.items()]
    return reduce(DataFrame.unionByName, [*rows, key_constraints(warehouse)])


def key_constraints(warehouse: Warehouse) -> DataFrame:
    """(table_name, constraint_name, violations) of the unique and reference constraints."""
    tables = warehouse.tables()
    unique = {
        f"{table}.{'_'.join(columns)}_unique": (table, columns)
        for table in tables
        for columns in ([PRIMARY_KEYS[table]], NATURAL_KEYS[table])
    }
    references = {
        f"{table}.{key}_reference": (table, key, owner) for table, key, owner in FOREIGN_KEYS
    }
    keyed = keys.repeated_key_counts(tables, unique, ignore_null=True).unionByName(
        keys.unresolved_row_counts(tables, references, ignore_null=True)
    )
    return keyed.select(
        F.substring_index("rule", ".", 1).alias("table_name"),
        F.substring_index("rule", ".", -1).alias("constraint_name"),
        "violations",
    )
