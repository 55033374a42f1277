"""Column contracts, table schemas and the value limits of the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names and order of the raw order-line contract.
RAW_COLUMNS = [
    "transaction_id",
    "line_number",
    "order_date",
    "customer_id",
    "product_id",
    "product_name",
    "product_category",
    "unit_price",
    "quantity",
    "discount",
    "revenue",
    "unit_cost",
    "total_cost",
    "profit",
    "customer_region",
    "sales_channel",
]


PRICE = T.DecimalType(12, 2)
RATE = T.DecimalType(5, 4)
AMOUNT = T.DecimalType(14, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TABLES: dict[str, T.StructType] = {
    "dim_date": _table(
        date_key=T.IntegerType(),
        full_date=T.DateType(),
        day=T.IntegerType(),
        month=T.IntegerType(),
        month_name=T.StringType(),
        quarter=T.IntegerType(),
        year=T.IntegerType(),
        day_of_week=T.StringType(),
        is_weekend=T.BooleanType(),
    ),
    "dim_customer": _table(
        customer_key=T.IntegerType(),
        customer_id=T.StringType(),
        region=T.StringType(),
    ),
    "dim_category": _table(
        category_key=T.IntegerType(),
        category_name=T.StringType(),
    ),
    "dim_product": _table(
        product_key=T.IntegerType(),
        product_id=T.StringType(),
        product_name=T.StringType(),
        category_key=T.IntegerType(),
    ),
    "dim_channel": _table(
        channel_key=T.IntegerType(),
        channel_name=T.StringType(),
    ),
    "fact_sales": _table(
        sales_key=T.LongType(),
        transaction_id=T.StringType(),
        line_number=T.IntegerType(),
        date_key=T.IntegerType(),
        customer_key=T.IntegerType(),
        product_key=T.IntegerType(),
        channel_key=T.IntegerType(),
        quantity=T.IntegerType(),
        unit_price=PRICE,
        discount=RATE,
        revenue=AMOUNT,
        unit_cost=PRICE,
        total_cost=AMOUNT,
        profit=AMOUNT,
    ),
}

# Fixed value: greatest line number of an order.
MAX_LINES = 32_767

FACT_COLUMNS = TABLES["fact_sales"].fieldNames()

# Physical partition column of the stored fact; it follows from date_key.
PARTITION_COLUMN = "sale_year"

# One row per reference from a table to the dimension that owns the key.
FOREIGN_KEYS = [
    ("fact_sales", "date_key", "dim_date"),
    ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"),
    ("fact_sales", "channel_key", "dim_channel"),
    ("dim_product", "category_key", "dim_category"),
]

PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_category": "category_key",
    "dim_product": "product_key",
    "dim_channel": "channel_key",
    "fact_sales": "sales_key",
}

NATURAL_KEYS = {
    "dim_date": ["full_date"],
    "dim_customer": ["customer_id"],
    "dim_category": ["category_name"],
    "dim_product": ["product_id"],
    "dim_channel": ["channel_name"],
    "fact_sales": ["transaction_id", "line_number"],
}

# Declared text lengths per table and column.
TEXT_LIMITS = {
    "dim_date": {"month_name": 9, "day_of_week": 9},
    "dim_customer": {"customer_id": 20, "region": 50},
    "dim_category": {"category_name": 100},
    "dim_product": {"product_id": 20, "product_name": 150},
    "dim_channel": {"channel_name": 50},
    "fact_sales": {"transaction_id": 20},
}


@dataclass(frozen=True)
class Limits:
    """Bounds of the declared constraints that depend on the data set."""

    min_year: int = 2000
    max_year: int = 2100
    customer_id: str = "^CUST[0-9]{5}$"
    product_id: str = "^PROD[0-9]{3}$"
    transaction_id: str = "^TXN[0-9]{7}$"


class RawDataError(ValueError):
    """The raw order lines break their contract."""


class WarehouseError(ValueError):
    """A warehouse version may not be published."""
