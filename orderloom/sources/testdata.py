"""Order lines in the raw contract, derived from TPC-H style Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.model import Warehouse, line_measures
from orderloom.operators.numbering import number_within
from orderloom.schema import PRICE, RATE, RAW_COLUMNS, Limits

# Product ids have five digits here and the calendar starts in 1995.
LIMITS = Limits(
    min_year=1990,
    product_id="^PROD[0-9]{5,}$",
    customer_id="^CUST[0-9]{5,}$",
    transaction_id="^TXN[0-9]{7,}$",
)

# Source line numbers repeat within an order, so lines are numbered again by content.
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """Lines with contract columns first and the source columns kept.

    Places meet the orders, of which there are fewer, so lines go through two exchanges, not three.
    The handful of region names is joined last, and days travel as days.
    """
    places = (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_regionkey")
    )
    orders = (
        _table(spark, folder, "orders")
        .withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
    )
    regions = F.broadcast(_table(spark, folder, "region"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return line_measures(
        joined.withColumns(
            {
                "transaction_id": F.format_string("TXN%07d", "l_orderkey"),
                "order_date": F.col("o_orderdate"),
                "customer_id": F.format_string("CUST%05d", "o_custkey"),
                "product_id": F.format_string("PROD%05d", "p_partkey"),
                "product_name": F.col("p_name"),
                "product_category": F.col("p_type"),
                "quantity": F.col("l_quantity").cast("int"),
                "discount": F.col("l_discount").cast(RATE),
                "unit_cost": F.col("p_retailprice").cast(PRICE),
                "customer_region": F.col("r_name"),
                "sales_channel": F.col("o_orderpriority"),
            }
        ).withColumn("unit_price", _unit_price())
    )


def _unit_price() -> Column:
    """Extended price per unit in whole cents, half up."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    units = F.col("quantity").cast("bigint")
    per_unit = F.call_function("div", 2 * cents + units, 2 * units)
    return (per_unit.cast("decimal(14,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(PRICE)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Clean order lines in the contract."""
    lines = _table(spark, folder, "lineitem").select("l_orderkey", *LINE_ORDER)
    numbered = number_within(lines, "l_orderkey", LINE_ORDER, "line_number")
    return _order_lines(
        spark, folder, numbered.withColumn("line_number", F.col("line_number").cast("int"))
    ).select(*RAW_COLUMNS)


def dirty_raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines as text with faults of every kind, chosen by source values.

    The source's own line numbers stay, which repeat within an order.
    """
    lines = _table(spark, folder, "lineitem").select("l_orderkey", *LINE_ORDER)
    texts = (
        _order_lines(spark, folder, lines)
        .withColumn("line_number", F.col("l_linenumber"))
        .select(
            *[F.col(name).cast("string").alias(name) for name in RAW_COLUMNS],
            *["l_quantity", "l_discount", F.col("revenue").alias("_revenue")],
        )
    )
    return texts.select(
        *[
            _faulty(name).alias(name) if name in FAULTS else F.col(name)
            for name in RAW_COLUMNS
        ]
    )


# column -> (source quantity, source discount, faulty text); None stands for a missing value,
# "plus one" for a higher amount, "{}" for the value itself.
FAULTS: dict[str, list[tuple[int, float, str | None]]] = {
    "line_number": [(38, 0.0, "0{}"), (38, 0.01, "{}.0")],
    "order_date": [(50, 0.0, "not a date"), (50, 0.01, "1997-13-01")],
    "quantity": [(48, 0.0, "2.5"), (48, 0.01, "many"), (47, 0.0, "0"), (47, 0.01, "-3")],
    "unit_price": [(46, 0.0, "0.00"), (46, 0.01, "dear")],
    "revenue": [(45, 0.0, "-1.00"), (43, 0.0, "plus one")],
    "discount": [(44, 0.0, "1.5"), (44, 0.01, "-0.1"), (44, 0.02, "1500")],
    "unit_cost": [(39, 0.0, None), (39, 0.01, "-2.00")],
    "customer_region": [(49, 0.0, None), (42, 0.0, "ATLANTIS")],
    "product_category": [(41, 0.0, "MISFILED")],
    "sales_channel": [(40, 0.0, "FAX")],
}


def _faulty(name: str) -> Column:
    value = F.col(name)
    for quantity, discount, text in FAULTS[name]:
        hit = (F.col("l_quantity") == quantity) & (F.col("l_discount") == discount)
        if text == "plus one":
            fault = (F.col("_revenue") + 1).cast("string")
        elif text and "{}" in text:
            before, after = text.split("{}")
            fault = F.concat(F.lit(before), name, F.lit(after))
        else:
            fault = F.lit(text)
        value = F.when(hit, fault).otherwise(value)
    return value


# table -> column -> (rows, value): what the broken warehouse holds instead, in SQL on the clean rows.
# Decimals are wider than declared, so that values beyond their type can be stored.
DAMAGE: dict[str, dict[str, list[tuple[str, str]]]] = {
    "dim_date": {
        "full_date": [("day = 28", "date_add(full_date, 1)")],
        "day": [("day = 30", "32")],
        "month": [("month = 11", "13")],
        "month_name": [("day = 31", "'a long month'")],
        "quarter": [("day = 29", "5")],
        "year": [("month = 12", "1980")],
        "day_of_week": [("day = 27", "'a long weekday'")],
    },
    "dim_customer": {
        "customer_key": [("customer_key % 11 = 0", "-customer_key")],
        "customer_id": [
            ("region = 'ASIA'", "lower(customer_id)"),
            ("customer_key % 7 = 0", "concat(customer_id, repeat('0', 20))"),
        ],
        "region": [("customer_key % 13 = 0", "repeat(region, 20)")],
    },
    "dim_category": {
        "category_key": [("category_name = 'LARGE'", "-category_key")],
        "category_name": [("category_name = 'SMALL'", "repeat(category_name, 30)")],
    },
    "dim_product": {
        "product_key": [("product_key % 50 = 7", "-product_key")],
        "product_id": [
            ("product_key % 50 = 8", "concat('X', product_id)"),
            ("product_key % 50 = 9", "concat(product_id, repeat('0', 20))"),
        ],
        "product_name": [
            ("product_name = 'blue widget'", "NULL"),
            ("product_key % 50 = 10", "repeat(product_name, 40)"),
        ],
    },
    "dim_channel": {
        "channel_key": [("channel_name = '2-HIGH'", "-channel_key")],
        "channel_name": [("channel_name = '3-MEDIUM'", "repeat(channel_name, 10)")],
    },
    "fact_sales": {
        "sales_key": [("quantity = 45", "-sales_key")],
        "transaction_id": [
            ("quantity = 44", "lower(transaction_id)"),
            ("quantity = 43", "concat(transaction_id, repeat('0', 20))"),
        ],
        "line_number": [("quantity = 42", "40000"), ("quantity = 41", "-line_number")],
        "channel_key": [("quantity = 49", "NULL")],
        "quantity": [("quantity = 40", "0")],
        "unit_price": [("quantity = 39", "0"), ("quantity = 35", "unit_price + 100000000000")],
        "discount": [("quantity = 38", "1.5"), ("quantity = 30", "15")],
        "revenue": [
            ("quantity = 50", "revenue + 1"),
            ("quantity = 37", "-1"),
            ("quantity = 34", "revenue + 10000000000000"),
        ],
        "unit_cost": [("quantity = 46", "-1"), ("quantity = 31", "unit_cost + 100000000000")],
        "total_cost": [("quantity = 36", "-1"), ("quantity = 32", "total_cost + 10000000000000")],
        "profit": [("quantity = 33", "profit + 10000000000000")],
    },
}


def _damaged(table: str, clean: DataFrame) -> DataFrame:
    """The table with the values of DAMAGE."""
    columns = []
    for field in clean.schema.fields:
        name, kind = field.name, field.dataType
        if isinstance(kind, T.DecimalType) and name in DAMAGE[table]:
            kind = T.DecimalType(20, kind.scale)
        text = kind.simpleString()
        cases = "".join(
            f" WHEN {rows} THEN CAST({value} AS {text})"
            for rows, value in DAMAGE[table].get(name, [])
        )
        value = f"CASE{cases} ELSE CAST({name} AS {text}) END" if cases else name
        columns.append(F.expr(value).alias(name))
    return clean.select(*columns)


def dirty_warehouse(clean: Warehouse) -> Warehouse:
    """Missing, repeated and damaged rows in every table of a clean warehouse."""

    def twice(table: DataFrame, rows: Column) -> DataFrame:
        return table.unionByName(table.where(rows))

    rows = {
        "dim_date": clean.dim_date.where(~((F.col("month") == 2) & (F.col("day") == 15))),
        "dim_customer": twice(
            clean.dim_customer.where(F.col("region") != "AFRICA"), F.col("region") == "EUROPE"
        ),
        "dim_category": twice(
            clean.dim_category.where(F.col("category_name") != "ECONOMY"), F.col("category_name") == "PROMO"
        ),
        "dim_product": twice(
            clean.dim_product.where(F.col("product_name") != "red widget"), F.col("product_name") == "small ring"
        ),
        "dim_channel": twice(
            clean.dim_channel.where(F.col("channel_name") != "5-LOW"), F.col("channel_name") == "1-URGENT"
        ),
        "fact_sales": twice(clean.fact_sales, F.col("quantity") == 47),
    }
    return Warehouse(**{name: _damaged(name, table) for name, table in rows.items()})
