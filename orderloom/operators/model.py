"""Raw order lines to a star schema with deterministic surrogate keys."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import dates, money, parsing
from orderloom.operators import packed
from orderloom.operators.numbering import dense_key, ordered_index
from orderloom.schema import (
    AMOUNT,
    FACT_COLUMNS,
    PRIMARY_KEYS,
    RAW_COLUMNS,
    TABLES,
    WarehouseError,
)


@dataclass(frozen=True)
class Warehouse:
    """Five dimensions and one fact."""

    dim_date: DataFrame
    dim_customer: DataFrame
    dim_category: DataFrame
    dim_product: DataFrame
    dim_channel: DataFrame
    fact_sales: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.fact_sales.sparkSession

    def tables(self) -> dict[str, DataFrame]:
        """All tables by name, dimensions before the fact."""
        return {field.name: getattr(self, field.name) for field in fields(self)}

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: table for name, table in self.tables().items() if name != "fact_sales"}


def typed_lines(raw: DataFrame) -> DataFrame:
    """Contract columns with their types; values that do not parse become null."""
    return raw.select(*parsing.typed_columns(raw, RAW_COLUMNS))


def line_measures(lines: DataFrame) -> DataFrame:
    """Revenue, total cost and profit of each line from price, cost, quantity and discount."""
    price, cost = F.col("unit_price"), F.col("unit_cost")
    quantity = F.col("quantity")
    return (
        lines.withColumn(
            "revenue",
            money.line_revenue(price, quantity, F.col("discount")).try_cast(AMOUNT),
        )
        .withColumn("total_cost", money.line_cost(cost, quantity).try_cast(AMOUNT))
        .withColumn("profit", (F.col("revenue") - F.col("total_cost")).try_cast(AMOUNT))
    )


def build_dim_date(days: DataFrame, column: str = "order_date") -> DataFrame:
    """Gap-free calendar from the first to the last day."""
    bounds = days.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    calendar = bounds.where(F.col("first").isNotNull()).select(
        F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("full_date")
    )
    day = F.col("full_date")
    return calendar.select(
        dates.date_key(day).alias("date_key"),
        "full_date",
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        dates.month_name(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        dates.day_name(day).alias("day_of_week"),
        dates.is_weekend(day).alias("is_weekend"),
    )


def build_dim_customer(lines: DataFrame) -> DataFrame:
    customers = lines.select("customer_id", F.col("customer_region").alias("region"))
    return dense_key(customers.distinct(), ["customer_id", "region"], "customer_key")


def build_dim_category(lines: DataFrame) -> DataFrame:
    names = lines.select(F.col("product_category").alias("category_name")).distinct()
    return dense_key(names, ["category_name"], "category_key")


def build_dim_channel(lines: DataFrame) -> DataFrame:
    names = lines.select(F.col("sales_channel").alias("channel_name")).distinct()
    return dense_key(names, ["channel_name"], "channel_key")


def build_dim_product(lines: DataFrame, dim_category: DataFrame) -> DataFrame:
    products = lines.select(
        "product_id", "product_name", F.col("product_category").alias("category_name")
    ).distinct()
    keyed = products.join(dim_category, "category_name", "left").drop("category_name")
    return dense_key(keyed, ["product_id", "product_name", "category_key"], "product_key")


def build_fact(
    lines: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_channel: DataFrame
) -> DataFrame:
    """Fact at line grain; an attribute without a dimension row leaves a null key.

    Names become integer keys first, then the lines are put in order and numbered, so the rows that
    are sorted and staged are narrow, and the fact is written in that order. Until then amounts travel
    as their difference from their formula, nearly always zero, and lines are packed into words.
    The joins carry no hints: Spark broadcasts a dimension that is below its size threshold and
    otherwise sorts and merges, where adaptive execution splits a hot customer or product.
    """
    narrow = lines.select(
        "transaction_id",
        "line_number",
        dates.date_key(F.col("order_date")).alias("date_key"),
        "customer_id",
        "product_id",
        "sales_channel",
        "quantity",
        *[_stored(name).alias(name) for name in FACT_COLUMNS[FACT_COLUMNS.index("unit_price") :]],
    )
    channels = dim_channel.withColumnRenamed("channel_name", "sales_channel")
    lines = packed.pack(_as_differences(narrow).join(channels, "sales_channel", "left").drop("sales_channel"))
    lines = packed.with_key(lines, dim_product, "product_id", "product_key")
    lines = packed.with_key(lines, dim_customer, "customer_id", "customer_key")
    # Orders sort as texts.
    lines = lines.withColumn("transaction_id", packed.unpacked(lines, "transaction_id")).drop(
        packed.number_of("transaction_id")
    )
    order = [packed.unpacked(lines, "date_key"), F.col("transaction_id"), packed.unpacked(lines, "line_number")]
    numbered = ordered_index(lines, order, "sales_key", finish=packed.unpack, compression="zstd")
    return _as_amounts(numbered).select(*FACT_COLUMNS)


def _formulas() -> dict[str, Column]:
    """What each amount of a stored line should be; zero where that is unknown or does not fit."""
    quantity = F.col("quantity")
    expected = {
        "revenue": money.line_revenue(F.col("unit_price"), quantity, F.col("discount")),
        "total_cost": money.line_cost(F.col("unit_cost"), quantity),
        "profit": F.col("revenue") - F.col("total_cost"),
    }
    return {name: F.coalesce(value.try_cast(AMOUNT), F.lit(0).cast(AMOUNT)) for name, value in expected.items()}


def _as_differences(lines: DataFrame) -> DataFrame:
    """Amounts less their formulas; exact, and null stays null."""
    formulas = _formulas()
    return lines.withColumns({name: F.col(name) - value for name, value in formulas.items()})


def _as_amounts(lines: DataFrame) -> DataFrame:
    """The amounts from their differences; profit last, as its formula has the other two."""
    for name, value in _formulas().items():
        lines = lines.withColumn(name, (F.col(name) + value).cast(AMOUNT))
    return lines


def _stored(name: str) -> Column:
    """Half-even rounding to the stored scale."""
    if name == "discount":
        return money.as_rate(F.col(name))
    if name in ("unit_price", "unit_cost"):
        return money.as_price(F.col(name))
    return money.as_amount(F.col(name))


def build_warehouse(raw: DataFrame) -> Warehouse:
    """Star schema of validated raw lines; keys do not depend on the order of the rows."""
    lines = typed_lines(raw)
    dim_customer = build_dim_customer(lines)
    dim_category = build_dim_category(lines)
    dim_product = build_dim_product(lines, dim_category)
    dim_channel = build_dim_channel(lines)
    return Warehouse(
        dim_date=build_dim_date(lines),
        dim_customer=dim_customer,
        dim_category=dim_category,
        dim_product=dim_product,
        dim_channel=dim_channel,
        fact_sales=build_fact(lines, dim_customer, dim_product, dim_channel),
    )


def empty_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(**{name: spark.createDataFrame([], kind) for name, kind in TABLES.items()})


def _require_unique_keys(warehouse: Warehouse) -> None:
    repeated = reduce(
        DataFrame.unionByName,
        [
            table.groupBy(PRIMARY_KEYS[name]).count().where("count > 1").limit(1).select(F.lit(name).alias("name"))
            for name, table in warehouse.dimensions().items()
        ],
    ).collect()
    if repeated:
        raise WarehouseError("repeated keys in " + ", ".join(sorted(row.name for row in repeated)))


def enrich_sales(warehouse: Warehouse) -> DataFrame:
    """Fact lines with their descriptive attributes, grain unchanged.

    A dimension key that repeats would multiply lines and raises an error.
    """
    _require_unique_keys(warehouse)
    return (
        warehouse.fact_sales.join(
            warehouse.dim_date.select("date_key", "full_date", "year"), "date_key"
        )
        .join(warehouse.dim_customer, "customer_key")
        .join(warehouse.dim_product, "product_key")
        .join(warehouse.dim_category, "category_key")
        .join(warehouse.dim_channel, "channel_key")
    )
