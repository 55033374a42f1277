"""Filter context: the fact by dimension attributes, grain and dimensions unchanged."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import dates
from orderloom.operators.model import Warehouse
from orderloom.schema import PARTITION_COLUMN


def _matching(table: DataFrame, column: str, values: Sequence, key: str) -> DataFrame:
    """Keys of the dimension rows that match; an empty list matches nothing."""
    condition = F.col(column).isin(list(values)) if values else F.lit(False)
    return table.where(condition).select(key).distinct()


def filter_warehouse(
    warehouse: Warehouse,
    *,
    years: Sequence[int] | None = None,
    regions: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
) -> Warehouse:
    """Lines that match every given list; None leaves a dimension unfiltered.

    Semi joins on key sets let Spark broadcast a small set or shuffle a large one. Years are known
    from the key as well, so the stored fact is pruned to its partitions before any join.
    """
    fact = warehouse.fact_sales
    if years is not None:
        partitioned = PARTITION_COLUMN in fact.columns
        year = F.col(PARTITION_COLUMN) if partitioned else dates.key_year(F.col("date_key"))
        fact = fact.where(year.isin(list(years)) if years else F.lit(False))
        fact = fact.join(
            _matching(warehouse.dim_date, "year", years, "date_key"), "date_key", "left_semi"
        )
    if channels is not None:
        keys = _matching(warehouse.dim_channel, "channel_name", channels, "channel_key")
        fact = fact.join(keys, "channel_key", "left_semi")
    if categories is not None:
        chosen = _matching(warehouse.dim_category, "category_name", categories, "category_key")
        products = warehouse.dim_product.join(chosen, "category_key", "left_semi")
        fact = fact.join(products.select("product_key").distinct(), "product_key", "left_semi")
    if regions is not None:
        keys = _matching(warehouse.dim_customer, "region", regions, "customer_key")
        fact = fact.join(keys, "customer_key", "left_semi")
    return replace(warehouse, fact_sales=fact)


def filter_options(warehouse: Warehouse) -> DataFrame:
    """Sorted choices of each facet as (facet, position, value), from the dimensions.

    A facet is what a reader can choose from, so one task numbers its few values.
    """
    facets = {
        "years": (warehouse.dim_date, F.col("year")),
        "regions": (warehouse.dim_customer, F.col("region")),
        "categories": (warehouse.dim_category, F.col("category_name")),
        "channels": (warehouse.dim_channel, F.col("channel_name")),
    }
    choices = reduce(
        DataFrame.unionByName,
        [
            table.select(
                F.lit(facet).alias("facet"),
                (column if facet == "years" else F.lit(None).cast("int")).alias("number"),
                column.cast("string").alias("value"),
            ).distinct()
            for facet, (table, column) in facets.items()
        ],
    )
    order = Window.partitionBy("facet").orderBy("number", "value")
    return choices.select(
        "facet", F.row_number().over(order).cast("bigint").alias("position"), "value"
    )
