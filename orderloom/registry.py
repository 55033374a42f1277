"""Named queries over a folder of source tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators import constraints, filters, integrity, keys, model, validate
from orderloom.operators.segments import segment_amounts
from orderloom.plans import insights, kpis, reconcile, reports, sqlkpis
from orderloom.plans.load_job import load_raw
from orderloom.schema import FACT_COLUMNS, WarehouseError
from orderloom.sources import raw_csv, testdata, warehouse_store
from orderloom.sources.staging import new_path, stage, when_released


class Lake:
    """Order lines and warehouse of one source folder, each built once per application."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    @cached_property
    def raw(self) -> DataFrame:
        return stage(testdata.raw_sales(self.spark, self.folder), "raw", "zstd")

    @cached_property
    def dirty_raw(self) -> DataFrame:
        return stage(testdata.dirty_raw_sales(self.spark, self.folder), "dirty-raw", "zstd")

    @cached_property
    def root(self) -> str:
        root = new_path(self.spark, "warehouse")
        load_raw(self.raw, root, limits=testdata.LIMITS)
        return root

    @cached_property
    def warehouse(self) -> model.Warehouse:
        return warehouse_store.read_warehouse(self.spark, self.root)

    @cached_property
    def dirty(self) -> model.Warehouse:
        broken = testdata.dirty_warehouse(warehouse_store.without_partition_column(self.warehouse))
        return model.Warehouse(
            **{
                name: stage(table, f"dirty-{name}", "zstd" if name == "fact_sales" else None)
                for name, table in broken.tables().items()
            }
        )

    @cached_property
    def results(self) -> kpis.KPIResults:
        return kpis.calculate_kpis(self.warehouse)


_lakes: dict[tuple[str, str], Lake] = {}
when_released(_lakes.clear)


def lake(spark: SparkSession, folder: str) -> Lake:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _lakes:
        _lakes[key] = Lake(spark, folder)
    return _lakes[key]


def portable(frame: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, which compare alike in any engine."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def _csv_contract(lake: Lake) -> DataFrame:
    path = raw_csv.write_raw_sales(lake.raw, new_path(lake.spark, "csv"))
    return raw_csv.read_raw_sales(lake.spark, path)


def _wh_init(lake: Lake) -> DataFrame:
    """Rows per table before and after the tables are created anew."""
    root = new_path(lake.spark, "init")
    before = warehouse_store.publish(lake.warehouse, root, limits=testdata.LIMITS)
    after = warehouse_store.initialise(lake.spark, root)
    return (
        warehouse_store.row_counts(before)
        .withColumnRenamed("row_count", "rows_before")
        .join(
            warehouse_store.row_counts(after).withColumnRenamed("row_count", "rows_after"),
            "table_name",
        )
    )


def _wh_roundtrip(lake: Lake) -> DataFrame:
    """Stored lines by year, with keys and totals as read back."""
    return lake.warehouse.fact_sales.groupBy("sale_year").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("sales_key").alias("first_key"),
        F.max("sales_key").alias("last_key"),
        F.sum("revenue").alias("revenue"),
        F.sum("total_cost").alias("total_cost"),
    )


def _wh_publish(lake: Lake) -> DataFrame:
    """Current fact rows after a load, a rejected load and a rejected repeated append."""
    spark, root = lake.spark, new_path(lake.spark, "publish")
    clean = warehouse_store.without_partition_column(lake.warehouse)

    def attempt(warehouse: model.Warehouse, rebuild: bool) -> bool:
        try:
            warehouse_store.publish(warehouse, root, rebuild=rebuild, limits=testdata.LIMITS)
        except WarehouseError:
            return False
        return True

    loads = {
        "load": (clean, True),
        "load_broken": (lake.dirty, True),
        "append_repeated": (clean, False),
    }
    result = None
    for position, (step, (warehouse, rebuild)) in enumerate(loads.items(), 1):
        accepted = attempt(warehouse, rebuild)
        current = warehouse_store.read_warehouse(spark, root).fact_sales.agg(
            F.lit(position).alias("position"),
            F.lit(step).alias("step"),
            F.lit(accepted).alias("accepted"),
            F.count(F.lit(1)).alias("fact_rows"),
        )
        result = current if result is None else result.unionByName(current)
    return result


def _filtered(lake: Lake, **chosen) -> DataFrame:
    return filters.filter_warehouse(lake.warehouse, **chosen).fact_sales.select(
        "sales_key", "transaction_id", "line_number", "quantity", "revenue", "profit"
    )


def _insights(lake: Lake, *, texts: bool = False, **chosen) -> DataFrame:
    results = kpis.calculate_kpis(filters.filter_warehouse(lake.warehouse, **chosen))
    found = insights.generate_insights(results)
    return found if texts else found.drop("evidence")


# The filter context of the reports below.
CONTEXT = {
    "years": [1996, 1997, 1998],
    "regions": ["ASIA", "EUROPE"],
    "categories": ["PROMO", "SMALL", "ECONOMY"],
    "channels": ["1-URGENT", "2-HIGH"],
}


Query = Callable[[Lake], DataFrame]

SOURCES: dict[str, Query] = {
    "src_csv_contract": _csv_contract,
    "derive_line_measures": lambda lake: model.line_measures(
        lake.raw.select(
            "transaction_id", "line_number", "unit_price", "quantity", "discount", "unit_cost"
        )
    ).select("transaction_id", "line_number", "revenue", "total_cost", "profit"),
    "wh_init": _wh_init,
    "wh_roundtrip": _wh_roundtrip,
    "wh_publish": _wh_publish,
    "wh_row_counts": lambda lake: warehouse_store.row_counts(lake.warehouse),
}

VALIDATION: dict[str, Query] = {
    "val_row_checks": lambda lake: validate.row_checks(lake.dirty_raw),
    "val_null_columns": lambda lake: validate.null_columns(lake.dirty_raw),
    "val_duplicate_lines": lambda lake: validate.duplicate_lines(lake.dirty_raw),
    "val_financial": lambda lake: validate.financial_mismatches(lake.dirty_raw),
    "val_fd_customer": lambda lake: validate.unstable_keys(lake.dirty_raw, "customer_id"),
    "val_fd_product": lambda lake: validate.unstable_keys(lake.dirty_raw, "product_id"),
    "val_fd_transaction": lambda lake: validate.unstable_keys(lake.dirty_raw, "transaction_id"),
    "val_source_clean": lambda lake: validate.validate_source(lake.raw),
    "val_source_dirty": lambda lake: validate.validate_source(lake.dirty_raw),
    "val_model_nulls": lambda lake: validate.model_nulls(lake.dirty),
    "val_model_fks": lambda lake: validate.model_foreign_keys(lake.dirty),
}

MODEL: dict[str, Query] = {
    "dim_date": lambda lake: lake.warehouse.dim_date,
    "dim_customer": lambda lake: lake.warehouse.dim_customer,
    "dim_category": lambda lake: lake.warehouse.dim_category,
    "dim_product": lambda lake: lake.warehouse.dim_product,
    "dim_channel": lambda lake: lake.warehouse.dim_channel,
    "fact_sales": lambda lake: lake.warehouse.fact_sales.select(*FACT_COLUMNS),
    "enrich_sales": lambda lake: model.enrich_sales(lake.warehouse).select(
        "transaction_id",
        "line_number",
        "full_date",
        "year",
        "customer_id",
        "region",
        "product_id",
        "product_name",
        "category_name",
        "channel_name",
        "quantity",
        "revenue",
        "profit",
    ),
}

CHECKS: dict[str, Query] = {
    "integrity_clean": lambda lake: integrity.integrity_report(lake.warehouse),
    "integrity_dirty": lambda lake: integrity.integrity_report(lake.dirty),
    "orphan_lines": lambda lake: integrity.orphan_lines(lake.dirty),
    "duplicate_lines": lambda lake: keys.repeated_keys(
        lake.dirty.fact_sales, ["transaction_id", "line_number"]
    ),
    "fact_row_count": lambda lake: integrity.fact_row_count(lake.warehouse),
    "constraint_report": lambda lake: constraints.constraint_report(
        lake.warehouse, testdata.LIMITS
    ),
    "constraint_report_dirty": lambda lake: constraints.constraint_report(
        lake.dirty, testdata.LIMITS
    ),
    "unfit_values": lambda lake: constraints.unfit_rows("fact_sales", lake.dirty.fact_sales)
    .select(F.explode("reasons").alias("reason"))
    .groupBy("reason")
    .agg(F.count(F.lit(1)).alias("row_count")),
}

FILTERS: dict[str, Query] = {
    "filter_all_dims": lambda lake: _filtered(lake, **CONTEXT),
    "filter_year": lambda lake: _filtered(lake, years=[1996, 1997]),
    "filter_region": lambda lake: _filtered(lake, regions=["ASIA"]),
    "filter_category": lambda lake: _filtered(lake, categories=["PROMO", "SMALL"]),
    "filter_channel": lambda lake: _filtered(lake, channels=["5-LOW"]),
    "filter_options": lambda lake: filters.filter_options(lake.warehouse),
    "filtered_overview": lambda lake: reports.filtered_overview(lake.warehouse, **CONTEXT),
    "filtered_products": lambda lake: kpis.product_performance(
        filters.filter_warehouse(lake.warehouse, **CONTEXT)
    ),
    "filtered_channels": lambda lake: kpis.channel_performance(
        filters.filter_warehouse(lake.warehouse, **CONTEXT)
    ),
}

KPIS: dict[str, Query] = {
    "executive_overview": lambda lake: kpis.executive_overview(lake.warehouse),
    "customer_orders": lambda lake: kpis.customer_orders(lake.warehouse),
    "having_repeat_customers": lambda lake: kpis.repeat_customers(lake.warehouse),
    "repeat_customer_rate": lambda lake: kpis.repeat_customer_rate(lake.warehouse),
    "revenue_by_year": lambda lake: kpis.revenue_by_year(lake.warehouse),
    "annual_performance": lambda lake: kpis.annual_performance(lake.warehouse),
    "monthly_trend": lambda lake: kpis.monthly_trend(lake.warehouse),
    "category_annual": lambda lake: kpis.category_annual(lake.warehouse),
    "category_performance": lambda lake: kpis.category_performance(lake.warehouse),
    "region_annual": lambda lake: kpis.region_annual(lake.warehouse),
    "region_performance": lambda lake: kpis.region_performance(lake.warehouse),
    "channel_performance": lambda lake: kpis.channel_performance(lake.warehouse),
    "product_performance": lambda lake: kpis.product_performance(lake.warehouse, dense=False),
    "product_dense_ranks": lambda lake: kpis.product_performance(lake.warehouse),
    "median_product_revenue": lambda lake: kpis.median_product_revenue(lake.warehouse),
    "portfolio_margin": lambda lake: kpis.portfolio_margin(lake.warehouse),
    "weak_margin_products": lambda lake: kpis.weak_margin_products(lake.warehouse),
    "customer_value": lambda lake: kpis.customer_value(lake.warehouse),
    "top_customer_concentration": lambda lake: kpis.top_customer_concentration(lake.warehouse),
    "top_n_concentration": lambda lake: kpis.top_customer_concentration(lake.warehouse, 25),
    "repeat_vs_onetime": lambda lake: kpis.repeat_vs_onetime(lake.warehouse),
    "segment_totals_reconcile": lambda lake: kpis.segment_reconciliation(lake.warehouse),
    "insights": lambda lake: insights.generate_insights(lake.results).drop("evidence"),
    # Filter contexts in which the other rules have something to find; one with the sentences.
    "insights_margin": lambda lake: _insights(
        lake, texts=True, years=[1997, 1999], regions=["AFRICA"], categories=["ECONOMY"]
    ),
    "insights_two_years": lambda lake: _insights(
        lake, years=[1997, 2000], regions=["AMERICA"], categories=["ECONOMY", "LARGE"]
    ),
    "insights_narrow": lambda lake: _insights(
        lake, years=[2001], regions=["MIDDLE EAST"], categories=["PROMO"]
    ),
}

SQL: dict[str, Query] = {
    "sql_executive_summary": lambda lake: sqlkpis.executive_summary(lake.warehouse),
    "sql_annual": lambda lake: sqlkpis.annual(lake.warehouse),
    "sql_monthly": lambda lake: sqlkpis.monthly(lake.warehouse),
    "sql_category_annual": lambda lake: sqlkpis.category_annual(lake.warehouse),
    "sql_products": lambda lake: sqlkpis.products(lake.warehouse),
    "sql_weak_margins": lambda lake: sqlkpis.weak_margins(lake.warehouse),
    "sql_region_annual": lambda lake: sqlkpis.region_annual(lake.warehouse),
    "sql_channels": lambda lake: sqlkpis.channels(lake.warehouse),
    "sql_customers": lambda lake: sqlkpis.customers(lake.warehouse),
    "sql_concentration": lambda lake: sqlkpis.concentration(lake.warehouse),
}


def _regions(lake: Lake) -> DataFrame:
    return segment_amounts(lake.warehouse, ["region"])


def _channels(lake: Lake) -> DataFrame:
    return segment_amounts(lake.warehouse, ["channel_name"])


REPORTS: dict[str, Query] = {
    "headline_cards": lambda lake: reports.headline_cards(
        kpis.executive_overview(lake.warehouse), kpis.top_customer_concentration(lake.warehouse)
    ),
    "monthly_long": lambda lake: reports.monthly_long(lake.warehouse),
    "annual_long": lambda lake: reports.annual_long(lake.warehouse),
    "category_long": lambda lake: reports.category_long(lake.warehouse),
    "region_long": lambda lake: reports.region_long(lake.warehouse),
    "channel_long": lambda lake: reports.channel_long(lake.warehouse),
    "product_margin_scatter": lambda lake: reports.product_margin_scatter(lake.warehouse),
    "top_products_revenue": lambda lake: reports.top_products(lake.warehouse, "revenue"),
    "top_products_profit": lambda lake: reports.top_products(lake.warehouse, "profit"),
    "category_revenue_series": lambda lake: reports.category_revenue_series(lake.warehouse),
    "product_table": lambda lake: reports.product_table(lake.warehouse),
    "regions_by_revenue": lambda lake: reports.bars(_regions(lake), "region", "revenue"),
    "regions_by_growth": lambda lake: reports.bars(
        kpis.region_growth(lake.warehouse), "region", "revenue_yoy_growth"
    ),
    "regions_by_margin": lambda lake: reports.bars(_regions(lake), "region", "gross_margin"),
    "channels_by_revenue": lambda lake: reports.bars(_channels(lake), "channel_name", "revenue"),
    "channels_by_margin": lambda lake: reports.bars(
        _channels(lake), "channel_name", "gross_margin"
    ),
    "channels_by_order_value": lambda lake: reports.bars(
        kpis.channel_performance(lake.warehouse), "channel_name", "average_order_value"
    ),
    "top_customers_15": lambda lake: reports.top_customers(lake.warehouse),
    "customer_revenue_histogram": lambda lake: reports.customer_revenue_histogram(lake.warehouse),
}

RECONCILIATION: dict[str, Query] = {
    "reconcile_kpis": lambda lake: reconcile.reconcile_kpis(lake.warehouse),
    "reconcile_raw_vs_fact": lambda lake: reconcile.reconcile_raw_vs_fact(
        lake.raw, lake.warehouse
    ),
}

ALL: dict[str, Query] = {
    **SOURCES,
    **VALIDATION,
    **MODEL,
    **CHECKS,
    **FILTERS,
    **KPIS,
    **SQL,
    **REPORTS,
    **RECONCILIATION,
}


def _bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: portable(query(lake(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(query) for name, query in ALL.items()}
