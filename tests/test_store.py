import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from order_lines import PRODUCTS, frame, good_lines, line, raw_frame
from orderloom.operators.model import build_warehouse
from orderloom.plans.load_job import load_csv, load_raw
from orderloom.schema import FACT_COLUMNS, TABLES, RawDataError, WarehouseError
from orderloom.sources import warehouse_store as store
from orderloom.sources.raw_csv import write_raw_sales


def rows(table):
    return sorted(map(tuple, table.collect()))


def test_round_trip_keeps_rows_and_types(warehouse, tmp_path):
    root = str(tmp_path / "wh")
    store.publish(warehouse, root)
    back = store.read_warehouse(warehouse.spark, root)
    for name, table in warehouse.tables().items():
        stored = back.tables()[name].select(*TABLES[name].fieldNames())
        assert rows(stored) == rows(table), name
        assert [f.dataType for f in stored.schema] == [f.dataType for f in TABLES[name]], name
    assert store.contract_fact(back).columns == FACT_COLUMNS
    parts = os.listdir(store.current_version(warehouse.spark, root)["fact_sales"][0])
    assert {"sale_year=2023", "sale_year=2024"} <= set(parts)


def test_broken_load_leaves_the_current_version(warehouse, tmp_path):
    from dataclasses import replace

    root = str(tmp_path / "wh")
    store.publish(warehouse, root)
    before = store.current_version(warehouse.spark, root)
    wrong = warehouse.fact_sales.withColumn(
        "revenue", (F.col("revenue") + 1).cast("decimal(14,2)")
    )
    loads = sorted((tmp_path / "wh").glob("load-*"))
    assert len(loads) == 1
    with pytest.raises(WarehouseError, match="fact_sales.revenue_calculation"):
        store.publish(replace(warehouse, fact_sales=wrong), root)
    assert sorted((tmp_path / "wh").glob("load-*")) == loads
    assert store.current_version(warehouse.spark, root) == before
    assert store.read_warehouse(warehouse.spark, root).fact_sales.count() == 6


def test_append_rejects_known_keys_and_adds_new_rows(spark, warehouse, tmp_path):
    from dataclasses import replace

    root = str(tmp_path / "wh")
    store.publish(warehouse, root)
    with pytest.raises(WarehouseError, match="exist already"):
        store.publish(warehouse, root, rebuild=False)
    later = line("TXN0000009", 1, "2024-02-04", "CUST00003", "West", "Partner", "PROD001", 1)
    later["product_id"], later["product_category"] = "PROD009", "Garden"
    extra = build_warehouse(frame(spark, [later]))
    shifted = {
        "dim_customer": extra.dim_customer.withColumn("customer_key", F.col("customer_key") + 2),
        "dim_category": extra.dim_category.withColumn("category_key", F.col("category_key") + 2),
        "dim_product": extra.dim_product.withColumns(
            {"product_key": F.col("product_key") + 3, "category_key": F.col("category_key") + 2}
        ),
        "dim_channel": extra.dim_channel.withColumn("channel_key", F.col("channel_key") + 2),
        "fact_sales": extra.fact_sales.withColumns(
            {
                "sales_key": F.col("sales_key") + 6,
                "customer_key": F.col("customer_key") + 2,
                "product_key": F.col("product_key") + 3,
                "channel_key": F.col("channel_key") + 2,
            }
        ),
    }
    store.publish(replace(extra, **shifted), root, rebuild=False)
    counts = {r.table_name: r.row_count for r in
              store.row_counts(store.read_warehouse(spark, root)).collect()}
    assert counts["fact_sales"] == 7
    assert counts["dim_customer"] == 3


def test_initialise_creates_empty_tables_and_append_fills_them(warehouse, tmp_path):
    root = str(tmp_path / "wh")
    empty = store.initialise(warehouse.spark, root)
    assert {r.row_count for r in store.row_counts(empty).collect()} == {0}
    store.publish(warehouse, root, rebuild=False)
    assert store.read_warehouse(warehouse.spark, root).fact_sales.count() == 6


def test_no_warehouse_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.read_warehouse(spark, str(tmp_path / "none"))


def test_load_job_from_csv(spark, tmp_path):
    path = write_raw_sales(raw_frame(spark), str(tmp_path / "csv"))
    root = str(tmp_path / "wh")
    counts = {r.table_name: r.row_count for r in load_csv(spark, path, root).collect()}
    assert counts == {
        "dim_date": 395, "dim_customer": 2, "dim_category": 2, "dim_product": len(PRODUCTS),
        "dim_channel": 2, "fact_sales": 6,
    }


def test_load_job_stops_before_writing(spark, tmp_path):
    lines = good_lines()
    lines[0]["revenue"] = "1.00"
    root = tmp_path / "wh"
    with pytest.raises(RawDataError):
        load_raw(frame(spark, lines), str(root))
    assert not root.exists()


def test_queries_work_after_release():
    """Releasing staged files also forgets the frames that read them; runs in a session of its own."""
    import subprocess
    import sys

    from conftest import ROOT, SMALL

    code = f"""
from pyspark.sql import SparkSession
from orderloom import registry
from orderloom.sources.staging import release
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").getOrCreate())
query = registry.queries()["val_null_columns"]
first = sorted(map(tuple, query(spark, {SMALL!r}).collect()))
release(spark)
assert sorted(map(tuple, query(spark, {SMALL!r}).collect())) == first
release(spark)
print("fine")
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_values_that_do_not_fit_reject_the_load(spark, warehouse, tmp_path):
    root = str(tmp_path / "wide")
    store.publish(warehouse, root)
    wide = F.when(F.col("sales_key") == 2, F.lit("1000000000000").cast("decimal(20,2)")).otherwise(F.col("profit"))
    broken = dataclasses.replace(warehouse, fact_sales=warehouse.fact_sales.withColumn("profit", wide))
    with pytest.raises(WarehouseError, match="fact_sales.profit_precision"):
        store.publish(broken, root)
    assert store.read_warehouse(spark, root).fact_sales.count() == 6
    assert len(list((tmp_path / "wide").glob("load-*"))) == 1
