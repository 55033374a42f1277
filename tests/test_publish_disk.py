"""What publishing leaves on disk."""

from pyspark.sql import functions as F
from test_disk import left_after

from orderloom.sources import staging, warehouse_store


def test_publishing_leaves_no_shuffle_files(spark, warehouse):
    root = staging.new_path(spark, "publish")
    assert not left_after(spark, lambda: warehouse_store.publish(warehouse, root))


def test_the_fact_is_stored_in_the_smaller_form(spark, warehouse):
    root = staging.new_path(spark, "publish")
    published = warehouse_store.publish(warehouse, root)
    files = published.fact_sales.select(F.input_file_name()).distinct().collect()
    assert files and all(name.endswith(".zstd.parquet") for (name,) in files)
