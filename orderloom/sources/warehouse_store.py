"""Published warehouse versions as Parquet, switched by one atomic rename.

A version is a set of table folders. The pointer file lists the folders of the current version, so
readers see all of a load or nothing of it, and a failed load leaves the previous version current.
The rename is atomic on HDFS and POSIX file systems; object stores need a table format instead.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import dates
from orderloom.operators.constraints import key_constraints
from orderloom.operators.constraints import row_counts as broken_rows
from orderloom.operators.model import Warehouse, empty_warehouse
from orderloom.schema import (
    FACT_COLUMNS,
    NATURAL_KEYS,
    PARTITION_COLUMN,
    PRIMARY_KEYS,
    TABLES,
    Limits,
    WarehouseError,
)
from orderloom.sources.staging import delete_folder, shuffles_dropped

POINTER = "CURRENT"

# table name -> folders that together hold its rows
Version = dict[str, list[str]]


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, target, target.getFileSystem(configuration), configuration


def current_version(spark: SparkSession, root: str) -> Version | None:
    _, pointer, files, _ = _file_system(spark, f"{root}/{POINTER}")
    if not files.exists(pointer):
        return None
    return json.loads(spark.read.text(f"{root}/{POINTER}", wholetext=True).first()[0])


def _switch(spark: SparkSession, root: str, version: Version) -> None:
    """Make the version current by renaming a complete pointer file over the old one."""
    draft_path = f"{root}/.{POINTER}-{uuid.uuid4().hex}"
    jvm, draft, files, configuration = _file_system(spark, draft_path)
    stream = files.create(draft, True)
    stream.write(json.dumps(version).encode())
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), configuration)
    context.rename(draft, pointer, options)


def _new_folder(root: str) -> str:
    return f"{root}/load-{uuid.uuid4().hex[:12]}"


def _write(warehouse: Warehouse, folder: str, limits: Limits = Limits()) -> tuple[Version, list[str]]:
    """Write all tables of a load into the load's folder, each once.

    The single-row constraints are counted on the rows as they pass, before they are cast, so a value
    that its column cannot hold is a broken constraint and not an error of the job.
    """
    failed = []
    for name, table in warehouse.tables().items():
        passed = Observation(f"{name}-{uuid.uuid4().hex}")
        seen = table.observe(passed, *broken_rows(name, limits))
        rows = seen.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
        if name == "fact_sales":
            # Keys follow the calendar, so a task writes one or two years and keeps their order.
            rows = rows.withColumn(PARTITION_COLUMN, dates.key_year(F.col("date_key")))
            rows = rows.sortWithinPartitions(PARTITION_COLUMN, "sales_key")
            rows.write.partitionBy(PARTITION_COLUMN).parquet(f"{folder}/{name}", compression="zstd")
        else:
            rows.write.parquet(f"{folder}/{name}")
        failed += [f"{name}.{rule}" for rule, count in passed.get.items() if count]
    return {name: [f"{folder}/{name}"] for name in warehouse.tables()}, failed


def _read(spark: SparkSession, version: Version) -> Warehouse:
    tables = {}
    for name, paths in version.items():
        schema = TABLES[name]
        if name == "fact_sales":
            partition = T.StructField(PARTITION_COLUMN, T.IntegerType())
            schema = T.StructType([*schema.fields, partition])
        loads = [spark.read.schema(schema).parquet(path) for path in paths]
        tables[name] = reduce(DataFrame.unionByName, loads)
    return Warehouse(**tables)


def read_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Current version; its fact also carries the partition column for pruning."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published warehouse below {root}")
    return _read(spark, version)


def contract_fact(warehouse: Warehouse) -> DataFrame:
    """Fact with exactly the declared columns."""
    return warehouse.fact_sales.select(*FACT_COLUMNS)


def initialise(spark: SparkSession, root: str) -> Warehouse:
    """Publish six empty tables in place of whatever is current."""
    _switch(spark, root, _write(empty_warehouse(spark), _new_folder(root))[0])
    return read_warehouse(spark, root)


def _conflicts(old: Warehouse, new: Warehouse) -> list[str]:
    """Tables in which a new row repeats a key of the current version."""
    found = []
    for name, table in new.tables().items():
        for columns in ([PRIMARY_KEYS[name]], NATURAL_KEYS[name]):
            known = old.tables()[name].select(*columns)
            if not table.select(*columns).join(known, columns, "left_semi").isEmpty():
                found.append(f"{name}({', '.join(columns)})")
    return found


def failed_key_checks(warehouse: Warehouse) -> list[str]:
    """Names of the broken unique and reference constraints."""
    broken = key_constraints(warehouse).where("violations > 0").collect()
    return [f"{row.table_name}.{row.constraint_name}" for row in broken]


def publish(
    warehouse: Warehouse, root: str, *, rebuild: bool = True, limits: Limits = Limits()
) -> Warehouse:
    """Write, check, then switch; any failure leaves the current version untouched.

    All declared constraints must hold; they include every integrity check: references, unique keys,
    not-null columns and formulas. `rebuild=False` adds the rows to the current version and rejects
    keys it already has. A rejected load deletes what it wrote; `constraints.unfit_rows` shows the
    rows with values that do not fit. One job publishes to a folder at a time.
    """
    spark = warehouse.spark
    folder = _new_folder(root)
    try:
        with shuffles_dropped(spark):
            version, failed = _write(warehouse, folder, limits)
            if failed:
                raise WarehouseError("warehouse checks failed: " + ", ".join(sorted(failed)))
            return _check_and_switch(spark, root, version, rebuild)
    except Exception:
        delete_folder(spark, folder)
        raise


def _check_and_switch(spark: SparkSession, root: str, version: Version, rebuild: bool) -> Warehouse:
    candidate = _read(spark, version)
    if not rebuild:
        current = current_version(spark, root)
        if current is not None:
            repeated = _conflicts(_read(spark, current), candidate)
            if repeated:
                raise WarehouseError("keys exist already: " + ", ".join(repeated))
            version = {name: current[name] + paths for name, paths in version.items()}
            candidate = _read(spark, version)
    failed = failed_key_checks(candidate)
    if failed:
        raise WarehouseError("warehouse checks failed: " + ", ".join(sorted(failed)))
    _switch(spark, root, version)
    return candidate


def row_counts(warehouse: Warehouse) -> DataFrame:
    """(table_name, row_count) of all tables."""
    parts = [
        table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, table in warehouse.tables().items()
    ]
    return reduce(DataFrame.unionByName, parts)


def without_partition_column(warehouse: Warehouse) -> Warehouse:
    return replace(warehouse, fact_sales=contract_fact(warehouse))
