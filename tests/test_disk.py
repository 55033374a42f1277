"""What a job leaves on disk, and how narrow fact lines are on their way."""

import time
from decimal import Decimal

import pytest
from order_lines import frame, good_lines
from pyspark.sql import functions as F

from orderloom.operators import model, numbering, packed
from orderloom.plans.load_job import load_raw
from orderloom.schema import FACT_COLUMNS
from orderloom.sources import staging


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left_after(spark, job) -> set[str]:
    before = shuffle_files(spark)
    job()
    # Executors delete after they are told.
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def staged(spark) -> set[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging.shared_root(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in files.listStatus(path)} if files.exists(path) else set()


def test_staging_leaves_no_shuffle_files(spark):
    numbers = spark.range(10_000)
    by_last_digit = numbers.groupBy((F.col("id") % 10).alias("digit")).count().repartition(3)
    assert not left_after(spark, lambda: staging.stage(by_last_digit, "test"))
    assert spark.conf.get(staging.DROP_SHUFFLES) == "false"


def test_a_load_leaves_the_warehouse_alone(spark, raw):
    root, before = staging.new_path(spark, "warehouse"), staged(spark)
    published = []
    assert not left_after(spark, lambda: published.append(load_raw(raw, root)))
    assert staged(spark) - before == {root.rsplit("/", 1)[1]}
    assert published[0].fact_sales.count() == len(good_lines())


def test_temporary_frames_go_also_after_an_error(spark):
    before = staged(spark)
    with pytest.raises(ValueError):
        with staging.temporary(spark):
            assert staging.stage(spark.range(3), "test").count() == 3
            raise ValueError
    assert staged(spark) == before


ODD = {
    "usual": {},
    "null id": {"customer_id": None},
    "other id": {"customer_id": "CUST1x"},
    "lower id": {"transaction_id": "txn0000003"},
    "line feed": {"product_id": "PROD001\n"},
    "long id": {"transaction_id": "TXN" + "9" * 18},
    "short id": {"transaction_id": "TXN9"},
    "longer id": {"transaction_id": "TXN10"},
    "no digits": {"product_id": "PROD"},
    "zero": {"line_number": 0, "quantity": 0},
    "negative": {"quantity": -1},
    "negative price": {"unit_price": Decimal("-0.01")},
    "large line": {"line_number": 1 << 10},
    "largest small line": {"line_number": (1 << 10) - 1},
    "large quantity": {"quantity": 1 << 14},
    "large price": {"unit_price": Decimal("2684354.56")},
    "largest small price": {"unit_price": Decimal("2684354.55")},
    "large discount": {"discount": Decimal("1.6384")},
    "no discount": {"discount": None},
    "no channel": {"channel_key": None},
    "off formula": {"revenue": Decimal("0.01")},
    "no amount": {"profit": None},
}
USUAL = {
    "transaction_id": "TXN0000003", "line_number": 1, "date_key": 20240203, "customer_id": "CUST00001",
    "product_id": "PROD001", "quantity": 2, "unit_price": Decimal("200.00"), "discount": Decimal("0.0500"),
    "revenue": Decimal("0.00"), "unit_cost": Decimal("120.00"), "total_cost": Decimal("0.00"),
    "profit": Decimal("0.00"), "channel_key": 3, "note": "",
}
TYPES = (
    "transaction_id string, line_number int, date_key int, customer_id string, product_id string, quantity int,"
    " unit_price decimal(12,2), discount decimal(5,4), revenue decimal(15,2), unit_cost decimal(12,2),"
    " total_cost decimal(15,2), profit decimal(16,2), channel_key int, note string"
)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [tuple({**USUAL, **values, "note": note}.values()) for note, values in ODD.items()]
    return spark.createDataFrame(rows, TYPES)


def test_packed_lines_hold_any_value(odd):
    words = packed.pack(odd)
    back = packed.unpack(words).select(*odd.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, odd.collect()))
    assert back.schema == odd.schema
    plain = {row.note for row in words.where(F.col(packed.WHOLE).isNull()).collect()}
    assert plain == {"usual", "short id", "longer id", "zero", "largest small line", "largest small price"}


def test_packed_ids_meet_their_own_key_only(spark, odd):
    ids = sorted({row.product_id for row in odd.collect()}) + [None, "PROD01", "PROD1"]
    owners = spark.createDataFrame([(name, n) for n, name in enumerate(ids)], "product_id string, product_key int")
    keyed = packed.with_key(packed.pack(odd), owners, "product_id", "product_key")
    expected = odd.join(owners, "product_id", "left").select("note", "product_key")
    assert sorted(keyed.select("note", "product_key").collect()) == sorted(expected.collect())


def test_lines_are_numbered_by_their_texts(spark):
    """Ids of several lengths and forms, a line without a customer, and amounts off their formulas."""
    rows = [
        dict(row, transaction_id=order, customer_id=customer, revenue=revenue)
        for row in good_lines()[:1] + good_lines()[4:]
        for order, customer, revenue in (
            ("TXN10", "CUST00001", row["revenue"]), ("TXN9", None, row["revenue"]),
            ("TXN9x", "CUST00001", "7.00"), ("A", "other", row["revenue"]),
        )
    ]
    lines = model.typed_lines(frame(spark, rows))
    customers = model.build_dim_customer(lines)
    products = model.build_dim_product(lines, model.build_dim_category(lines))
    fact = model.build_fact(lines, customers, products, model.build_dim_channel(lines)).collect()
    key = lambda row: (row["order_date"], row["transaction_id"], int(row["line_number"]))
    names = {row.customer_key: row.customer_id for row in customers.collect()}
    expected = [(*key(row)[1:], row["customer_id"], Decimal(row["revenue"])) for row in sorted(rows, key=key)]
    found = [
        (row.transaction_id, row.line_number, names[row.customer_key] if row.customer_key else None, row.revenue)
        for row in sorted(fact, key=lambda row: row.sales_key)
    ]
    assert found == expected and [row.sales_key for row in sorted(fact, key=lambda r: r.sales_key)] == [
        *range(1, len(rows) + 1)
    ]
    assert fact[0].__fields__ == FACT_COLUMNS


def test_group_sizes_are_counted_per_hash_first(spark, monkeypatch):
    rows = spark.createDataFrame([(g, v) for g in (1, 2, None) for v in range(4 if g == 1 else 2)], "g int, v int")
    assert numbering._large_groups(rows, "g", 8) is None
    monkeypatch.setattr(numbering, "SIZE_BUCKETS", 1)
    assert numbering._large_groups(rows, "g", 7) is None
    assert [row.g for row in numbering._large_groups(rows, "g", 3).collect()] == [1]
    numbered = numbering.number_within(rows, "g", ["v"], "n", limit=3).collect()
    assert all(row.n == row.v + 1 for row in numbered) and len(numbered) == rows.count()
