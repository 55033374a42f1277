import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.operators import numbering
from orderloom.operators.numbering import Rank


@pytest.fixture(scope="module")
def tied(spark):
    """2,000 rows of which a third share one value."""
    random.seed(7)
    data = [(i, 500 if i % 3 == 0 else random.randrange(120)) for i in range(2000)]
    random.shuffle(data)
    return spark.createDataFrame(data, "id int, value int").repartition(6)


def test_index_equals_a_global_row_number(tied):
    order = [F.col("value").desc(), F.col("id")]
    mine = numbering.ordered_index(tied, order, "n").collect()
    window = tied.withColumn("n", F.row_number().over(Window.orderBy(*order))).collect()
    assert sorted(map(tuple, mine)) == sorted(map(tuple, window))


def test_running_sum_covers_earlier_rows(tied):
    got = numbering.ordered_index(tied, [F.col("id")], "n", running="value").orderBy("n").collect()
    total = 0
    for row in got:
        assert row.running_before == total
        total += row.value


RANKS = [
    Rank("d", "value"),
    Rank("r", "value", dense=False),
    Rank("da", "value", descending=False),
    Rank("ra", "value", descending=False, dense=False),
    Rank("by_id", "id"),
]


@pytest.fixture(scope="module")
def amounts(spark):
    """Random cents with repeats and nulls."""
    random.seed(11)
    rows = [(i, None if i % 13 == 0 else random.randrange(10**9) / 100) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(0, 400, 7)]
    return spark.createDataFrame(rows, "id int, value double")


def test_ranks_equal_window_ranks(tied):
    found = numbering.with_ranks(tied, RANKS)
    wanted = numbering.few_ranks(tied, RANKS)
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


@pytest.mark.parametrize("partitions", [1, 5, 23])
def test_null_ranks_equal_window_ranks(amounts, partitions):
    some = amounts.repartition(partitions)
    found = numbering.with_ranks(some, RANKS).collect()
    wanted = numbering.few_ranks(some, RANKS).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, wanted)))


def cents_median(values: list[float]) -> float | None:
    cents = sorted(round(v * 100) for v in values)
    middle = len(cents) // 2
    if not cents:
        return None
    return (cents[middle] + cents[middle if len(cents) % 2 else middle - 1]) / 200


@pytest.mark.parametrize("count", [1, 2, 3, 10, 11, 400])
@pytest.mark.parametrize("partitions", [1, 9])
def test_median_is_the_same_at_any_partitioning(amounts, count, partitions):
    some = amounts.where(F.col("id") < count)
    values = [r.value for r in some.collect() if r.value is not None]
    found = numbering.median(some.repartition(partitions), "value").first()[0]
    assert found == cents_median(values)


def test_median_of_two_middle_cents(spark):
    pair = spark.createDataFrame([(1, 1209279.06), (2, 7626903.79)], "id int, value double")
    assert numbering.median(pair, "value").first()[0] == (120927906 + 762690379) / 200
    exact = pair.withColumn("value", F.col("value").cast("decimal(14,2)"))
    assert numbering.median(exact, "value").first()[0] == (120927906 + 762690379) / 200


def test_top_rows(tied):
    order = [F.col("value").desc(), F.col("id")]
    wanted = sorted(map(tuple, tied.collect()), key=lambda r: (-r[1], r[0]))
    assert list(map(tuple, numbering.top_rows(tied, order, 700).collect())) == wanted[:700]
    assert numbering.top_rows(tied, order, 0).count() == 0


def test_hot_group_is_numbered_like_the_others(tied):
    expected = numbering.number_within(tied, "value", ["id"], "n").collect()
    split = numbering.number_within(tied, "value", ["id"], "n", limit=100).collect()
    assert sorted(map(tuple, expected)) == sorted(map(tuple, split))


def test_full_copies_get_distinct_numbers(spark):
    copies = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")] * 3, "g int, v string")
    numbered = numbering.number_within(copies, "g", ["v"], "n", limit=10).collect()
    assert sorted(r.n for r in numbered if r.g == 1) == list(range(1, 51))
    assert sorted(r.n for r in numbered if r.g == 2) == [1, 2, 3]


def test_dense_key_on_several_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = spark.range(500).selectExpr("format_string('N%05d', id * 7 % 500) AS name")
        keyed = numbering.dense_key(names, ["name"], "key").orderBy("key").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.key for r in keyed] == list(range(1, 501))
    assert [r.name for r in keyed] == sorted(r.name for r in keyed)


@pytest.mark.parametrize("blocks", ["2", "5", "40"])
def test_ties_over_many_blocks(spark, blocks):
    """Values that fill several blocks, next to values of their own, all equal or all null."""
    random.seed(5)
    some = [(i, random.choice([1.5] * 6 + [2.5] * 6 + [float(i)]), 7, None) for i in range(600)]
    some += [(600 + i, None, 7, None) for i in range(90)]
    frame = spark.createDataFrame(some, "id int, value double, same int, missing double").repartition(7)
    ranks = [
        Rank(f"{column}_{descending}_{dense}", column, descending, dense)
        for column in ("value", "same", "missing")
        for descending in (True, False)
        for dense in (True, False)
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", blocks)
    try:
        found = numbering.with_ranks(frame, ranks).collect()
        borders, _ = numbering._borders(frame, ["value"])
        values = numbering._block_values(frame, "value", borders["value"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted = numbering.few_ranks(frame, ranks).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, wanted)))
    if blocks == "40":
        # No task has a third of the rows, although two values have almost half of them each.
        ties = [r["_ties"] for r in values if r["_value"] == 1.5]
        assert len(ties) > 10 and max(ties) < 600 / 10


def test_ranks_of_no_rows(spark, amounts):
    assert numbering.with_ranks(amounts.where("id < 0"), RANKS).collect() == []
    one = numbering.with_ranks(amounts.where("id = 1"), RANKS).first()
    assert [one[r.name] for r in RANKS] == [1] * len(RANKS)


def test_decimals_rank_as_they_are(spark):
    frame = spark.createDataFrame([(i, i % 40) for i in range(300)], "id int, value int").withColumn(
        "value", (F.col("value") * 0.01 + 10**11).cast("decimal(18,2)")
    )
    found = numbering.with_ranks(frame, RANKS).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, numbering.few_ranks(frame, RANKS).collect())))


@pytest.fixture
def writes(monkeypatch):
    names = []
    real = numbering.stage
    monkeypatch.setattr(numbering, "stage", lambda frame, name: names.append(name) or real(frame, name))
    return names


def test_ranks_write_once_and_exchange_a_column_once(tied, writes):
    plan = numbering.with_ranks(tied, RANKS)._jdf.queryExecution().executedPlan().toString()
    assert writes == ["ranked"]
    # Two ranked columns, whatever the number of ranks; nothing is sorted as a whole.
    assert plan.count("Exchange hashpartitioning(_block") == 2
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_median_writes_and_sorts_nothing(amounts, writes):
    numbering.median(amounts, "value")
    assert writes == []


def test_median_of_any_sign_and_size(spark):
    random.seed(3)
    for count in (5, 6, 301):
        cents = [random.choice([-1, 1]) * random.randrange(10 ** random.choice([1, 5, 9, 15])) for _ in range(count)]
        frame = spark.createDataFrame([(c,) for c in cents], "c long").select(
            (F.col("c").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).alias("value")
        )
        middle = sorted(cents)[(count - 1) // 2], sorted(cents)[count // 2]
        assert numbering.median(frame, "value").first()[0] == sum(middle) / 200
