"""Keys that cannot repeat stay where they are."""

from orderloom.operators import keys


def test_no_key_travels_if_none_is_doubtful(spark):
    rows = spark.createDataFrame([(1, "A", 1), (1, "A", 2)], "number int, text string, whole bigint")
    none = rows.where("whole > 5")
    assert keys._if_any(rows, none).count() == 0 and keys._if_any(rows, rows.limit(1)).count() == 2
    plan = keys._doubtful_orders(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
