import pytest

from order_lines import changed, frame, good_lines, line, raw_frame
from orderloom.operators import validate
from orderloom.operators.model import build_warehouse, typed_lines
from orderloom.schema import RawDataError


def counts(frame_):
    return {
        r.check_name: r.violation_count for r in validate.validate_source(frame_).collect()
    }


def test_good_lines_pass_every_check(spark):
    raw = raw_frame(spark)
    report = counts(raw)
    assert list(validate.MESSAGES) == [
        r.check_name for r in validate.validate_source(raw).orderBy("check_no").collect()
    ]
    assert set(report.values()) == {0}
    assert validate.require_valid(raw) is raw


def test_typed_frame_passes_too(spark):
    assert set(counts(typed_lines(raw_frame(spark))).values()) == {0}


BAD = {
    "nulls": (changed(0, customer_region=None, sales_channel=None), "null_values",
              "lack values of customer_region, sales_channel"),
    "date": (changed(1, order_date="05/01/2023"), "invalid_order_date", "order_date"),
    "text quantity": (changed(2, quantity="two"), "invalid_numbers", "is no number"),
    "fraction": (changed(2, quantity="2.5"), "invalid_numbers", "is no number"),
    "zero quantity": (changed(2, quantity="0"), "nonpositive_counts", "below one"),
    "zero line": (changed(2, line_number="0"), "nonpositive_counts", "below one"),
    "zero price": (changed(3, unit_price="0"), "nonpositive_prices", "not above zero"),
    "zero cost": (changed(3, unit_cost="0"), "nonpositive_prices", "not above zero"),
    "negative revenue": (changed(3, revenue="-0.01"), "negative_amounts", "below zero"),
    "far discount": (changed(3, discount="1500"), "discount_out_of_range", "outside 0 to 1"),
    "discount": (changed(3, discount="1.01"), "discount_out_of_range", "outside 0 to 1"),
    "revenue": (changed(3, revenue="401.00"), "financial_mismatch", "differs from its formula"),
    "profit": (changed(3, profit="0.00"), "financial_mismatch", "differs from its formula"),
    "region": (changed(0, customer_region="South"), "unstable_customer_id",
               "one customer_id has several values of customer_region"),
    "product": (changed(0, product_name="Table"), "unstable_product_id",
                "one product_id has several values of product_name"),
    "channel": (changed(0, sales_channel="Retail"), "unstable_transaction_id",
                "one transaction_id has several values of sales_channel"),
    "order date": (changed(0, order_date="2023-01-06"), "unstable_transaction_id", "order_date"),
}


@pytest.mark.parametrize("name", BAD)
def test_each_violation_is_counted_and_raised(spark, name):
    rows, check, message = BAD[name]
    raw = frame(spark, rows)
    assert counts(raw)[check] >= 1
    with pytest.raises(RawDataError, match=message):
        validate.require_valid(raw)


def test_empty_and_duplicate(spark):
    empty = frame(spark, [])
    assert counts(empty)["empty_dataset"] == 1
    with pytest.raises(RawDataError, match="no order lines"):
        validate.require_valid(empty)
    doubled = frame(spark, [*good_lines(), good_lines()[0]])
    assert counts(doubled)["duplicate_lines"] == 1
    with pytest.raises(RawDataError, match="two lines with one number"):
        validate.require_valid(doubled)


@pytest.mark.parametrize("number", ["01", "1.0", " 1"])
def test_line_numbers_are_compared_as_numbers(spark, number):
    first = good_lines()[0]
    again = frame(spark, [*good_lines(), {**first, "line_number": number}])
    (row,) = validate.duplicate_lines(again).collect()
    assert (row.transaction_id, row.line_number, row.copies) == (first["transaction_id"], "1", 2)
    words = frame(spark, [*good_lines(), {**first, "line_number": "one"}])
    assert validate.duplicate_lines(words).isEmpty()


def test_first_broken_rule_is_reported(spark):
    rows = changed(0, order_date="never")
    rows[1]["quantity"] = "0"
    with pytest.raises(RawDataError, match="order_date"):
        validate.require_valid(frame(spark, rows))


def test_null_counts_as_a_value_of_a_key(spark):
    raw = frame(spark, changed(0, customer_region=None))
    (row,) = validate.unstable_keys(raw, "customer_id").collect()
    assert (row.customer_id, row.unstable_customer_region) == ("CUST00001", True)
    everywhere = [{**r, "customer_region": None} for r in good_lines()]
    assert validate.unstable_keys(frame(spark, everywhere), "customer_id").isEmpty()


def test_whole_numbers_written_with_decimals_are_numbers(spark):
    assert counts(frame(spark, changed(3, quantity="2.0")))["invalid_numbers"] == 0


def test_half_cents_round_up(spark):
    # 0.05 x 1 x 0.9 = 0.045 -> 0.05; 1.15 x 1 x 0.7 = 0.805 -> 0.81
    rows = [
        line("TXN0000001", 1, "2023-01-05", "CUST00001", "North", "Online", "PROD003", 1, "0.10",
             unit_price="0.05", unit_cost="0.01"),
        line("TXN0000001", 2, "2023-01-05", "CUST00001", "North", "Online", "PROD003", 1, "0.30",
             unit_price="1.15", unit_cost="0.01"),
    ]
    assert [r["revenue"] for r in rows] == ["0.05", "0.81"]
    assert set(counts(frame(spark, rows)).values()) == {0}


def test_observed_amounts_round_half_even(spark):
    # 22.375 rounds to 22.38 (even), 22.365 to 22.36, so only the second differs from 22.37.
    good = changed(5, revenue="7.125")
    assert counts(frame(spark, good))["financial_mismatch"] == 1
    kept = changed(5, revenue="7.13")
    assert counts(frame(spark, kept))["financial_mismatch"] == 0


def test_mismatch_rows_show_both_sides(spark):
    (row,) = validate.financial_mismatches(frame(spark, changed(3, revenue="401.00"))).collect()
    assert (float(row.revenue), float(row.expected_revenue)) == (401.0, 400.0)


def test_model_checks(spark, warehouse):
    from dataclasses import replace

    assert validate.require_valid_model(warehouse) is warehouse
    holes = replace(warehouse, dim_product=warehouse.dim_product.where("product_key <> 1"))
    with pytest.raises(RawDataError, match="product_key without its dimension row"):
        validate.require_valid_model(holes)
    nulls = replace(
        warehouse, dim_channel=warehouse.dim_channel.selectExpr("channel_key", "null AS channel_name")
    )
    with pytest.raises(RawDataError, match="dim_channel lack values"):
        validate.require_valid_model(nulls)
    twice = replace(warehouse, dim_customer=warehouse.dim_customer.union(warehouse.dim_customer))
    with pytest.raises(RawDataError, match="repeats customer_key"):
        validate.require_valid_model(twice)


def test_unknown_attribute_leaves_a_null_key(spark):
    raw = raw_frame(spark)
    clean = build_warehouse(raw)
    from orderloom.operators.model import build_fact

    fact = build_fact(
        typed_lines(raw), clean.dim_customer, clean.dim_product,
        clean.dim_channel.where("channel_name <> 'Retail'"),
    )
    assert fact.where("channel_key IS NULL").count() == 1
