import csv
from datetime import date

import pytest

from order_lines import frame, good_lines, raw_frame
from orderloom.operators.model import typed_lines
from orderloom.operators.validate import require_valid
from orderloom.schema import RAW_COLUMNS, RawDataError
from orderloom.sources.raw_csv import read_raw_sales, write_raw_sales


def write(path, columns, rows):
    with open(path, "w", newline="") as handle:
        writer = csv.DictWriter(handle, columns)
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def test_columns_go_by_name_and_extras_are_dropped(spark, tmp_path):
    rows = [{**row, "note": "x"} for row in good_lines()]
    columns = ["note", *reversed(RAW_COLUMNS)]
    read = read_raw_sales(spark, write(tmp_path / "sales.csv", columns, rows))
    assert read.columns == RAW_COLUMNS
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, raw_frame(spark).collect()))


def test_missing_columns_are_listed_in_order(spark, tmp_path):
    path = write(tmp_path / "sales.csv", ["transaction_id"], [{"transaction_id": "TXN0000001"}])
    with pytest.raises(RawDataError, match="absent: customer_id, customer_region"):
        read_raw_sales(spark, path)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw_sales(spark, str(tmp_path / "nowhere.csv"))


def test_null_texts_and_quotes(spark, tmp_path):
    rows = good_lines()
    rows[0]["customer_region"] = "NA"
    rows[1]["product_name"] = 'Pen, "blue"'
    rows[2]["sales_channel"] = ""
    read = read_raw_sales(spark, write(tmp_path / "sales.csv", RAW_COLUMNS, rows))
    got = {(r.transaction_id, r.line_number): r for r in read.collect()}
    assert got["TXN0000001", "1"].customer_region is None
    assert got["TXN0000001", "2"].product_name == 'Pen, "blue"'
    assert got["TXN0000002", "1"].sales_channel is None


def test_ids_keep_leading_zeros(spark, tmp_path):
    rows = good_lines()
    for row in rows:
        row["customer_id"] = "00" + row["customer_id"][-1]
    read = read_raw_sales(spark, write(tmp_path / "sales.csv", RAW_COLUMNS, rows))
    assert {r.customer_id for r in read.select("customer_id").collect()} == {"001", "002"}


def test_malformed_record_is_an_error(spark, tmp_path):
    path = write(tmp_path / "sales.csv", RAW_COLUMNS, good_lines())
    with open(path, "a") as handle:
        handle.write(",".join(["x"] * 20) + "\n")
    with pytest.raises(RawDataError, match="does not split"):
        require_valid(read_raw_sales(spark, path))


def test_round_trip_writes_iso_dates_and_makes_folders(spark, tmp_path):
    typed = typed_lines(raw_frame(spark))
    path = write_raw_sales(typed, str(tmp_path / "new" / "folder"))
    again = read_raw_sales(spark, path)
    assert again.first().order_date.count("-") == 2
    back = typed_lines(again)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, typed.collect()))
    assert min(r.order_date for r in back.collect()) == date(2023, 1, 5)


def test_files_with_other_headers_are_rejected(spark, tmp_path):
    write(tmp_path / "a.csv", RAW_COLUMNS, good_lines())
    write(tmp_path / "b.csv", list(reversed(RAW_COLUMNS)), good_lines())
    with pytest.raises(Exception):
        read_raw_sales(spark, str(tmp_path)).collect()


def test_frame_helper_matches_contract(spark):
    assert frame(spark, good_lines()).columns == RAW_COLUMNS
