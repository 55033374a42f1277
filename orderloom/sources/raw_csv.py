"""Raw order lines as CSV: read under the column contract, write for exchange."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schema import RAW_COLUMNS, RawDataError

# Texts the pandas CSV reader takes for a missing value.
NULL_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


@contextmanager
def contract_errors() -> Iterator[None]:
    """Report a record that Spark cannot split into the contract columns as a contract error."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if "MALFORMED" not in str(error):
            raise
        raise RawDataError("a record does not split into the contract columns") from error


def require_columns(frame: DataFrame) -> DataFrame:
    """Check names, drop extra columns and restore the contract order."""
    missing = sorted(set(RAW_COLUMNS) - set(frame.columns))
    if missing:
        raise RawDataError("columns of the contract are absent: " + ", ".join(missing))
    return frame.select(*RAW_COLUMNS)


def read_raw_sales(
    spark: SparkSession,
    path: str,
    *,
    null_texts: list[str] = NULL_TEXTS,
    multi_line: bool = False,
) -> DataFrame:
    """Contract columns as text; typing is the validation's task.

    Columns go by header name and every file must carry the same header. `multi_line` accepts
    line breaks inside quoted fields, at the price that a file is then read by one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
    )
    try:
        frame = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no order lines at {path}") from error
        raise RawDataError(f"{path} does not read as CSV") from error
    frame = require_columns(frame)
    return frame.select(
        *[F.when(~F.col(c).isin(null_texts), F.col(c)).alias(c) for c in RAW_COLUMNS]
    )


def write_raw_sales(frame: DataFrame, path: str) -> str:
    """Write contract columns with a header and ISO dates; missing folders are created."""
    (
        require_columns(frame)
        .write.option("header", True)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    return path
