"""Readers: ledger and other tables from files or a database, brought to one form at the edge."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palletrail.functions.predicates import between_window, keep
from palletrail.functions.text import blank_to_null

# Types of ledger columns that other systems deliver as text or decimals.
LEDGER_TYPES = {"sequence": "bigint", "typ_id": "int", "tpartnr": "int", "menge": "int", "created": "timestamp_ntz"}


def normalize(df: DataFrame, types: Mapping[str, str] = LEDGER_TYPES) -> DataFrame:
    """Lower-case names, fixed types, and NULL for blank texts.

    A column that already has its type is passed through, so filters on it still reach
    the scan.  Blank texts of the other columns become NULL.
    """
    columns = []
    for name, found in df.dtypes:
        wanted = types.get(name.lower())
        column = F.col(f"`{name}`")
        if wanted and wanted != found:
            column = column.try_cast(wanted)
        elif found == "string":
            column = blank_to_null(column)
        columns.append(column.alias(name.lower()))
    return df.select(*columns)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
               **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def jdbc_options(url: str, table: str, column: str, lower: str, upper: str, partitions: int,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a database read that Spark splits into ranges of a column."""
    return {
        "url": url, "dbtable": table, "partitionColumn": column, "lowerBound": lower, "upperBound": upper,
        "numPartitions": str(partitions), "fetchsize": str(fetch_size), "pushDownPredicate": "true",
    }


def read_jdbc(spark: SparkSession, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_ledger(source: DataFrame, start: datetime | None = None, end: datetime | None = None,
                columns: Sequence[str] | None = None, only: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Ledger rows of a window; column choice and window are pushed into the scan.

    ``only`` has conditions on text columns, by their lower-case name.  They are put to the column as it is stored, with
    blanks left out, and so reach the scan too, where a condition on the normalized column would not.
    """
    names = {name.lower(): name for name in source.columns}
    raw = [F.col(f"`{names[name]}`") for name in only or {}]
    kept = keep(source, *[(column != "") & condition(column) for column, condition in zip(raw, (only or {}).values())])
    rows = keep(normalize(kept), between_window(F.col("created"), start, end))
    return rows.select(*columns) if columns else rows
