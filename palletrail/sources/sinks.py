"""Sinks that may be run again: each replaces exactly what it owns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palletrail.operators.skew import first_per_key
from palletrail.sources.parts import Contents, PartTable


def replace_by_key(df: DataFrame, path: str, key: str) -> None:
    """Replace the stored rows of the key values found in ``df``, and no others.

    The key is the partition column, so no stored row is read.  No rows, no change.
    Rows are gathered by key first, for few files; a value with very many rows is still
    written by several tasks.
    """
    df.hint("rebalance", F.col(key)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def read_stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table with the column types it was written with.

    Partition columns are text in folder names; without a schema a month ``04.2026`` would be
    read as a number and a day as a date.
    """
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


SNAPSHOT = ("report", "month", "version")


def rotate_snapshot(df: DataFrame, path: str, report: str, month: str) -> int:
    """Store a month's report as the current version and keep the one before it; returns its number of rows.

    The new rows are written once, then one change of the table's list makes them the current
    version and the current one the previous; no stored row is copied.
    """
    table = PartTable(df.sparkSession, path)
    new = table.write(df, report=report, month=month, version="current")

    def rotated(now: Contents) -> Contents:
        ours = [part for part in now.parts if (part.labels["report"], part.labels["month"]) == (report, month)]
        older = [replace(part, labels={**part.labels, "version": "previous"}) for part in ours if part.labels["version"] == "current"]
        return now.but(gone=ours, new=[*older, new])

    table.change(rotated)
    return new.rows


def read_snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    """All stored versions with their report, month and version; one scan per version."""
    table, frames = PartTable(spark, path), None
    for part in table.contents().parts:
        rows = table.read([part]).withColumns({name: F.lit(part.labels[name]) for name in SNAPSHOT})
        frames = rows if frames is None else frames.unionByName(rows, allowMissingColumns=True)
    return frames


def new_keys(batch: DataFrame, archive: DataFrame | None, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows of the batch whose key the archive lacks; the first row of a key wins."""
    rows = first_per_key(batch, [key], list(order))
    return rows if archive is None else rows.join(archive.select(key), key, "left_anti")


def append_new_keys(batch: DataFrame, path: str, key: str, order: Sequence[Column]) -> None:
    """Append the new rows.  A run that failed before its commit left nothing behind."""
    archive = read_if_exists(batch.sparkSession, path)
    new_keys(batch, archive, key, order).write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> int:
    """Replace everything, unless there is nothing to replace it with; returns the number of rows.

    The plan runs once: rows are counted by the write, and count only once the table's list names them.
    """
    table = PartTable(df.sparkSession, path)
    new = table.write(df)
    if not new.rows:
        raise ValueError("no rows to load; the stored table is kept")
    table.change(lambda now: now.but(gone=now.parts, new=[new]))
    return new.rows


def read_refreshed(spark: SparkSession, path: str) -> DataFrame | None:
    return PartTable(spark, path).read()
