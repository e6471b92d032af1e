"""Helpers for uneven keys and for joins against small tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from palletrail.session import shared_dir

MAX_HOT_KEYS = 1000
TRACKED_KEYS = 20_000
HOT_ROWS = 5_000

# Largest table sent whole to every executor, by the optimizer's own size estimate.
BROADCAST_BYTES = 32 << 20


def hot_keys(df: DataFrame, key: str, at_least: int = HOT_ROWS) -> list[str]:
    """Keys with very many rows, at most ``MAX_HOT_KEYS`` of them.

    Runs one pass over the key column that merges a small frequent-items sketch per task.
    The sketch may miss a key near the limit, so callers must be right for any answer.
    """
    top = F.expr(f"approx_top_k({key}, {MAX_HOT_KEYS}, {TRACKED_KEYS})")
    items = df.where(F.col(key).isNotNull()).agg(top.alias("top")).select(F.inline("top"))
    return [row["item"] for row in items.where(F.col("count") >= at_least).collect()]


def split_by(df: DataFrame, keys: Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in ``keys`` and the rest, by a filter that reaches the scan."""
    hot = F.coalesce(F.col(key).isin(*keys), F.lit(False))
    return df.where(hot), df.where(~hot)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the optimizer's size estimate of ``df`` is below the limit.

    The estimate of a file scan starts from the file sizes and filters do not lower it
    without statistics, so for plain reads and projections it is an upper bound up to
    compression; the limit leaves room for that.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast for a small table; a larger one is left to a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps a single candidate per key and task before the shuffle (group limit),
    so a key with very many rows does not travel.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def sequence_index(
    df: DataFrame, key: str, order: list[Column], position: Column, name: str = "rn",
    hot: Sequence[str] = (), step: int = 100_000, also: Sequence[str] = (),
) -> DataFrame:
    """Number the rows of each key (and of each value of ``also``) from 1 in the given order.

    Keys in ``hot`` are numbered in pieces: ``position`` (a whole number that the order
    starts with, ascending) is cut into ranges of ``step``; a row's number is its number
    within its range plus the rows of the ranges before.  Both windows then stay small,
    whatever the key holds.
    """
    keys = [key, *also]
    plain = Window.partitionBy(*keys).orderBy(*order)
    if not hot:
        return df.withColumn(name, F.row_number().over(plain))

    many, few = split_by(df, hot, key)
    few = few.withColumn(name, F.row_number().over(plain))

    # A missing position sorts last, as it does in the order.
    last_range = F.lit((1 << 63) - 1)
    many = many.withColumn("_range", F.coalesce(F.floor(position / step), last_range))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        many.groupBy(*keys, "_range").agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    within = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    many = (
        many.withColumn("_n", within)
        .join(offsets, [*keys, "_range"])
        .withColumn(name, (F.col("_n") + F.col("_before")).cast("int"))
        .drop("_n", "_range", "_before")
    )
    return few.unionByName(many)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows from 1 in the frame's own order, which a sort gave it.

    Rows are numbered within their partitions and written; the partitions' sizes, one row each, are added
    up and give every row the rows before its partition.  No window spans the frame.
    """
    path = f"{shared_dir(df.sparkSession)}/positions-{uuid.uuid4().hex}"
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    # Fixed value: the id has the partition above its lower 33 bits, and the row within it in these.
    rows = rows.withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = rows.join(broadcast_if_small(sizes), "_part")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_row") + 1).alias(name))
