"""Dimension lookups and column shaping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from palletrail.functions.rules import map_codes
from palletrail.operators.skew import broadcast_if_small


def dimension_dedup(dimension: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; of several values the first in text order stays."""
    return dimension.groupBy(key).agg(F.min(value).alias(value))


def enrich_dimension(rows: DataFrame, dimension: DataFrame, key: str, value: str,
                     overrides: Mapping[str, str], default: str) -> DataFrame:
    """Left join of a text from a dimension; a fixed override wins, a missing text gets the default.

    The overrides are a handful of configured keys, so they become a CASE expression.
    """
    unique = dimension_dedup(dimension, key, value)
    joined = rows.join(broadcast_if_small(unique), key, "left")
    fixed = map_codes(F.col(key), overrides) if overrides else F.lit(None).cast("string")
    return joined.withColumn(value, F.coalesce(fixed, F.col(value), F.lit(default)))


def select_rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order, under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items() if old in df.columns])
