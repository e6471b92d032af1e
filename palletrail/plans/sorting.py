"""Manual sorting: bookings at the sorting places, matched leg by leg."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from palletrail import config as c
from palletrail.functions import rules, times
from palletrail.operators.legs import LegFilter, pair_legs_sequenced
from palletrail.operators.skew import HOT_ROWS


def manual_sorting(ledger: DataFrame, how: LegFilter = LegFilter(), labels: Mapping[str, str] = c.SOURCES,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Detail rows of manual sorting; grade, category and channel come from the departure leg."""
    kind, grade = F.col("good_type"), F.col("grade_sector")
    ean = F.when(kind == "NORMAL", F.col("artnr")).otherwise(
        rules.ean_three_step(F.col("artnr"), F.col("last_ean"), F.col("in_artnr")))
    target = rules.like_target(F.col("ziel_lhm"), ["50%"])
    return pair_legs_sequenced(ledger, how, hot_rows).select(
        times.stamp_text(F.col("created")).alias("timestamp"),
        ean.alias("ean"),
        F.col("ziel").alias("ap"),
        F.col("createdby").alias("benutzer"),
        "source_lhm", "ziel_lhm",
        F.abs("menge").cast("bigint").alias("quantity"),
        F.col("reference").alias("reference_lhm"),
        rules.source_channel_map(F.col("source_id"), c.SORTING_SOURCE_DEFAULT, labels).alias("source_channel"),
        rules.grade_plain(grade).alias("quality"),
        rules.category_map(F.col("category_id")).alias("category"),
        rules.distribution_channel(c.CHANNEL_RULES["sorting"], F.col("channel_id"), F.col("source_id"), target, grade)
        .alias("distribution_channel"),
        rules.by_origin(kind, F.col("sku"), F.col("in_sku")).alias("sku"),
        rules.by_origin(kind, F.col("sort_id"), F.col("in_sort_id")).alias("sort_id"),
    )
