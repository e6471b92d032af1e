"""Inbound lines and sorter volume.  Both reports always run over a closed window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from palletrail import config as c
from palletrail.functions import rules, times
from palletrail.functions.attributes import json_fields
from palletrail.functions.predicates import between_window


def inbound_lines(ledger: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Booked lines of inbound orders at goods receipt, with reference and grade."""
    rows = ledger.where(
        (F.col("typ_id") == c.EVENT_BOOKED)
        & between_window(F.col("created"), start, end)
        & (F.col("ziel") == "WE")
        & F.col("hostauftrnr").like("UN%"))
    return json_fields(rows, ("grade_article", "reference")).select(
        times.day_text(F.col("created")).alias("date_only"),
        times.month_key(F.col("created")).alias("year_month"),
        "transportlhmnr",
        F.col("ziel").alias("source"),
        F.col("reference").alias("reference_lhm"),
        rules.grade_plain(F.col("grade_article")).alias("quality"),
        "menge",
    )


def sorter_volume(ledger: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Single pieces per day at the sorter for container-content orders, in order of the day."""
    days = (
        ledger.where(
            (F.col("lagbez") == "Sorter")
            & between_window(F.col("created"), start, end)
            & F.col("hostauftrnr").like("LCCONTENT%")
            & (F.col("menge") == 1))
        .groupBy(F.to_date("created").alias("day"))
        .agg(F.sum("menge").cast("bigint").alias("quantity"))
        .orderBy("day")
    )
    return days.select(times.day_text(F.col("day")).alias("date_only"), times.month_key(F.col("day")).alias("year_month"),
                       "quantity")
