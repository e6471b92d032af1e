"""Hand-over figures of a run."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F

from palletrail.functions.predicates import stamp


def figures(measure: str | None) -> tuple[Column, Column]:
    """Aggregates of a report: its rows, and the sum of the named column, if any."""
    total = F.coalesce(F.sum(F.col(measure).cast("double")), F.lit(0.0)) if measure else F.max(F.lit(None).cast("double"))
    return F.count(F.lit(1)).alias("rows"), total.alias("total")


def write_observed(report: DataFrame, measure: str | None, path: str) -> dict:
    """Write a report; its figures are taken by the write itself, so nothing is read again."""
    seen = Observation()
    report.observe(seen, *figures(measure)).write.parquet(path)
    return seen.get


def summary_row(name: str, counted: DataFrame, run_time: datetime) -> DataFrame:
    return counted.select(
        F.lit(name).alias("report"), "rows", "total",
        F.when(F.col("rows") > 0, "SUCCESS").otherwise("NO_DATA").alias("status"),
        stamp(run_time).alias("run_time"))


def run_summary(reports: Mapping[str, tuple[DataFrame, str | None]], run_time: datetime) -> DataFrame:
    """Rows, total and status per report; the total is the sum of the named column, if any."""
    parts = [summary_row(name, frame.agg(*figures(measure)), run_time) for name, (frame, measure) in reports.items()]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary
