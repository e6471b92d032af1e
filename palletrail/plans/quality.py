"""Audit sources gathered into one table and scored against defect limits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from palletrail.config import DPMI_LIMIT


def multi_source_audit(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All audit sources in one table; columns a source lacks are NULL there."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in sources.items()]
    databank = tagged[0]
    for frame in tagged[1:]:
        databank = databank.unionByName(frame, allowMissingColumns=True)
    return databank


def dpmi_score(audits: DataFrame, limit: float = DPMI_LIMIT) -> DataFrame:
    """Defects per million items of every sub-process, and whether it stays below the limit."""
    totals = audits.groupBy("bucket", "sub_process").agg(
        F.sum("items").cast("bigint").alias("items"), F.sum("defects").cast("bigint").alias("defects"))
    dpmi = F.col("defects") * 1e6 / F.nullif(F.col("items"), F.lit(0).cast("bigint"))
    return totals.select("bucket", "sub_process", "items", "defects", dpmi.alias("dpmi"),
                         F.coalesce(dpmi < limit, F.lit(False)).alias("target_met"))


def quality_score(audits: DataFrame, limit: float = DPMI_LIMIT) -> DataFrame:
    """Share of targets met per bucket and overall, in percent; audits without a bucket have a row of their own."""
    scored = dpmi_score(audits, limit)
    return scored.rollup("bucket").agg(
        F.count("*").alias("targets"),
        F.count_if(F.col("target_met")).alias("met"),
        (F.count_if(F.col("target_met")) * 100.0 / F.count("*")).alias("score"),
        F.grouping("bucket").alias("total"),
    ).select(F.when(F.col("total") == 1, "overall").otherwise(F.col("bucket")).alias("bucket"), "targets", "met", "score")
