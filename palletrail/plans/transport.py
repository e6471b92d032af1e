"""Transport KPIs, one by one and as the board."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from palletrail import config as c
from palletrail.functions.predicates import rolling_window, stamp
from palletrail.operators.transports import closings, count_open, ended, start_predicate
from palletrail.session import shared_dir

BY_NAME = {kpi.name: kpi for kpi in c.TRANSPORT_KPIS}


def transport_kpi(ledger: DataFrame, name: str, as_of: datetime) -> DataFrame:
    return count_open(ledger, BY_NAME[name], as_of)


def kpi_board(ledger: DataFrame, as_of: datetime, kpis: Sequence[c.TransportKpi] = c.TRANSPORT_KPIS) -> DataFrame:
    """All KPIs in one row, from one scan of the starts and one of the closings per key.

    Tokens are counted in two steps: per token first, where a token with very many starts
    is combined before the shuffle, then over the tokens.
    """
    flags = {kpi.name: F.coalesce(start_predicate(kpi, as_of), F.lit(False)) for kpi in kpis}
    any_kpi = F.lit(False)
    for flag in flags.values():
        any_kpi = any_kpi | flag
    # One distinct column for all KPIs that count distinct values.
    tokens = {kpi.distinct for kpi in kpis if kpi.distinct}
    if len(tokens) > 1:
        raise ValueError("the board counts distinct values of one column only")
    token = next(iter(tokens), None)
    # Stated apart from the KPIs' own conditions, so that the scan can skip by type and time.
    started = (F.col("typ_id") == c.EVENT_STARTED) & rolling_window(
        F.col("created"), as_of, max(kpi.days for kpi in kpis))
    rows = ledger.where(started).where(any_kpi).select(
        "transportlhmnr", "lhmnr", "zug_id", "created",
        (F.col(token) if token else F.lit(None).cast("string")).alias("token"),
        *[flag.alias(f"is_{name}") for name, flag in flags.items()])
    starts = rows
    for key in dict.fromkeys(kpi.key for kpi in kpis):
        done = closings(ledger, key, starts).select(
            key, "zug_id", F.col("done_at").alias(f"{key}_done_at"), F.col("blocked").alias(f"{key}_blocked"))
        rows = rows.join(done, [key, "zug_id"], "left")
    still_open = {
        kpi.name: F.col(f"is_{kpi.name}")
        & ~ended(kpi, F.col("created"), F.col(f"{kpi.key}_done_at"), F.col(f"{kpi.key}_blocked"))
        for kpi in kpis
    }
    per_token = rows.groupBy("token").agg(*[F.count_if(test).alias(name) for name, test in still_open.items()])
    totals = [
        (F.count_if(F.col("token").isNotNull() & (F.col(kpi.name) > 0)) if kpi.distinct
         else F.coalesce(F.sum(kpi.name), F.lit(0))).cast("bigint").alias(kpi.name)
        for kpi in kpis
    ]
    board = per_token.agg(*totals)
    return board.select(stamp(as_of).alias("last_updated"), *sorted(flags))


class KpiRegistry:
    """Named one-number queries; a site adds its own without touching the board."""

    def __init__(self) -> None:
        self._kpis: dict[str, Callable[[DataFrame, datetime], DataFrame]] = {}

    def register_kpi(self, name: str, build: Callable[[DataFrame, datetime], DataFrame]) -> None:
        self._kpis[name] = build

    def names(self) -> list[str]:
        return sorted(self._kpis)

    def snapshot(self, spark: SparkSession, ledger: DataFrame, as_of: datetime) -> DataFrame:
        """One row: time, one number per KPI in name order, and the names that failed with their errors.

        KPIs that cannot be built are told before anything runs; all others are one plan and one
        write, whose row is read back.  Only if that fails are they run one by one, to leave out those at fault.
        """
        built, failed = {}, {}
        for name in self.names():
            try:
                result = self._kpis[name](ledger, as_of)
                first = result.select(F.col(result.columns[0]).cast("double").alias("value")).limit(1)
                built[name] = first.agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("value"))
            except Exception as error:  # a site's KPI may fail in any way; the row says which one and how
                failed[name] = type(error).__name__
        try:
            return self._stored(spark, as_of, built, failed)
        except Exception:
            for name, frame in list(built.items()):
                try:
                    frame.write.format("noop").mode("overwrite").save()
                except Exception as error:
                    failed[name] = type(error).__name__
                    del built[name]
            return self._stored(spark, as_of, built, failed)

    def _stored(self, spark: SparkSession, as_of: datetime, built: dict[str, DataFrame], failed: dict[str, str]) -> DataFrame:
        texts = ",".join(f"{name}: {failed[name]}" for name in sorted(failed))
        rows = spark.range(1).select(F.lit(None).cast("string").alias("kpi"), F.lit(None).cast("double").alias("value"))
        for name, frame in built.items():
            rows = rows.unionByName(frame.select(F.lit(name).alias("kpi"), "value"))
        one = rows.agg(*[F.max(F.when(F.col("kpi") == name, F.col("value"))).alias(name) for name in self.names()])
        path = f"{shared_dir(spark)}/kpis-{uuid.uuid4().hex}"
        one.select(stamp(as_of).alias("last_updated"), *self.names(), F.lit(texts).alias("failed")).write.parquet(path)
        return spark.read.parquet(path)


def default_registry() -> KpiRegistry:
    registry = KpiRegistry()
    for kpi in c.TRANSPORT_KPIS:
        registry.register_kpi(kpi.name, lambda ledger, as_of, kpi=kpi: count_open(ledger, kpi, as_of))
    return registry
