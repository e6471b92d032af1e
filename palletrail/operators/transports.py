"""Transports that were started and not finished."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from palletrail import config as c
from palletrail.functions.predicates import nullable_exclude, rolling_window


def start_predicate(kpi: c.TransportKpi, as_of: datetime | None) -> Column:
    """The rows a KPI counts as starts; without ``as_of`` regardless of their age."""
    test = F.col("typ_id") == c.EVENT_STARTED
    for column, pattern in kpi.like.items():
        test = test & F.col(column).like(pattern)
    for column, value in kpi.equal.items():
        test = test & (F.col(column) == value)
    if kpi.exclude_area:
        test = test & nullable_exclude(F.col("lagbez"), kpi.exclude_area)
    if as_of is not None:
        test = test & rolling_window(F.col("created"), as_of, kpi.days)
    return test


def closings(ledger: DataFrame, key: str, starts: DataFrame, done_only: bool = False) -> DataFrame:
    """Latest completion and whether there was a block, per carrier and lifecycle of ``starts``.

    Both lists come from one scan.  The starts are of a few days and closings of all time, so
    closings of other carriers and lifecycles are left out before anything is summed up.
    """
    events = [c.EVENT_DONE] if done_only else [c.EVENT_DONE, c.EVENT_BLOCKED]
    wanted = starts.select(key, "zug_id").distinct()
    return (
        ledger.where(F.col("typ_id").isin(*events) & F.col(key).isNotNull() & F.col("zug_id").isNotNull())
        .join(wanted, [key, "zug_id"], "left_semi")
        .groupBy(key, "zug_id")
        .agg(
            F.max(F.when(F.col("typ_id") == c.EVENT_DONE, F.col("created"))).alias("done_at"),
            F.max(F.col("typ_id") == c.EVENT_BLOCKED).alias("blocked"),
        )
    )


def ended(kpi: c.TransportKpi, created: Column, done_at: Column, blocked: Column) -> Column:
    """Whether a start is over, given what is known of its carrier and lifecycle."""
    if kpi.closing == "done":
        return done_at.isNotNull()
    by_block = F.coalesce(blocked, F.lit(False))
    if kpi.closing == "done_or_blocked":
        return done_at.isNotNull() | by_block
    return F.coalesce(done_at > created, F.lit(False)) | by_block


def open_starts(ledger: DataFrame, kpi: c.TransportKpi, as_of: datetime | None) -> DataFrame:
    """Starts of a KPI that nothing has ended: a single anti join against the closings."""
    rows = ledger.where(start_predicate(kpi, as_of))
    starts = rows.alias("s")
    done = closings(ledger, kpi.key, rows, done_only=kpi.closing == "done").alias("d")
    same = (F.col(f"s.{kpi.key}") == F.col(f"d.{kpi.key}")) & (F.col("s.zug_id") == F.col("d.zug_id"))
    if kpi.closing == "done_later_or_blocked":
        same = same & ended(kpi, F.col("s.created"), F.col("d.done_at"), F.col("d.blocked"))
    return starts.join(done, same, "left_anti")


def count_open(ledger: DataFrame, kpi: c.TransportKpi, as_of: datetime) -> DataFrame:
    """The KPI as one number: open starts, or distinct values of a column among them."""
    rows = open_starts(ledger, kpi, as_of)
    number = F.countDistinct(kpi.distinct) if kpi.distinct else F.count("*")
    return rows.agg(number.alias(kpi.name))
