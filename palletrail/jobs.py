"""The runs of a site: window, report, a load that may be repeated, and the figures of the run.

Every job returns one summary row, with the figures that the report's write observed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from palletrail import config as c
from palletrail.functions.times import run_month, run_window
from palletrail.operators.legs import LegFilter
from palletrail.plans import orders, outlet, receive
from palletrail.plans.summary import summary_row, write_observed
from palletrail.sources import sinks


def _loaded(name: str, report: DataFrame, measure: str | None, folder: str, run_time: datetime,
            load: Callable[[DataFrame], None]) -> DataFrame:
    """Load the report and say how many rows it had and what they add up to.

    The report is staged first: it runs once, its figures are taken while it is written, and a
    run that fails in it leaves the loaded table as it was.
    """
    spark, path = report.sparkSession, f"{folder}/staged/{name}-{uuid.uuid4().hex}"
    seen = write_observed(report, measure, path)
    load(spark.read.schema(report.schema).parquet(path))
    counted = spark.range(1).select(*[F.lit(seen[key]).cast(kind).alias(key) for key, kind in (("rows", "bigint"), ("total", "double"))])
    return summary_row(name, counted, run_time)


def _day(day: date) -> LegFilter:
    start, end = run_window(day)
    return LegFilter(start=start, end=end)


def nightly_kpis(ledger: DataFrame, day: date, folder: str, run_time: datetime) -> DataFrame:
    """Receive KPIs of a day; a back-fill is the same call with an earlier day."""
    return _loaded("uph_kpis", receive.uph_kpis(ledger, _day(day)), None, folder, run_time,
                   lambda rows: sinks.replace_by_key(rows, f"{folder}/uph_kpis", "date"))


def nightly_shift(ledger: DataFrame, day: date, folder: str, run_time: datetime) -> DataFrame:
    return _loaded("shift_report", receive.shift_report(ledger, _day(day)), "quantity", folder, run_time,
                   lambda rows: sinks.replace_by_key(rows, f"{folder}/shift_report", "date"))


def nightly_outlet(ledger: DataFrame, stock: DataFrame, day: date, folder: str, run_time: datetime) -> DataFrame:
    start, end = run_window(day)
    return _loaded("outlet_booking", outlet.outlet_booking(ledger, stock, start, end), "items", folder, run_time,
                   lambda rows: sinks.replace_by_key(rows, f"{folder}/outlet_booking", "date"))


def monthly_snapshot(ledger: DataFrame, brands: DataFrame, name: str, day: date, folder: str, run_time: datetime) -> DataFrame:
    """A monthly report of the month around ``day``; the version before it is kept."""
    start, end, month = run_month(day)
    report = receive.monthly_report(ledger, brands, c.MONTHLY_REPORTS[name], LegFilter(start=start, end=end))
    return _loaded(name, report, None, folder, run_time, lambda rows: sinks.rotate_snapshot(rows, f"{folder}/monthly", name, month))


def order_archive(transport_log: DataFrame, order_status: DataFrame, order_monitor: DataFrame, folder: str,
                  run_time: datetime) -> DataFrame:
    """Orders that the archive does not have yet."""
    report = orders.order_duration(transport_log, order_status, order_monitor)
    order = [F.asc_nulls_last("date"), F.asc_nulls_last("station")]
    return _loaded("order_duration", report, None, folder, run_time,
                   lambda rows: sinks.append_new_keys(rows, f"{folder}/orders", "order_no", order))
