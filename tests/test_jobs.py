"""Jobs run twice: what is stored equals the report of their window, and the summary tells its size."""

from collections import Counter
from datetime import date, datetime

from pyspark.sql import functions as F

from fixtures.views import spark_view
from palletrail import jobs
from palletrail.functions.times import run_month, run_window
from palletrail.operators.legs import LegFilter
from palletrail.plans import orders, outlet, receive
from palletrail.sources import sinks

SF_DIR = "/root/testdata/sf0.001"
NOW = datetime(2026, 1, 2)


def stored(spark, path, like):
    return Counter(map(tuple, sinks.read_stored(spark, path, like.schema.simpleString()[7:-1].replace(":", " ")).select(like.columns).collect()))


def test_nightly_jobs(spark, tmp_path):
    ledger = spark_view(spark, SF_DIR, "ledger")
    day = ledger.where("menge < 0 and ziel like 'OV%'").groupBy(F.to_date("created").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    how = LegFilter(start=run_window(day)[0], end=run_window(day)[1])
    for job, report, name in ((jobs.nightly_kpis, receive.uph_kpis, "uph_kpis"), (jobs.nightly_shift, receive.shift_report, "shift_report")):
        job(ledger, date(1990, 1, 1), str(tmp_path), NOW)
        first = job(ledger, day, str(tmp_path), NOW).first()
        again = job(ledger, day, str(tmp_path), NOW).first()
        wanted = report(ledger, how)
        assert stored(spark, f"{tmp_path}/{name}", wanted) == Counter(map(tuple, wanted.collect()))
        assert first == again and first["rows"] == wanted.count() > 0 and first["status"] == "SUCCESS"


def test_outlet_job(spark, tmp_path):
    ledger, stock = spark_view(spark, SF_DIR, "outlet"), spark_view(spark, SF_DIR, "stock")
    day = ledger.where("typ_id = 103").groupBy(F.to_date("created").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    jobs.nightly_outlet(ledger, stock, day, str(tmp_path), NOW)
    row = jobs.nightly_outlet(ledger, stock, day, str(tmp_path), NOW).first()
    wanted = outlet.outlet_booking(ledger, stock, *run_window(day))
    assert stored(spark, f"{tmp_path}/outlet_booking", wanted) == Counter(map(tuple, wanted.collect()))
    assert row["rows"] == wanted.count() and row["total"] == wanted.agg(F.sum("items")).first()[0]


def test_monthly_snapshot_keeps_one_version_back(spark, tmp_path):
    ledger, brands = spark_view(spark, SF_DIR, "ledger"), spark_view(spark, SF_DIR, "brand_dim")
    day = date(1997, 5, 5)
    for _ in range(2):
        row = jobs.monthly_snapshot(ledger, brands, "monthly_zfs", day, str(tmp_path), NOW).first()
    start, end, _ = run_month(day)
    wanted = receive.monthly_report(ledger, brands, jobs.c.MONTHLY_REPORTS["monthly_zfs"], LegFilter(start=start, end=end))
    kept = sinks.read_snapshots(spark, f"{tmp_path}/monthly")
    assert row["rows"] == wanted.count() == kept.where("version = 'current'").count() == kept.where("version = 'previous'").count()


def test_order_archive_grows_by_new_orders_only(spark, tmp_path):
    tables = [spark_view(spark, SF_DIR, name) for name in ("transport_log", "order_status", "order_monitor")]
    for _ in range(2):
        jobs.order_archive(*tables, str(tmp_path), NOW)
    archive = spark.read.parquet(f"{tmp_path}/orders")
    wanted = orders.order_duration(*tables).select("order_no").distinct().count()
    assert archive.count() == archive.select("order_no").distinct().count() == wanted
