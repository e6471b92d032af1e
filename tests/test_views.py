"""Derived tables: what travels while they are made, and how many tasks make them."""

import glob

import pytest

from fixtures import views
from palletrail.session import shared_dir

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["ledger", "outlet", "inbound", "transport"])
def test_raw_rows_travel_and_not_those_of_the_view(spark, name):
    plan = views.derive_view(spark, SF_DIR, name)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffles and all("rangepartitioning" in line and "created" not in line for line in shuffles), shuffles


def test_tasks_grow_in_number_and_not_in_size(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    monkeypatch.setattr(views, "RAW_ROWS", rows // 20)
    assert views.derive_view(spark, SF_DIR, "inbound").rdd.getNumPartitions() >= 20


def test_a_join_of_raw_tables_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.derive_view(spark, SF_DIR, "order_monitor")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_batch_is_written_by_as_many_tasks_as_read_the_view(spark):
    key = "spark.sql.files.openCostInBytes"  # so that few small files are not one task
    spark.conf.set(key, str(128 << 20))
    try:
        view = views.spark_view(spark, SF_DIR, "ledger")
        tasks = min(len(view.inputFiles()), view.rdd.getNumPartitions())
        before = set(glob.glob(f"{shared_dir(spark)}/stream-*"))
        views.stream_view(spark, SF_DIR, "ledger", "sequence", deliveries=2)
        [path] = set(glob.glob(f"{shared_dir(spark)}/stream-*")) - before
        wanted = sorted(map(tuple, view.collect()), key=str)
        for delivery in range(2):
            written = [glob.glob(f"{path}/{delivery}-{batch}/*.parquet") for batch in range(3)]
            assert tasks > 3 and [len(files) for files in written] == [tasks] * 3
            assert sorted(map(tuple, spark.read.parquet(*sum(written, [])).collect()), key=str) == wanted
    finally:
        spark.conf.unset(key)
