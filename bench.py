"""Time the headline reports and print one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) names the tables, ``BENCH_CPUS`` the
local cores.  The input tables of a report are derived and stored before its time is taken.
Every report runs once on the smaller tables first, so that the JVM has compiled its code;
the timed run then writes the full result to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from fixtures.registry import QUERIES, VIEWS_OF
from fixtures.views import stored_view
from palletrail.session import build_session

HEADLINE = (
    "uph_kpis", "uph_kpis_by_user", "shift_report", "booking_detail", "booking_detail_numeric", "manual_sorting",
    "monthly_zfs", "monthly_beauty", "receive_volume", "outlet_booking", "outlet_booking_simple", "inbound_lines",
    "sorter_volume", "kpi_board", "open_orders", "bgl_bsf_ov", "hazard_stock", "hazard_compliance", "quality_score",
    "order_duration", "run_summary", "notification_outbox",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = Path(sf_dir).parent / "sf0.01"
    times = {}
    for name in names:
        if warm_dir.is_dir():
            run(spark, name, str(warm_dir))
        for view in VIEWS_OF.get(name, ()):
            stored_view(spark, sf_dir, view)
        times[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_reports_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
