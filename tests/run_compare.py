"""Compare all or the named queries: ``python -m tests.run_compare [sf_dir] [name ...]``."""

import os
import sys
import time
import traceback

from __spark_entry__ import oracle_sql, queries
from palletrail.session import build_session
from tests.compare import compare


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("compare", f"local[{os.environ.get('TEST_CPUS', '8')}]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                    "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    names, bad = sys.argv[2:] or list(queries()), 0
    for name in names:
        start = time.time()
        try:
            found = compare(spark, queries(), oracle_sql(), name, sf_dir)
        except Exception:
            found = traceback.format_exc()[-1500:]
        bad += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if found is None else found[:1800]}"
              f"{'' if name in oracle_sql() else ' (rows only)'}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
