"""Legs are sorted by transaction before they are met; the two kinds of goods only settle ties."""

import re

import pytest

from palletrail.operators.legs import LegFilter, in_legs, out_legs, pair_legs, pair_legs_sequenced, pair_totals
from pyspark.sql import functions as F
from tests.test_skew import uneven_ledger


@pytest.mark.parametrize("kind", ["pairs", "totals", "sequenced"])
def test_the_transaction_is_the_first_sort_column(spark, kind):
    frame = uneven_ledger(spark)
    outs, ins = out_legs(frame, LegFilter()), in_legs(frame, LegFilter())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = {"pairs": lambda: pair_legs(outs, ins),
                "totals": lambda: pair_totals(outs, ins, ["ziel"], ["out_grade_sector"], [], {"grade": F.col("out_grade_sector")}),
                "sequenced": lambda: pair_legs_sequenced(frame, LegFilter())}[kind]()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    met = re.findall(r"SortMergeJoin \[([a-z_]+)#\d+, ([a-z_]+)#", plan)
    assert met and all(first == "local_transaction_id" for first, _ in met), met
