"""Sums over pairs: transactions with few legs are paired, those with many are counted."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from palletrail.operators.legs import KEY, LegFilter, hot_buckets, in_legs, out_legs, pair_legs, pair_totals
from tests.test_skew import uneven_ledger

COLUMNS = ["good_type", "out_grade_sector", "in_source_id", "to_50"]


def sums(rows, n):
    return Counter(map(tuple, rows.groupBy("ziel", *COLUMNS).agg(F.sum("quantity").alias("q"), n.alias("n")).where("n > 0").collect()))


@pytest.mark.parametrize("numeric", [False, True])
@pytest.mark.parametrize("hot_legs", [1, 8, 100, 10**9])
def test_any_split_gives_the_same_sums(spark, numeric, hot_legs):
    frame = uneven_ledger(spark)
    outs, ins = out_legs(frame, LegFilter()), in_legs(frame, LegFilter())
    wanted = sums(pair_legs(outs, ins, numeric), F.count("*"))
    totals = pair_totals(outs, ins, ["ziel"], COLUMNS[:2], COLUMNS[2:], {name: F.col(name) for name in COLUMNS}, numeric, hot_legs)
    assert wanted and sums(totals, F.sum("pairs")) == wanted


def test_hot_transactions_are_found_exactly(spark):
    frame = uneven_ledger(spark)
    outs, ins = out_legs(frame, LegFilter()), in_legs(frame, LegFilter())
    most = outs.select(KEY).unionByName(ins.select(KEY)).groupBy(KEY).count().orderBy(F.desc("count")).first()["count"]
    assert hot_buckets(outs, ins, most).count() == 1 and hot_buckets(outs, ins, most + 50).count() == 0


def test_usual_legs_are_shuffled_once_a_side(spark):
    """With no transaction of many legs, only the legs and the bucket sizes travel."""
    frame = uneven_ledger(spark)
    outs, ins = out_legs(frame, LegFilter()), in_legs(frame, LegFilter())
    totals = pair_totals(outs, ins, ["ziel"], COLUMNS[:2], COLUMNS[2:], {name: F.col(name) for name in COLUMNS}, hot_legs=10**9)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals.collect()
        plan = totals._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) <= 3, plan
