"""Levels of the stock drill-down."""

from palletrail.plans import hazard

SCHEMA = "carrier string, artnr string, volume double"


def test_levels_equal_a_rollup_and_keep_missing_names_apart(spark):
    rows = [("a", "1", 1.0), ("a", "1", 2.0), ("a", None, 4.0), (None, "1", 8.0), (None, None, 16.0), ("b", "2", None)]
    got = hazard.drill_down(spark.createDataFrame(rows, SCHEMA))
    assert got.dtypes == [("carrier", "string"), ("artnr", "string"), ("level", "bigint"), ("volume", "double")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("a", "1", 0, 3.0), ("a", None, 0, 4.0), (None, "1", 0, 8.0), (None, None, 0, 16.0), ("b", "2", 0, None),
        ("a", None, 1, 7.0), (None, None, 1, 24.0), ("b", None, 1, None), (None, None, 3, 31.0)], key=str)
    assert hazard.drill_down(spark.createDataFrame([], SCHEMA)).collect() == []


def test_finest_groups_are_not_held_again(spark):
    plan = hazard.drill_down(spark.createDataFrame([("a", "1", 1.0)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
