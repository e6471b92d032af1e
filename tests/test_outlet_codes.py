"""Outlet items are sorted and met by a number first; the stock grades are shuffled once for both kinds of items."""

import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from palletrail.plans import outlet

LEDGER = ("typ_id int, tpartnr int, sequence long, lhmnr string, artnr string, ziel string, menge int, "
          "created timestamp_ntz, cust_data string")
AT = datetime(2024, 1, 31, 8)


def document(category, grade=None):
    return f'{{"CATEGORYID_ART":"{category}","SORTINGCRITERIAID_ART":"s{category}"' + (f',"QUALITYID_SEKTOR":"{grade}"}}' if grade else "}")


@pytest.fixture
def tables(spark):
    rows = []
    for carrier in ("4a", "4b", "5a", "9a", None):
        for article in ("1", "2", None):
            rows += [(103, 202, 1, carrier, article, "OV01", 5, AT, document(1)), (103, 202, 2, carrier, article, "OV01", 4, AT, document(2)),
                     (102, 402, 3, carrier, article, "OV01", -2, AT, document(1, 3 if article == "1" else None)),
                     (120, 614, 4, carrier, article, "OV01", -1, AT, document(1, 4))]
    stock = [("4a", "5a", "1", "B"), ("4a", None, "2", None), ("4a", "4b", "2", "A"), ("4b", None, None, "C"), ("9a", None, "1", "A")]
    return spark.createDataFrame(rows, LEDGER), spark.createDataFrame(stock, "mainlhm string, sublhm string, artnr string, quality string")


def rows(frame):
    return Counter(map(tuple, frame.collect()))


def test_items_with_one_code_stay_apart(tables, monkeypatch):
    wanted = {name: rows(getattr(outlet, name)(*tables)) for name in ("outlet_booking", "outlet_booking_simple")}
    history, net = rows(outlet.graded_history(tables[0])), rows(outlet.booked_and_clarified(tables[0], None, None))
    monkeypatch.setattr(outlet, "item_code", lambda *_: F.lit(7).cast("bigint"))
    assert wanted == {name: rows(getattr(outlet, name)(*tables)) for name in wanted}
    assert history == rows(outlet.graded_history(tables[0]))
    assert net == rows(outlet.booked_and_clarified(tables[0], None, None))


def test_report(tables):
    found = rows(outlet.outlet_booking_simple(*tables).where("lhm = '4a'"))
    day = ("2024-01-31", 1, "4a")
    assert found == Counter({
        (*day, "Textil", "s2", "B", "No", 7): 1,  # article 1: grade of the stock
        (*day, "Textil", "s2", None, "No", 9): 1,  # no article: meets no clarification, history or stock
        (*day, "Textil", "s2", "D", "No", 7): 1,  # article 2: the stock has no grade, so the history's
        (*day, "Schuhe", "s1", "B", "Yes", 2): 1,
        (*day, "Schuhe", "s1", None, "Yes", 4): 1,  # articles 2 and none, without a grade
    })


def test_the_code_sorts_first_and_stock_grades_are_shared(spark, tables, tmp_path):
    read = []
    for name, table in zip(("ledger", "stock"), tables):
        table.write.parquet(f"{tmp_path}/{name}")
        read.append(spark.read.parquet(f"{tmp_path}/{name}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = outlet.outlet_booking_simple(*read)
        plan = report._jdf.queryExecution().executedPlan().toString()
        met = re.findall(r"SortMergeJoin \[(\w+)#\d+L?, ", plan)
        assert len(met) == 3 and set(met) == {"item"}, met
        assert re.findall(r"SortAggregate\(key=\[(\w+)#", plan) == ["item", "item"]
        report.collect()
        assert "ReusedExchange" in report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
