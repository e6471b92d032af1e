"""The ways around very uneven keys give the same results as the plain ones."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palletrail import config as c
from palletrail.operators.congestion import FAN, interval_congestion, with_blocks
from palletrail.operators.legs import KEY, LegFilter, in_legs, number_dummies, out_legs, pair_legs, pair_totals, sorting_legs
from palletrail.operators.skew import broadcast_if_small, hot_keys, sequence_index
from palletrail.plans import receive, sorting
from tests.test_rules import ledger, leg


def uneven_ledger(spark, sorting_places=False):
    """A third of all legs share one transaction; carriers and attributes vary."""
    rng, legs = random.Random(7), []
    place = "IN_SZR_OV" if sorting_places else "OV01"
    for i in range(600):
        txn = "hot" if i % 3 == 0 else rng.choice([None, f"t{rng.randrange(150)}"])
        kind = rng.choice(["normal", "dummy"])
        data = ('{"QUALITYID_SEKTOR":"%d","SOURCEID_SEKTOR":"%s","DISTRIBUTIONCHANNELID_ART":"%d","CATEGORYID_ART":"%d",'
                '"SORTINGCRITERIAID_ART":"%d","REFERENCENUMBER_LHM":"R%d"}'
                % (rng.randrange(6), rng.choice(["1", "10", "11"]), rng.choice([3, 4, 8]), rng.randrange(3), rng.randrange(3), rng.randrange(3)))
        when = datetime(2025, 5, 1 + rng.randrange(3), 4) + timedelta(minutes=rng.randrange(1200))
        carrier = rng.choice(["41", "42", "501", "SPENDENLHM", "KF_OV1", "0001", "61", None])
        if rng.random() < 0.5:
            legs.append(leg(txn, rng.randrange(40), 120 if kind == "dummy" else 101, 614 if kind == "dummy" else 520, "2001", place,
                            "Overstock", carrier, -rng.randrange(1, 5), when, data))
        else:
            legs.append(leg(txn, rng.randrange(40), 101, 207 if kind == "dummy" else 520, "2002", place,
                            "SZROV", carrier, 1, when, data))
    return ledger(spark, *legs).cache()


@pytest.fixture(scope="module")
def uneven(spark):
    return uneven_ledger(spark)


def test_hot_keys_are_found(spark, uneven):
    assert hot_keys(uneven, KEY, 100) == ["hot"]
    assert hot_keys(uneven, KEY, 10_000) == []


@pytest.mark.parametrize("numeric", [False, True])
def test_counted_pairs_equal_built_pairs(spark, uneven, numeric):
    how = LegFilter()
    outs, ins = out_legs(uneven, how), in_legs(uneven, how)
    columns = ["good_type", "out_grade_sector", "in_source_id", "to_50"]
    built = pair_legs(outs, ins, numeric).groupBy(*columns).agg(F.sum("quantity").alias("q"), F.count("*").alias("n"))
    counted = (
        pair_totals(outs, ins, ["ziel"], columns[:2], columns[2:], {name: F.col(name) for name in columns}, numeric)
        .groupBy(*columns).agg(F.sum("quantity").alias("q"), F.sum("pairs").alias("n")).where("n > 0")
    )
    assert Counter(map(tuple, built.collect())) == Counter(map(tuple, counted.collect()))


@pytest.mark.parametrize("outs, ins", [(3, 3000), (3000, 3)])
def test_one_transaction_with_many_legs_on_either_side(spark, outs, ins):
    """Near-unique sorting ids on both legs; the rows on the way stay in proportion to the legs."""
    data = '{"SORTINGCRITERIAID_ART":"%d","QUALITYID_SEKTOR":"1"}'
    legs = [leg("hot", 1, 101, 520, "2001", "OV01", "Overstock", f"4{i}", -1, datetime(2025, 5, 1, 8), data % i) for i in range(outs)]
    legs += [leg("hot", 1, 101, 520, "2002", "OV01", "SZROV", f"6{i}", 1, datetime(2025, 5, 1, 8), data % (i + 50_000)) for i in range(ins)]
    rows = receive.shift_report(ledger(spark, *legs)).collect()
    assert len(rows) == outs and all(r["quantity"] == ins for r in rows)


def test_no_job_runs_when_a_report_is_built(spark, uneven):
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, "")
    try:
        for report in (receive.uph_kpis, receive.uph_kpis_by_user, receive.shift_report, receive.receive_volume):
            report(uneven)
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_numbering_in_pieces(spark):
    rows = spark.createDataFrame([("hot", random.Random(i).randrange(300), i) for i in range(400)] + [("few", 2, 1), ("few", None, 2)],
                                 "k string, at bigint, id int")
    order = [F.col("at").asc_nulls_last(), F.col("id")]
    plain = sequence_index(rows, "k", order, F.col("at"))
    pieces = sequence_index(rows, "k", order, F.col("at"), hot=["hot", "few"], step=50)
    assert Counter(map(tuple, plain.select("k", "id", "rn").collect())) == Counter(map(tuple, pieces.select("k", "id", "rn").collect()))


def test_sorting_report_with_a_hot_transaction(spark):
    frame = uneven_ledger(spark, sorting_places=True)
    usual, split = sorting.manual_sorting(frame).collect(), sorting.manual_sorting(frame, hot_rows=20).collect()
    assert usual and Counter(map(tuple, usual)) == Counter(map(tuple, split))
    outs, _ = sorting_legs(frame, LegFilter())
    assert number_dummies(outs, 20).count() == outs.count()


def test_large_tables_are_not_broadcast(spark):
    df = spark.range(100_000)
    assert "broadcast" not in broadcast_if_small(df, 1000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("first, last", [(0, 86399), (1, 1), (5, 4), (1023, 4097), (7, 30), (0, 0), (86398, 86399)])
def test_blocks_cover_a_window_once(spark, first, last):
    frame = spark.createDataFrame([(first, last)], "first bigint, last bigint")
    covered = Counter()
    for row in with_blocks(frame).where("block is not null").collect():
        size = FAN ** row["level"]
        covered.update(range(row["block"] * size, (row["block"] + 1) * size))
    assert covered == Counter(range(first, last + 1))


def test_congestion_against_brute_force(spark):
    rng = random.Random(3)
    days = [date(2025, 5, 1), date(2025, 5, 2)]
    places, types = ["AKL", "AKL G", "AKL_G", "GS", "PALL"], ["Outletbehälter", "Versandkarton"]
    moves = [(rng.choice(days), rng.choice([0, 10, 20, rng.randrange(86400)]), f"c{rng.randrange(6)}", rng.choice(places),
              rng.choice(["AKL", "ZU", "OL", "VD"]), rng.choice(types)) for _ in range(400)]
    windows = [(f"o{i}", rng.choice(days), *sorted((rng.choice([0, 10, rng.randrange(86400)]), rng.choice([10, 20, rng.randrange(86400)]))))
               for i in range(40)] + [("none", days[0], None, None), ("back", days[0], 500, 100), ("point", days[0], 10, 10)]
    got = interval_congestion(
        spark.createDataFrame(windows, "order_no string, day date, start int, end int"),
        spark.createDataFrame(moves, "day date, second int, carrier string, from_place string, to_place string, carrier_type string"),
        c.ROUTES)
    rows = {row["order_no"]: row for row in got.collect()}
    assert len(rows) == len(windows)
    for order, day, start, end in windows:
        for route in c.ROUTES:
            seen = {
                m[2] for m in moves if start is not None and m[0] == day
                and (start <= m[1] <= end if route.inclusive else start < m[1] < end)
                and route.from_place in (None, m[3]) and route.to_place in (None, m[4]) and route.carrier_type in (None, m[5])
            }
            assert rows[order][route.name] == len(seen), (order, route.name)
