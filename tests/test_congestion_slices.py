"""A day with very many movements is counted in slices of its carriers."""

import random
from collections import defaultdict
from datetime import date

from palletrail import config as c
from palletrail.operators.congestion import interval_congestion

DAY = date(2025, 5, 1)
EVENTS = "day date, second int, carrier string, from_place string, to_place string, carrier_type string"


def test_slices_of_a_day_add_up(spark):
    rng = random.Random(11)
    moves = [(DAY, rng.randrange(500), rng.choice([None, *[f"c{i}" for i in range(30)]]), "AKL G", "AKL", "Outletbehälter") for _ in range(900)]
    moves += [(DAY, 250, "c1", "AKL G", "AKL", "Outletbehälter")] * 50 + [(None, 5, "c1", "AKL G", "AKL", "Outletbehälter")]
    windows = [(f"o{i}", DAY, *sorted((rng.randrange(-3, 500), rng.randrange(510)))) for i in range(60)] + [("no", None, 1, 400)]
    frames = (spark.createDataFrame(windows, "order_no string, day date, start int, end int"), spark.createDataFrame(moves, EVENTS).repartition(3))
    whole, sliced = ({row["order_no"]: row for row in interval_congestion(*frames, c.ROUTES, slice_rows=n).collect()} for n in (10**9, 100))
    assert whole == sliced and len(whole) == len(windows)
    seen = defaultdict(set)
    for order, day, start, end in windows:
        for _, second, carrier, *_ in (m for m in moves if m[0] == day and day is not None):
            if start <= second <= end:
                seen[order, "aklg_any_out"].add(carrier)
            if start < second < end:
                seen[order, "any_to_akl"].add(carrier)
    for order, row in sliced.items():
        assert all(row[name] == len(seen[order, name]) for name in ("aklg_any_out", "any_to_akl")), order


def test_movements_travel_once(spark):
    """No row per level of a tree: movements are dealt out by day once, and windows are not cut into blocks."""
    windows = spark.createDataFrame([("o", DAY, 1, 9)], "order_no string, day date, start int, end int")
    events = spark.createDataFrame([(DAY, 5, "c", "GS", "AKL", "Outletbehälter")], EVENTS)
    plan = interval_congestion(windows, events, c.ROUTES)._jdf.queryExecution().executedPlan().toString()
    with_movements = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "slice" in line and "REPARTITION" in line]
    assert len(with_movements) == 1 and "level" not in plan
