"""How many distinct carriers moved on a route while an order was open.

Building every (order, movement) pair grows with the product of both, which a busy day
does not forgive.  Here the pairs are counted without being built.

A carrier counts once per window: at its first movement inside, which is the movement
whose previous one (same day, route and carrier) is not inside.  So the number asked for
is the number of movements with a time inside the window and a previous time before it.
Every movement before the window has its previous one before it too, so this is the number up to the
window's end with a previous time before the window, less the number before the window.

Movements travel once, to the group of their day, and are sorted once.  A day with very many movements
is several groups, each with some of the carriers, whose counts add up; a group holds about ``SLICE`` movements.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from palletrail.config import Route

SLICE = 500_000
SHIFT = 3
FAN = 1 << SHIFT
LEVELS = 6  # FAN ** LEVELS > 86400 + 2
BLOCK = ["day", "level", "block"]


def _span(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def each_level(df: DataFrame) -> DataFrame:
    return df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))


def with_blocks(windows: DataFrame) -> DataFrame:
    """Blocks that together exactly cover the seconds ``first`` to ``last`` of each row.

    Of each level, those whole blocks are taken that no whole block of the next level
    covers.  A row that covers no second at all keeps one row without a block.
    """
    bounds = each_level(windows).withColumns({
        "_low": F.expr(f"shiftright(first + shiftleft(1L, {SHIFT} * level) - 1, {SHIFT} * level)"),
        "_high": F.expr(f"shiftright(last + 1, {SHIFT} * level) - 1"),
        "_up_low": F.expr(f"shiftright(first + shiftleft(1L, {SHIFT} * (level + 1)) - 1, {SHIFT} * (level + 1)) * {FAN}"),
        "_up_high": F.expr(f"shiftright(last + 1, {SHIFT} * (level + 1)) * {FAN} - 1"),
    })
    low, high, up_low, up_high = (F.col(name) for name in ("_low", "_high", "_up_low", "_up_high"))
    edges = F.concat(_span(low, up_low - 1), _span(up_high + 1, high))
    blocks = F.when(up_low <= up_high, edges).otherwise(_span(low, high))
    return (
        bounds.withColumn("block", F.explode_outer(blocks))
        .where("block is not null or level = 0")
        .drop("_low", "_high", "_up_low", "_up_high")
    )


def route_test(route: Route) -> Column:
    test = F.lit(True)
    for column, value in (("from_place", route.from_place), ("to_place", route.to_place),
                          ("carrier_type", route.carrier_type)):
        if value is not None:
            test = test & (F.col(column) == value)
    return test


def _movements(events: DataFrame, routes: Sequence[Route]) -> DataFrame:
    """Movements per day, carrier and number of a route; a movement may be on several."""
    numbers = F.array_compact(F.array(*[F.when(route_test(route), F.lit(i)) for i, route in enumerate(routes)]))
    moves = events.where("day is not null and second is not null")
    return moves.select("day", "carrier", F.col("second").cast("int").alias("second"), F.explode(numbers).alias("route"))


def counter(routes: Sequence[Route]) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Counts of a group's movements in the windows of its day.  All that tasks need is inside, so that they import nothing of this package."""
    names, inclusive = [route.name for route in routes], [route.inclusive for route in routes]

    def lower_among(ranks: np.ndarray, upto: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of the first ``upto`` of the ranks 0, 1, ... (in any order) are below ``limit``: one stable partition per bit."""
        low, high, found = np.zeros_like(upto), upto.copy(), np.zeros_like(upto)
        for bit in reversed(range(int(len(ranks)).bit_length())):
            unset = (ranks >> bit) & 1 == 0
            before = np.concatenate([[0], np.cumsum(unset)])
            low_unset, high_unset, above = before[low], before[high], (limit >> bit) & 1 == 1
            found += np.where(above, high_unset - low_unset, 0)
            low = np.where(above, before[-1] + low - low_unset, low_unset)
            high = np.where(above, before[-1] + high - high_unset, high_unset)
            ranks = np.concatenate([ranks[unset], ranks[~unset]])
        return found

    def counted(_: tuple, moves: pd.DataFrame, windows: pd.DataFrame) -> pd.DataFrame:
        result, start, end = windows[["day", "start", "end"]].copy(), windows["start"].to_numpy("int64"), windows["end"].to_numpy("int64")
        route, second, previous = (moves[name].to_numpy("int64") for name in ("route", "second", "previous"))
        for i, name in enumerate(names):
            first, last = (start, end) if inclusive[i] else (start + 1, end - 1)
            ours = np.flatnonzero(route == i)
            ours = ours[np.argsort(second[ours], kind="stable")]
            seconds, order = second[ours], np.argsort(previous[ours], kind="stable")
            ranks = np.empty(len(ours), "int64")
            ranks[order] = np.arange(len(ours))
            upto = np.searchsorted(seconds, last, "right")
            new = lower_among(ranks, upto, np.searchsorted(previous[ours][order], first, "left"))
            result[name] = np.maximum(new - np.searchsorted(seconds, first, "left"), 0)
        return result

    return counted


def interval_congestion(windows: DataFrame, events: DataFrame, routes: Sequence[Route], slice_rows: int = SLICE) -> DataFrame:
    """Add one count per route to ``windows``, whose rows must be distinct.

    ``windows``: ``day``, ``start`` and ``end`` in seconds of the day, and what names the window.
    ``events``: ``day``, ``second``, ``carrier``, ``from_place``, ``to_place``, ``carrier_type``.
    Bounds are excluded, or included for routes that say so.
    """
    names, bounds = [route.name for route in routes], ["day", "start", "end"]
    moves = _movements(events, routes)
    # One row per day that has movements: small, whatever they are.
    days = F.broadcast(moves.groupBy("day").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices")))
    dealt = moves.join(days, "day").select(
        "day", F.pmod(F.xxhash64("carrier"), "slices").cast("int").alias("slice"), "route", "carrier", "second")
    # The window's rows are those of a group already, so that nothing is shuffled or sorted for it again.
    before = Window.partitionBy("day", "slice", "route", "carrier").orderBy("second")
    movements = (
        dealt.repartition("day", "slice").withColumn("previous", F.lag("second").over(before))
        .where("previous is null or previous < second")  # the same second again is the same movement
        .select("day", "slice", "route", "second", F.coalesce("previous", F.lit(-(1 << 31))).alias("previous"))
    )
    spans = windows.select("day", *[F.col(name).cast("int").alias(name) for name in ("start", "end")]).where(
        "day is not null and start is not null and `end` is not null").distinct()
    asked = spans.join(days, "day").select(*bounds, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))

    schema = ", ".join([f"day {dict(windows.dtypes)['day']}", "start int", "`end` int", *[f"`{name}` bigint" for name in names]])
    parts = movements.groupBy("day", "slice").cogroup(asked.groupBy("day", "slice")).applyInPandas(counter(routes), schema)
    answers = parts.groupBy(*bounds).agg(*[F.sum(name).alias(name) for name in names])
    return windows.join(answers, bounds, "left").select(
        *windows.columns, *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in names])
