"""Filter interaction audit: what each filter removes in every order, by paths through the lattice of subsets.

A state is the set of filters applied so far, an edge applies one more.  What an edge removes
depends on its state only, not on the order in which the state was reached; so each document is
counted once, under the set of filters it fails, and every edge is read from these counts.  The orders that
reach an edge's state (forward) times those that leave its end (backward) are the orders that use the edge: as
weights of what the edges of a filter remove they give its Shapley total, and each order's steps are read from
the same edges.

Nulls and edges: null text is empty; a null part is the empty part; rows without id are later
copies of any row with the same text and an id, and no copies of each other; rows that repeat an id are no copies of each other
either; of several labels of an id any that is 1 counts; an empty table has no parts and no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palletrail.llm.common import WORD, stored

MAX_FILTERS = 7  # orders times filters are listed


def quality_tests(text: Column, words: Column) -> dict[str, Column]:
    """The failure conditions of the text filters, by letter."""
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("bigint") > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def tested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", tests=quality_tests) -> DataFrame:
    """(id, part, text_hash, mask): the filters that each document fails by itself, bit ``i`` for the ``i``-th test."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    held = held.select("*", F.regexp_extract_all("text", F.lit(f"({WORD})"), 1).alias("words"))
    mask = F.lit(0)
    for i, failed in enumerate(tests(F.col("text"), F.col("words")).values()):
        mask = mask.bitwiseOR(F.when(failed, 1 << i).otherwise(0))
    return held.select("id", "part", F.unhex(F.sha2("text", 256)).alias("text_hash"), mask.alias("mask"))


def failure_cells(rows: DataFrame, labels: DataFrame, copy_bit: int, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters they fail, ``copy_bit`` for later copies of a text.

    Copies of a text are added up before they meet its smallest id, so that no text's copies
    come together in one task.
    """
    any_one = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0))
    told = labels.groupBy(F.col(id_col).alias("id")).agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic"))
    rows = rows.groupBy("id", "part", "text_hash", "mask").agg(F.count("*").alias("n"))
    rows = stored(rows.join(told, "id", "left").na.fill(0, ["good", "toxic"]), "audited")
    kind = ["part", "mask", "good", "toxic"]
    texts = rows.groupBy("text_hash", *kind).agg(F.sum("n").alias("n"), F.min("id").alias("id"))
    repeated = texts.groupBy("text_hash").agg(F.min("id").alias("first"), F.sum("n").alias("copies"))
    repeated = repeated.where("copies > 1 and first is not null").select(F.col("text_hash").alias("_hash"), "first")
    copies = texts.join(repeated, F.col("text_hash") == F.col("_hash")).select(*kind, "n")
    firsts = rows.join(repeated, (F.col("text_hash") == F.col("_hash")) & (F.col("id") == F.col("first"))).select(*kind, (-F.col("n")).alias("n"))
    later = copies.union(firsts)
    moved = later.select(*kind, (-F.col("n")).alias("n")).union(
        later.select("part", F.col("mask").bitwiseOR(F.lit(copy_bit)).alias("mask"), "good", "toxic", "n"))
    cells = texts.select(*kind, "n").union(moved).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return cells.where("n > 0")


def lattice(names: str) -> list[tuple[int, int, int, list[str]]]:
    """Edges (state, bit, ways, orders) of the lattice of subsets of ``names``.

    ``ways`` is the product of the orders that reach the state, summed up forward from the
    empty set, and of those that go on from the edge's end, summed up backward from the full set.
    """
    n = len(names)
    full = (1 << n) - 1
    forward, backward = [1] + [0] * full, [0] * full + [1]
    for state in range(1 << n):
        for i in range(n):
            if not state >> i & 1:
                forward[state | 1 << i] += forward[state]
    for state in reversed(range(1 << n)):
        for i in range(n):
            if state >> i & 1:
                backward[state & ~(1 << i)] += backward[state]
    orders: dict[tuple[int, int], list[str]] = {}
    for order in permutations(range(n)):
        state = 0
        for i in order:
            orders.setdefault((state, 1 << i), []).append("".join(names[k] for k in order))
            state |= 1 << i
    return [(state, bit, forward[state] * backward[state | bit], found) for (state, bit), found in sorted(orders.items())]


def order_steps(cells: DataFrame, names: str) -> DataFrame:
    """(part, filter_order, step, filter, ...) from counts by failed set (part, mask, n, good, toxic)."""
    if len(names) > MAX_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"at most {MAX_FILTERS} filters, named by different letters")
    # At most one cell per subset of the filters.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    edges = F.array(*[F.struct(
        F.lit(state).alias("state"), F.lit(bit).alias("bit"), F.lit(ways).cast("bigint").alias("ways"), F.lit(orders).alias("orders"),
        F.lit(state.bit_count() + 1).alias("step"), F.lit(names[bit.bit_length() - 1]).alias("filter"))
        for state, bit, ways, orders in lattice(names)])
    at = parts.select("part", "cells", F.explode(edges).alias("e")).select("part", "cells", "e.*")
    state, bit = F.col("state"), F.col("bit")

    def total(which, value: str = "n") -> Column:
        return F.aggregate(F.filter("cells", lambda c: which(c["mask"])), F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c[value])

    fails, seen = lambda m: m.bitwiseAND(bit) != 0, lambda m: m.bitwiseAND(state) != 0
    gone = lambda m: fails(m) & ~seen(m)
    at = at.select(
        "part", "filter", "step", "ways", "orders",
        total(lambda m: ~fails(m) & ~seen(m)).alias("kept"), total(gone).alias("removed"),
        total(lambda m: fails(m) & seen(m)).alias("redundant"), total(lambda m: m == bit).alias("unique_fails"),
        total(gone, "good").alias("good_lost"), total(gone, "toxic").alias("toxic_lost"))
    shapley = F.sum(F.col("ways") * F.col("removed")).over(Window.partitionBy("part", "filter")).alias("shapley")
    at = at.select("*", shapley)
    return at.select("part", F.explode("orders").alias("filter_order"), "step", "filter", "kept", "removed", "redundant",
                     "unique_fails", "good_lost", "toxic_lost", "shapley")


def interaction_audit(docs: DataFrame, labels: DataFrame, copy_filter: str = "E", id_col: str = "doc_id", text_col: str = "text",
                      part_col: str = "lang", tests=quality_tests) -> DataFrame:
    """What every filter keeps, removes and would lose per part, order and step; ``copy_filter`` removes later copies of a text."""
    names = "".join(tests(F.col(text_col), F.array())) + copy_filter
    cells = failure_cells(tested(docs, id_col, text_col, part_col, tests), labels, 1 << (len(names) - 1), id_col)
    return order_steps(cells, names)
