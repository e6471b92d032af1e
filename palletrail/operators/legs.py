"""Book-out and book-in legs of the ledger and their pairing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from palletrail import config as c
from palletrail.functions.attributes import json_fields
from palletrail.functions.predicates import between_window, keep, ref_filter, self_transfer_drop
from palletrail.operators.skew import HOT_ROWS, hot_keys, sequence_index

KEY = "local_transaction_id"
# What legs are met by.  The transaction is first: sorts compare the first column by its prefix, and there are two kinds only.
PAIR = [KEY, "good_type"]
BUCKETS = 1 << 20
HOT_LEGS = 1_000

# Attributes a report needs from either leg.
OUT_ATTRIBUTES = ("reference", "grade_sector", "sortable", "category_id", "source_id",
                  "channel_id", "sku", "sort_id", "last_ean")
IN_ATTRIBUTES = ("grade_article", "sortable", "category_id", "source_id", "channel_id",
                 "sku", "sort_id")


@dataclass(frozen=True)
class LegFilter:
    """Which ledger rows are legs, and which of them a run reports."""

    areas: Sequence[str] | None = c.RECEIVE_AREAS
    target: str | None = c.RECEIVE_TARGET
    start: datetime | None = None
    end: datetime | None = None
    reference: str | None = None
    window_both_legs: bool = False


def scan_conditions(how: LegFilter) -> dict[str, Callable[[Column], Column]]:
    """What both legs of a report ask of text columns, for ``readers.read_ledger`` to put to the scan.

    Only out legs and arrivals of dummy goods are held to the target places, so these are not among the conditions.
    """
    return {"lagbez": lambda column: column.isin(*how.areas)} if how.areas else {}


def good_type() -> Column:
    """NORMAL and DUMMY goods are told apart by the process code."""
    return F.when(F.col("tpartnr") == c.NORMAL, F.lit("NORMAL")).otherwise(F.lit("DUMMY"))


def out_legs(ledger: DataFrame, how: LegFilter, attributes: Sequence[str] = OUT_ATTRIBUTES) -> DataFrame:
    """Book-out legs: negative quantity, from a receive area, towards the target places."""
    rows = keep(
        ledger.where(F.col("tpartnr").isin(c.NORMAL, c.DUMMY_OUT) & (F.col("menge") < 0)),
        F.col("lagbez").isin(*how.areas) if how.areas else None,
        F.col("ziel").like(how.target) if how.target else None,
        between_window(F.col("created"), how.start, how.end),
    )
    rows = json_fields(rows, attributes)
    rows = keep(rows, ref_filter(F.col("reference"), how.reference)) if how.reference else rows
    return rows.select(
        KEY, good_type().alias("good_type"), "created", "artnr", "ziel", "createdby",
        F.col("lhmnr").alias("source_lhm"), F.abs("menge").cast("bigint").alias("quantity"),
        *[F.col(name).alias(f"out_{name}") for name in attributes],
    )


def in_legs(ledger: DataFrame, how: LegFilter, attributes: Sequence[str] = IN_ATTRIBUTES) -> DataFrame:
    """Book-in legs: one piece, in a receive area, on a real load carrier.

    Only arrivals of dummy goods are held to the target places.
    """
    arrives = (F.col("tpartnr") == c.NORMAL) | (
        (F.col("tpartnr") == c.DUMMY_IN) & (F.col("ziel").like(how.target) if how.target else F.lit(True)))
    rows = keep(
        ledger.where(arrives & (F.col("menge") == 1) & ~F.col("lhmnr").like("000%")),
        F.col("lagbez").isin(*how.areas) if how.areas else None,
        between_window(F.col("created"), how.start, how.end) if how.window_both_legs else None,
    )
    rows = json_fields(rows, attributes)
    return rows.select(
        KEY, good_type().alias("good_type"), F.col("lhmnr").alias("ziel_lhm"),
        *[F.col("lhmnr").like(pattern).alias(flag) for pattern, flag in c.TARGET_PATTERNS.items()],
        F.col("lhmnr").rlike("^[0-9]+$").alias("to_numeric"),
        *[F.col(name).alias(f"in_{name}") for name in attributes],
    )


def pair_legs(outs: DataFrame, ins: DataFrame, numeric_target: bool = False) -> DataFrame:
    """Out legs with the in legs of the same transaction; one row per pair.

    Normal goods without an arrival stay, with an empty target; dummy goods without one
    are dropped.  With ``numeric_target`` only arrivals on all-digit carriers count, which
    drops the unmatched ones too.  Pairs that stay on one carrier are no transfer.

    A single join serves both kinds of goods: the kind is part of the key.  Transactions
    with very many legs are split by adaptive execution on the out side.
    """
    pairs = outs.join(ins, PAIR, "left")
    if numeric_target:
        pairs = pairs.where("to_numeric")
    else:
        pairs = pairs.where((F.col("good_type") == "NORMAL") | F.col("ziel_lhm").isNotNull())
    return pairs.where(self_transfer_drop(F.col("source_lhm"), F.col("ziel_lhm")))


def _with_own_carrier(legs: DataFrame, carrier: str) -> DataFrame:
    """Every leg once for its whole transaction and, if it names a carrier, once for that carrier (``own``)."""
    sides = F.array(F.struct(F.lit(False).alias("own"), F.lit("").alias("on")), F.struct(F.lit(True).alias("own"), F.col(carrier).alias("on")))
    named = legs.withColumn("_side", F.explode(F.filter(sides, lambda side: side["on"].isNotNull())))
    return named.withColumns({"own": F.col("_side.own"), "on": F.col("_side.on")}).drop("_side", carrier)


def pair_totals(
    outs: DataFrame, ins: DataFrame, place: Sequence[str], rule_out: Sequence[str], rule_in: Sequence[str],
    described: Mapping[str, Column], numeric_target: bool = False, hot_legs: int = HOT_LEGS,
) -> DataFrame:
    """Quantity and number of pairs by columns of the out leg and by what both legs say together.

    Same pairs as :func:`pair_legs`, for reports that sum them up.  ``place`` are columns of
    the out leg that are kept, ``described`` are expressions over ``rule_out`` and ``rule_in``.

    Transactions with few legs are paired, which takes one shuffle of their legs; those with very many
    are counted.  Which is which is part of the plan, a broadcast of the buckets that hold many legs, and decides
    about the work only: both ways give the same sums.
    """
    flags = list(dict.fromkeys([*rule_in, "to_numeric"]))
    rule_out = [name for name in rule_out if name not in PAIR]
    outs = outs.select(*PAIR, "source_lhm", "quantity", *place, *rule_out)
    ins = ins.select(*PAIR, "ziel_lhm", *flags)
    if numeric_target:
        ins = ins.where("to_numeric")
    hot = F.broadcast(hot_buckets(outs, ins, hot_legs))

    def held(legs: DataFrame, how: str) -> DataFrame:
        return legs.join(hot, _bucket() == F.col("_hot"), how)

    pairs = pair_legs(held(outs, "left_anti"), held(ins, "left_anti"), numeric_target)
    built = pairs.select(
        *place, *[value.alias(name) for name, value in described.items()], "quantity", F.lit(1).cast("bigint").alias("pairs"))
    return built.unionByName(_counted_pairs(held(outs, "left_semi"), held(ins, "left_semi"), place, rule_out, flags, described, numeric_target))


def _bucket() -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(BUCKETS))


def hot_buckets(outs: DataFrame, ins: DataFrame, at_least: int = HOT_LEGS) -> DataFrame:
    """Buckets of transactions (``_hot``) that hold ``at_least`` legs or more.

    A transaction with so many legs is in one of them, whatever else is in its bucket.  There are ``BUCKETS`` at most, however many
    transactions there are, and they are added up before they travel.
    """
    legs = outs.select(_bucket().alias("_hot")).unionByName(ins.select(_bucket().alias("_hot")))
    return legs.groupBy("_hot").agg(F.count("*").alias("_legs")).where(F.col("_legs") >= at_least).select("_hot")


def _counted_pairs(
    outs: DataFrame, ins: DataFrame, place: Sequence[str], rule_out: Sequence[str], flags: Sequence[str],
    described: Mapping[str, Column], numeric_target: bool,
) -> DataFrame:
    """Totals of pairs that are counted and not built: all pairs of a transaction, less those that stay on one carrier.

    Both sides are summed up first, per transaction and values of their rule columns for the former and per
    carrier as well for the latter, and met in one join; so the work grows with the legs and their different values, whatever
    a transaction holds.  Groups whose pairs cancel out remain, with 0 pairs in total.
    """
    key, side = PAIR, ["own", "on"]
    many_outs = _with_own_carrier(outs, "source_lhm").groupBy(
        *key, *side, *place, *rule_out).agg(F.sum("quantity").alias("q"), F.count("*").alias("n"))
    many_ins = _with_own_carrier(ins, "ziel_lhm").groupBy(*key, *side, *flags).agg(F.count("*").alias("m"))
    met = many_outs.join(many_ins, [*key, *side], "inner" if numeric_target else "left")
    alone = F.when(~F.col("own") & (F.col("good_type") == "NORMAL"), 1)
    times = F.coalesce("m", alone) * F.when(F.col("own"), -1).otherwise(1)
    return met.withColumn("_times", times).where("_times is not null").select(
        *place, *[value.alias(name) for name, value in described.items()],
        (F.col("q") * F.col("_times")).alias("quantity"), (F.col("n") * F.col("_times")).alias("pairs"))


# Order of a transaction's rows; the columns after the sequence only settle ties.
def scan_order() -> list[Column]:
    columns = ("sequence", "created", "artnr", "lhmnr", "menge", "ziel", "createdby", "cust_data")
    return [F.col(name).asc_nulls_last() for name in columns]


def sorting_legs(ledger: DataFrame, how: LegFilter) -> tuple[DataFrame, DataFrame]:
    """Legs of manual sorting.  Both sides are held to the window, which prunes both scans."""
    normal, sorting = F.col("tpartnr") == c.NORMAL, F.col("ziel").isin(*c.SORTING_TARGETS)
    dummy_out = (
        (F.col("tpartnr") == c.DUMMY_OUT)
        & (F.col("typ_id") == c.EVENT_GRADED)
        & F.col("ziel").isin(*c.SORTING_DUMMY_TARGETS)
    )
    is_out = (F.col("menge") < 0) & ((normal & sorting) | dummy_out)
    is_in = sorting & ((normal & (F.col("menge") == 1)) | ((F.col("tpartnr") == c.DUMMY_IN) & (F.col("menge") > 0)))
    window = between_window(F.col("created"), how.start, how.end)
    return tuple(
        keep(ledger.where(side), window).withColumn("good_type", good_type()) for side in (is_out, is_in))


def number_dummies(legs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number dummy legs within their transaction; normal legs all get 0 and are not sorted for it."""
    dummy = F.col("good_type") == "DUMMY"
    dummies = legs.where(dummy)
    numbered = sequence_index(dummies, KEY, scan_order(), F.col("sequence"), hot=hot_keys(dummies, KEY, hot_rows))
    return numbered.unionByName(legs.where(~dummy).withColumn("rn", F.lit(0)))


def pair_legs_sequenced(ledger: DataFrame, how: LegFilter, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Manual sorting: the n-th dummy out leg of a transaction goes with its n-th in leg.

    Normal goods pair by transaction alone, so they share the number 0 and one join does
    both.  The reference filter comes after the numbering, which must see every leg.
    """
    outs, ins = (number_dummies(side, hot_rows) for side in sorting_legs(ledger, how))
    outs = json_fields(outs, ("reference", "grade_sector", "category_id", "source_id", "channel_id",
                              "sku", "sort_id", "last_ean"))
    if how.reference:
        outs = outs.where(ref_filter(F.col("reference"), how.reference))
    ins = json_fields(ins, ("sku", "sort_id")).select(
        "good_type", KEY, "rn", F.col("lhmnr").alias("ziel_lhm"), F.col("artnr").alias("in_artnr"),
        F.col("sku").alias("in_sku"), F.col("sort_id").alias("in_sort_id"))
    pairs = outs.withColumnRenamed("lhmnr", "source_lhm").join(ins, [*PAIR, "rn"], "left")
    return pairs.where(
        self_transfer_drop(F.col("source_lhm"), F.col("ziel_lhm"))
        & F.col("ziel_lhm").rlike("^[0-9]+$"))
