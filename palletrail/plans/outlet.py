"""Outlet bookings: booked less clarified quantity, clarified items, and their grades."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from palletrail import config as c
from palletrail.functions import rules, times
from palletrail.functions.attributes import json_field, json_fields
from palletrail.functions.predicates import has_prefix, keep, open_window
from palletrail.functions.text import null_to_blank, null_to_zero
from palletrail.operators.skew import first_per_key

CARRIERS = ("4", "5")
ITEM = ["lhmnr", "artnr"]


def _event(event: int, process: int) -> Column:
    return (F.col("typ_id") == event) & (F.col("tpartnr") == process)


def item_code(carrier: str = "lhmnr", article: str = "artnr") -> Column:
    """Number that begins the sort and join keys of items, so that nearly every comparison is settled by it.

    Many rows share a carrier, whose text alone would settle few.  Equal items have equal codes; different
    items may share one, so the texts stay in the keys.  Rows of a carrier stay near each other.
    """
    return F.shiftleft(F.hash(carrier).cast("bigint"), 32).bitwiseXOR(F.hash(article).cast("bigint"))


def outlet_carrier(carrier: str = "lhmnr") -> Column:
    return has_prefix(F.col(carrier), CARRIERS)


def booked_and_clarified(ledger: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Totals per carrier and article, with one representative time and document.

    Bookings and clarifications are summed in one pass over the ledger, so subtracting
    one from the other needs no join.  Clarifications of an unknown article meet no
    booking.  The representative document is the greatest as text.
    """
    return _booked_and_clarified(ledger, start, end).drop("item")


def _booked_and_clarified(ledger: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    booked, clarified = _event(c.EVENT_BOOKED, c.BOOKING), _event(c.EVENT_CLARIFIED, c.CLARIFICATION)
    rows = keep(ledger.where((booked | clarified) & outlet_carrier()), open_window(F.col("created"), start, end))
    return (
        rows.withColumn("item", item_code()).groupBy("item", *ITEM)
        .agg(
            F.sum(F.when(booked, F.col("menge"))).alias("total_booked"),
            F.sum(F.when(clarified & F.col("artnr").isNotNull(), F.abs("menge"))).alias("total_clarified"),
            F.max(F.when(booked, F.col("created"))).alias("created"),
            F.max(F.when(booked, F.col("cust_data"))).alias("cust_data"),
            F.count(F.when(booked, F.lit(1))).alias("bookings"),
        )
        .where("bookings > 0")
        .drop("bookings")
    )


def net_booked(ledger: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Items with something left after clarifications."""
    return _net_booked(ledger, start, end).drop("item")


def _net_booked(ledger: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    net = F.col("total_booked") - null_to_zero(F.col("total_clarified"))
    return _booked_and_clarified(ledger, start, end).withColumn("quantity", net).where("quantity > 0")


def first_grade(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Grade of the earliest row per key, by time, then sequence, then code."""
    coded = rows.withColumn("code", json_field(F.col("cust_data"), "grade_sector"))
    order = [F.col(name).asc_nulls_last() for name in ("created", "sequence", "code")]
    first = first_per_key(coded.select(*keys, "created", "sequence", "code"), keys, order)
    return first.select(*keys, rules.grade_plain(F.col("code"), None).alias("grade"))


def graded_history(ledger: DataFrame) -> DataFrame:
    """Grade an item was booked out with, per carrier and article."""
    return _graded_history(ledger).drop("item")


def _graded_history(ledger: DataFrame) -> DataFrame:
    rows = ledger.where(_event(c.EVENT_GRADED, c.DUMMY_OUT) & (F.col("menge") < 0) & outlet_carrier())
    return first_grade(rows.withColumn("item", item_code()), ["item", *ITEM])


def station_grade(ledger: DataFrame) -> DataFrame:
    """Grade an article had at its clarification station."""
    rows = ledger.where(_event(c.EVENT_STATION, c.NORMAL)).withColumn("station", F.trim("lhmnr"))
    return first_grade(rows.where(F.col("station").startswith("KF_")), ["artnr", "station"])


def carrier_history(ledger: DataFrame) -> DataFrame:
    """First known grade of anything that was on a carrier."""
    known = json_field(F.col("cust_data"), "grade_sector").isin(*c.GRADES)
    return first_grade(ledger.where(outlet_carrier() & known), ["lhmnr"])


def unpivot_carriers(stock: DataFrame, *columns: str) -> DataFrame:
    """Main and sub carrier one below the other; rows without a carrier are left out."""
    return stock.unpivot(list(columns), ["mainlhm", "sublhm"], "lhm_type", "lc").where("lc is not null")


def or_key_lookup(stock: DataFrame) -> DataFrame:
    """Greatest grade on a carrier, be it the main or the sub carrier."""
    return unpivot_carriers(stock, "quality").where("quality is not null").groupBy("lc").agg(F.max("quality").alias("grade"))


def best_grade_dedup(stock: DataFrame) -> DataFrame:
    """One grade per carrier and article: the last in text order, a missing grade before all."""
    return _best_grade(stock, ["lc", "artnr"])


def _best_grade(stock: DataFrame, keys: list[str]) -> DataFrame:
    rows = unpivot_carriers(stock, "artnr", "quality").where(outlet_carrier("lc")).withColumn("item", item_code("lc"))
    return first_per_key(rows.select(*keys, "quality"), keys, [F.col("quality").desc_nulls_first()])


def _stock_grades(stock: DataFrame) -> DataFrame:
    """Stock grades to join items with; renaming its columns first makes every use the same plan, so that Spark runs it once."""
    own = stock.select(*[F.col(name).alias(name) for name in ("mainlhm", "sublhm", "artnr", "quality")])
    return _best_grade(own, ["item", "lc", "artnr"]).withColumnRenamed("artnr", "ean")


def _item_columns() -> list[Column]:
    return [
        F.to_date("created").alias("day"),
        times.shift_of(F.col("created")).alias("shift"),
        F.col("lhmnr").alias("lc"),
        rules.category_map(F.col("category_id"), None).alias("category"),
        F.col("sort_id"),
        F.col("artnr").alias("ean"),
        F.col("quantity").cast("bigint").alias("quantity"),
    ]


def _dated(items: DataFrame) -> DataFrame:
    """The day as text, as it is reported."""
    return items.withColumn("day", F.col("day").cast("string")).withColumnRenamed("day", "date")


def net_items(ledger: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Booked items (origin 1), graded from their own history."""
    return _dated(_net_items(ledger, start, end).drop("item"))


def _net_items(ledger: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    items = json_fields(_net_booked(ledger, start, end), ("category_id", "sort_id"))
    items = items.join(_graded_history(ledger), ["item", *ITEM], "left")
    return items.select("item", *_item_columns(), F.col("grade").alias("fallback"), F.lit(1).alias("origin"))


def clarified_items(ledger: DataFrame, stock: DataFrame, start: datetime | None, end: datetime | None,
                    own_grade_only: bool = False) -> DataFrame:
    """Clarified items (origin 2).

    Grade by the first that is known: own document, clarification station, stock left on
    the carrier, earlier items of the carrier.  Equal items are added up first, so that a
    carrier with very many clarifications goes into the lookups as few rows.
    """
    return _dated(_clarified_items(ledger, stock, start, end, own_grade_only).drop("item"))


def _clarified_items(ledger: DataFrame, stock: DataFrame, start: datetime | None, end: datetime | None,
                     own_grade_only: bool) -> DataFrame:
    rows = keep(
        ledger.where(_event(c.EVENT_CLARIFIED, c.CLARIFICATION) & outlet_carrier()),
        open_window(F.col("created"), start, end),
    ).withColumn("quantity", F.abs("menge"))
    rows = json_fields(rows, ("category_id", "sort_id", "grade_sector"))
    own = rules.grade_plain(F.col("grade_sector"), None)
    items = rows.select(
        *_item_columns(), own.alias("own"),
        F.concat(F.lit("KF_"), null_to_blank(F.trim("ziel"))).alias("station"))
    keys = [name for name in items.columns if name != "quantity"]
    items = items.groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    if own_grade_only:
        graded = items.withColumn("fallback", F.col("own"))
    else:
        station = station_grade(ledger).select(F.col("artnr").alias("ean"), "station", F.col("grade").alias("at_station"))
        left = or_key_lookup(stock).withColumnRenamed("grade", "in_stock")
        history = carrier_history(ledger).select(F.col("lhmnr").alias("lc"), F.col("grade").alias("in_history"))
        graded = (
            items.join(station, ["ean", "station"], "left")
            .join(left, "lc", "left")
            .join(history, "lc", "left")
            .withColumn("fallback", F.coalesce("own", "at_station", "in_stock", "in_history"))
        )
    return graded.select(item_code("lc", "ean").alias("item"), "day", "shift", "lc", "category", "sort_id", "ean", "quantity", "fallback",
                         F.lit(2).alias("origin"))


def outlet_booking(ledger: DataFrame, stock: DataFrame, start: datetime | None = None, end: datetime | None = None,
                   own_grade_only: bool = False) -> DataFrame:
    """Items per day, shift and carrier with their grade; stock knows best, then the fallbacks.

    The stock grade is joined before the two kinds of items are put together: the booked
    items are still spread by carrier and article then, so they are not shuffled again.
    Stock without an article meets no item and is left out first, so that both joins read
    the same grades and these are shuffled once.  Items are added up under their day and
    origin; both become text afterwards.
    """
    kinds = [_net_items(ledger, start, end), _clarified_items(ledger, stock, start, end, own_grade_only)]
    named = [
        items.join(_stock_grades(stock), ["item", "lc", "ean"], "left").select(
            "day", "shift", F.col("lc").alias("hus"), "category", "sort_id",
            F.coalesce("quality", "fallback").alias("quality"), "origin", "quantity")
        for items in kinds
    ]
    keys = [name for name in named[0].columns if name != "quantity"]
    items = having_positive(named[0].unionByName(named[1]), keys, "quantity", "items")
    return _dated(items).withColumn("origin", rules.clarification_flag(F.col("origin"))).withColumnRenamed("origin", "clarification")


def having_positive(rows: DataFrame, keys: list[str], measure: str, name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(measure).alias(name)).where(F.col(name) > 0)


def outlet_booking_simple(ledger: DataFrame, stock: DataFrame, start: datetime | None = None,
                          end: datetime | None = None) -> DataFrame:
    """The same report with the own document as the only fallback of clarified items."""
    return outlet_booking(ledger, stock, start, end, own_grade_only=True).withColumnRenamed("hus", "lhm")
