"""Reports on goods received: KPIs per workstation, shift report, booking details, volumes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from palletrail import config as c
from palletrail.functions import rules, times
from palletrail.functions.predicates import nullable_unlike, report_predicate
from palletrail.operators.enrich import enrich_dimension, select_rename
from palletrail.operators.legs import LegFilter, in_legs, out_legs, pair_legs, pair_totals


def _either(name: str) -> Column:
    """Attribute of the arrival leg, else of the departure leg."""
    return F.coalesce(f"in_{name}", f"out_{name}")


def quality() -> Column:
    normal = rules.grade_single(F.col("out_grade_sector"), F.col("out_sortable"))
    dummy = rules.grade_dual(F.col("in_grade_article"), F.col("out_grade_sector"),
                             F.col("in_sortable"), F.col("out_sortable"))
    return F.when(F.col("good_type") == "NORMAL", normal).otherwise(dummy)


def category(first_leg_only: bool = False) -> Column:
    if first_leg_only:
        return rules.category_map(F.col("out_category_id"))
    code = F.when(F.col("good_type") == "NORMAL", F.col("out_category_id")).otherwise(_either("category_id"))
    return rules.category_map(code)


def source_channel(labels: Mapping[str, str] = c.SOURCES) -> Column:
    return rules.source_channel_map(_either("source_id"), labels=labels)


def distribution_channel(variant: str) -> Column:
    target = {pattern: F.col(flag) for pattern, flag in c.TARGET_PATTERNS.items()}
    return rules.distribution_channel(
        c.CHANNEL_RULES[variant], _either("channel_id"), _either("source_id"), target)


# Columns of a paired row that decide quality, category and channels.
_RULE_OUT = ("good_type", "out_grade_sector", "out_sortable", "out_category_id", "out_source_id", "out_channel_id")
_RULE_IN = ("in_grade_article", "in_sortable", "in_category_id", "in_source_id", "in_channel_id")


def kpi_measures(labels: Mapping[str, str] = c.SOURCES) -> dict[str, Column]:
    """KPI name -> predicate on a described row.  The KPIs overlap; do not add them up."""
    first_source, returns, returned_overstock = (labels[code] for code in ("1", "10", "11"))
    measures = {
        f"grade_{grade.lower()}": (F.col("quality") == grade) & (F.col("source_channel") == first_source)
        for grade in c.GRADES.values()
    }
    return measures | {
        "store_returns_outlet": F.col("source_channel") == returns,
        "store_returns_overstock": F.col("source_channel") == returned_overstock,
        "blocklist": F.col("distribution_channel") == "Blocklist",
        "s_item": F.col("distribution_channel") == "disposal",
        "clarification": F.col("distribution_channel") == "Clarification",
    }


def kpi_pivot(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """One row per key with the quantity that meets each predicate, 0 where none does."""
    sums = [F.sum(F.when(test, F.col("quantity")).otherwise(0)).alias(name) for name, test in measures.items()]
    return rows.groupBy(*keys).agg(*sums, F.sum("pairs").alias("pairs")).where("pairs > 0").drop("pairs")


def _kpi_report(ledger: DataFrame, how: LegFilter, by_user: bool, labels: Mapping[str, str]) -> DataFrame:
    outs = (
        out_legs(ledger, how, ("reference", "grade_sector", "sortable", "category_id", "source_id", "channel_id"))
        .withColumns({"date": times.iso_day(F.col("created")), "shift": times.shift_of(F.col("created"))})
        .withColumnsRenamed({"ziel": "workstation", "createdby": "user"})
    )
    ins = in_legs(ledger, how, ("grade_article", "sortable", "category_id", "source_id", "channel_id"))
    place = ["date", "shift", "workstation"] + (["user"] if by_user else [])
    rows = pair_totals(
        outs, ins, place, _RULE_OUT, [*_RULE_IN, "to_50", "to_disposal", "to_clarify"],
        {"quality": quality(), "category": category(), "source_channel": source_channel(labels),
         "distribution_channel": distribution_channel("kpi")})
    result = kpi_pivot(rows, [*place, "category"], kpi_measures(labels))
    return result.orderBy(F.asc("date"), F.asc_nulls_last("shift"), F.asc_nulls_last("workstation"))


def uph_kpis(ledger: DataFrame, how: LegFilter = LegFilter(), labels: Mapping[str, str] = c.SOURCES) -> DataFrame:
    """Received quantity per day, shift, workstation and category, by grade and channel."""
    return _kpi_report(ledger, how, False, labels)


def uph_kpis_by_user(ledger: DataFrame, how: LegFilter = LegFilter(), labels: Mapping[str, str] = c.SOURCES) -> DataFrame:
    """The same KPIs per user as well; this report knows no reference filter."""
    return _kpi_report(ledger, replace(how, reference=None), True, labels)


SHIFT_KEYS = ("date", "shift", "source", "quality", "distchannel", "reference", "category", "sortid")


def shift_report(ledger: DataFrame, how: LegFilter = LegFilter(), labels: Mapping[str, str] = c.SOURCES) -> DataFrame:
    """Quantity moved to all-digit carriers, by eight dimensions, in order of the day."""
    outs = (
        out_legs(ledger, how)
        .withColumns({"day": F.to_date("created"), "shift": times.shift_of(F.col("created"))})
        .withColumnRenamed("out_reference", "reference")
    )
    ins = in_legs(ledger, how)
    # Each kind of goods takes its sorting id from one leg; the other leg's would only multiply groups.
    normal = F.col("good_type") == "NORMAL"
    outs = outs.withColumn("out_sort_id", F.when(normal, F.col("out_sort_id")))
    ins = ins.withColumn("in_sort_id", F.when(~normal, F.col("in_sort_id")))
    rows = pair_totals(
        outs, ins, ["day", "shift", "reference"], [*_RULE_OUT, "out_sort_id"], [*_RULE_IN, "in_sort_id", "to_50"],
        {"source": source_channel(labels), "quality": quality(), "distchannel": distribution_channel("base"),
         "category": category(),
         "sortid": rules.by_origin(F.col("good_type"), F.col("out_sort_id"), F.col("in_sort_id"))},
        numeric_target=True)
    total = (
        rows.groupBy("day", *SHIFT_KEYS[1:])
        .agg(F.sum("quantity").alias("quantity"), F.sum("pairs").alias("pairs"))
        .where("pairs > 0")
        .orderBy(F.asc("day"), F.asc_nulls_last("shift"), F.asc_nulls_last("reference"))
    )
    return total.select(times.day_text(F.col("day")).alias("date"), *SHIFT_KEYS[1:], "quantity")


DETAIL_COLUMNS = ("timestamp", "ean", "ap", "benutzer", "source_lhm", "ziel_lhm", "quantity", "reference_lhm",
                  "source_channel", "quality", "category", "distribution_channel", "sku", "sort_id")


def describe_pairs(pairs: DataFrame, variant: str, labels: Mapping[str, str] = c.SOURCES,
                   first_leg_category: bool = False) -> DataFrame:
    """Detail row of every pair, as people read it."""
    kind = F.col("good_type")
    return pairs.select(
        times.stamp_text(F.col("created")).alias("timestamp"),
        rules.ean_two_step(kind, F.col("artnr"), F.col("out_last_ean")).alias("ean"),
        F.col("ziel").alias("ap"),
        F.col("createdby").alias("benutzer"),
        "source_lhm", "ziel_lhm", "quantity",
        F.col("out_reference").alias("reference_lhm"),
        source_channel(labels).alias("source_channel"),
        quality().alias("quality"),
        category(first_leg_category).alias("category"),
        distribution_channel(variant).alias("distribution_channel"),
        rules.by_origin(kind, F.col("out_sku"), F.col("in_sku")).alias("sku"),
        rules.by_origin(kind, F.col("out_sort_id"), F.col("in_sort_id")).alias("sort_id"),
    )


def booking_detail(ledger: DataFrame, how: LegFilter = LegFilter(), labels: Mapping[str, str] = c.SOURCES) -> DataFrame:
    """Every booking, unmatched normal goods included; disposal and blocklist are told apart."""
    return describe_pairs(pair_legs(out_legs(ledger, how), in_legs(ledger, how)), "detail", labels)


def booking_detail_numeric(ledger: DataFrame, how: LegFilter = LegFilter(), labels: Mapping[str, str] = c.SOURCES,
                           first_leg_category: bool = False) -> DataFrame:
    """Bookings onto all-digit carriers.

    ``first_leg_category`` is the variant of the live terminal, which reads the category
    of dummy goods from the departure leg too.
    """
    pairs = pair_legs(out_legs(ledger, how), in_legs(ledger, how), numeric_target=True)
    return describe_pairs(pairs, "base", labels, first_leg_category)


def monthly_report(ledger: DataFrame, brands: DataFrame, report: c.MonthlyReport, how: LegFilter = LegFilter(),
                   overrides: Mapping[str, str] | None = None, labels: Mapping[str, str] = c.SOURCES) -> DataFrame:
    """Bookings of a month that meet the report's condition, with the brand of each article."""
    rows = booking_detail_numeric(ledger, how, labels).where(report_predicate(report.where))
    branded = enrich_dimension(rows, brands, "ean", "brand_name", overrides or {}, c.NO_BRAND)
    return select_rename(branded, report.columns)


def volume_measures() -> dict[str, Column]:
    channel = F.col("distribution_channel")
    not_sorting = nullable_unlike(F.col("ziel"), "IN_SZR_OV")
    outlet, overstock = channel == "Outlet", (channel == "Overstock") & not_sorting
    return {
        "ou_bsf_sort": F.col("to_6") & outlet,
        "ou_bigitems": F.col("to_3") & outlet,
        "total_outlet": outlet,
        "in_srz": F.col("ziel").like("IN_SZR_OV"),
        "ov_overstock_sort": F.col("to_6") & overstock,
        "ov_fin_ap": F.col("to_5") & overstock,
        "total_overstock": overstock,
    }


def receive_volume(ledger: DataFrame, how: LegFilter = LegFilter()) -> DataFrame:
    """Volume per day by carrier family and channel, latest day first; any target place counts."""
    how = replace(how, target=None)
    outs = out_legs(ledger, how, ("reference", "source_id", "channel_id")).withColumn("day", F.to_date("created"))
    ins = in_legs(ledger, how, ("source_id", "channel_id"))
    rows = pair_totals(
        outs, ins, ["day", "ziel"], ["out_source_id", "out_channel_id"],
        ["in_source_id", "in_channel_id", "to_50", "to_3", "to_5", "to_6"],
        {"distribution_channel": distribution_channel("base"), "to_3": F.col("to_3"), "to_5": F.col("to_5"),
         "to_6": F.col("to_6")},
        numeric_target=True)
    days = kpi_pivot(rows, ["day"], volume_measures()).orderBy(F.desc("day"))
    return days.select(times.day_text(F.col("day")).alias("date_only"),
                       times.month_key(F.col("day")).alias("year_month"), *volume_measures())
