"""Hazardous stock: cleaned extract, volumes, and volumes by class against their limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from palletrail.functions.predicates import mask_ready, starts_with_digit
from palletrail.functions.text import null_to_blank, num_clean
from palletrail.operators.skew import broadcast_if_small


def stock_by_category(stock: DataFrame, category: str) -> DataFrame:
    """Stock of one category, transit places left out."""
    place = F.col("place")
    return stock.where((F.col("category") == category) & ~place.like("T%") & ~place.like("BSF_T%"))


def hazard_stock(stock: DataFrame, category: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Cleaned rows: numbered main carriers only, texts without NULL, volume as a number.

    All columns of the extract are kept, unless ``columns`` names those wanted; what is no text stays as it is.
    """
    rows = stock_by_category(stock, category).where(starts_with_digit(F.col("mainlhm")))
    ready = mask_ready(F.col("channel"), F.col("place"), F.col("carrier"))
    kinds = dict(stock.dtypes)
    return rows.select(
        *[(null_to_blank(F.col(name)) if kinds[name] == "string" else F.col(name)).alias(name) for name in columns or kinds],
        num_clean(F.col("volume_text")).alias("volume"),
        ready.alias("ready"),
    )


def total_and_ready_volume(stock: DataFrame) -> DataFrame:
    """Volume of all rows and of those ready to go, in one pass."""
    volume = num_clean(F.col("volume_text"))
    ready = mask_ready(F.col("channel"), F.col("place"), F.col("carrier"))
    return stock.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(volume), F.lit(0.0)).alias("total_vol"),
        F.coalesce(F.sum(F.when(ready, volume)), F.lit(0.0)).alias("ready_vol"),
    )


def hazard_merge(stock: DataFrame, handling_units: DataFrame, classes: DataFrame) -> DataFrame:
    """Stock with the UN number of its article and the hazard class of the number."""
    volume = stock.withColumn("volume", num_clean(F.col("volume_text")))
    return (
        volume.join(broadcast_if_small(handling_units), "artnr", "left")
        .join(broadcast_if_small(classes), "un_no", "left")
    )


def hazard_volume_rollup(merged: DataFrame) -> DataFrame:
    """Volume in total, per place, per place and class, and down to the UN number.

    The finest level is summed first, so the other levels are built from few rows.
    """
    levels = ["place", "hazard_class", "un_no"]
    finest = merged.groupBy(*levels).agg(F.sum("volume").alias("volume"))
    return finest.rollup(*levels).agg(F.grouping_id().alias("level"), F.sum("volume").alias("volume"))


def drill_down(merged: DataFrame) -> DataFrame:
    """Volume in total (``level`` 3), per load carrier (1), and per article on the carrier (0).

    Nearly every article of a carrier is a group of its own, so these are summed once and
    the other levels are made of their sums; a rollup would hold and shuffle them again.
    """
    def level(rows: DataFrame, number: int) -> DataFrame:
        blank = {name: F.lit(None).cast(merged.schema[name].dataType) for name in ("carrier", "artnr") if name not in rows.columns}
        return rows.withColumns({**blank, "level": F.lit(number).cast("bigint")}).select("carrier", "artnr", "level", "volume")

    volume = F.sum("volume").alias("volume")
    finest = merged.groupBy("carrier", "artnr").agg(volume)
    carriers = finest.groupBy("carrier").agg(volume)
    total = carriers.groupBy(F.lit(3).alias("_all")).agg(volume)  # no row without stock
    return level(finest, 0).unionByName(level(carriers, 1)).unionByName(level(total, 3))


def hazard_compliance(merged: DataFrame) -> DataFrame:
    """Net volume per class and UN number against its limit, and the days until it is met.

    No formula for the days is given; here they are the room left divided by the mean
    daily net inflow over the days on record; 0 once over the limit, NULL where stock does not grow.
    """
    signed = F.when(F.col("direction") == "out", -F.col("volume")).otherwise(F.col("volume"))
    known = merged.where("hazard_class is not null")
    totals = known.groupBy("hazard_class", "un_no", "volume_limit").agg(
        F.sum(signed).alias("volume"),
        (F.datediff(F.max("booked"), F.min("booked")) + 1).cast("bigint").alias("days"),
    )
    inflow = F.col("volume") / F.col("days")
    return totals.select(
        "hazard_class", "un_no", "volume_limit", "volume", "days",
        F.when(F.col("volume") > 0, F.greatest(F.lit(0.0), F.col("volume_limit") - F.col("volume")) / inflow).alias("days_to_limit"),
        (F.col("volume") > F.col("volume_limit")).alias("over_limit"),
    )
