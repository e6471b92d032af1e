"""Order duration at the palletizing stations and the transport load around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from palletrail import config as c
from palletrail.functions import times
from palletrail.operators.congestion import interval_congestion


def log_moment(stamp: str = "stamp") -> dict:
    text = F.col(stamp)
    return {"day": times.stamp_to_date(text), "second": times.stamp_to_seconds(text)}


def carton_times(transport_log: DataFrame) -> DataFrame:
    """When a shipping carton was released and when it reached a pallet station, first time each.

    One pass over the log; the first match is the smallest moment, so it is combined
    before the shuffle.
    """
    moment = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("second"))
    created = F.col("event") == c.REQUEST_CREATED
    arrived = (F.col("event") == c.REQUEST_DONE) & F.col("to_place").like(c.PALLET_STATION)
    first = (
        transport_log.where(F.col("carrier_type").like(c.SHIPPING_TYPE) & (created | arrived))
        .withColumns(log_moment()).withColumn("moment", moment)
        .groupBy(F.col("carrier").alias("carton"))
        .agg(F.min(F.when(created, F.col("moment"))).alias("released"),
             F.min(F.when(arrived, F.col("moment"))).alias("arrived"))
    )
    return first.select("carton", times.seconds_of_day(F.col("released")).alias("released"),
                        times.seconds_of_day(F.col("arrived")).alias("arrived"))


def order_sizes(order_status: DataFrame) -> DataFrame:
    """Pallets and colli of finalised outlet orders, from the first entry of each.

    The colli are those of the order's first finalising entry in any channel.
    """
    final = order_status.where(F.col("status") == c.ORDER_FINALISING)
    outlet = F.col("channel") == c.ORDER_CHANNEL
    late = F.col("changed").isNull()  # an entry without time comes last
    first = final.groupBy("order_no").agg(
        F.min(F.struct(late, "changed", "colli")).alias("any"),
        F.min(F.when(outlet, F.struct(late, "changed", "pallets"))).alias("own"))
    return first.where("own is not null").select(
        "order_no", F.col("own.pallets").alias("pallets"), F.col("any.colli").alias("colli"))


def order_windows(transport_log: DataFrame, order_status: DataFrame, order_monitor: DataFrame,
                  min_colli: int = c.MIN_COLLI) -> DataFrame:
    """Distinct large orders with the latest release and the latest arrival of their cartons."""
    cartons = order_monitor.where(
        (F.col("channel") == c.ORDER_CHANNEL) & F.col("carton").like("4%") & (F.col("state") != c.ORDER_DELETED)
    ).select("carton", "order_no", times.stamp_to_date(F.col("release_text")).alias("day"), "station")
    timed = cartons.join(carton_times(transport_log), "carton", "left")
    rows = (
        timed.groupBy("order_no", "day", "station")
        .agg(F.max("released").alias("start"), F.max("arrived").alias("end"))
    )
    whole_order = Window.partitionBy("order_no")
    rows = rows.withColumns({name: F.max(name).over(whole_order) for name in ("start", "end")})
    sized = rows.join(order_sizes(order_status), "order_no").where(F.col("colli") > min_colli)
    return sized.withColumn("week", times.week_number(F.col("day")))


def duration_metrics() -> dict:
    """Durations in seconds and rates; a zero or missing divisor gives NULL."""
    duration = (F.col("end") - F.col("start")).cast("double")
    return {
        "duration_s": duration,
        "seconds_per_colli": duration / F.nullif(F.col("colli"), F.lit(0)),
        "colli_per_minute": F.col("colli") / F.nullif(duration / 60, F.lit(0.0)),
        "seconds_per_pallet": duration / F.nullif(F.col("pallets"), F.lit(0)),
        "shift": F.when(times.in_shift(F.col("start"), c.ORDER_SHIFT_ONE), 1).otherwise(2),
    }


def order_duration(transport_log: DataFrame, order_status: DataFrame, order_monitor: DataFrame,
                   routes: Sequence[c.Route] = c.ROUTES, min_colli: int = c.MIN_COLLI) -> DataFrame:
    """One row per large order: window, transports in it by route, duration and rates."""
    windows = order_windows(transport_log, order_status, order_monitor, min_colli)
    started = transport_log.where(F.col("event") == c.REQUEST_STARTED).withColumns(log_moment())
    counted = interval_congestion(windows, started, routes)
    return counted.withColumns(duration_metrics()).withColumnRenamed("day", "date")


def congestion_correlation(durations: DataFrame, routes: Sequence[c.Route] = c.ROUTES) -> DataFrame:
    """Correlation of the load within an order's window with the order's duration, per route.

    NULL where either side does not vary.
    """
    known = durations.where("duration_s is not null")
    spread = F.stddev_pop("duration_s")
    correlation = {
        route.name: F.try_divide(
            F.covar_pop(F.col(route.name).cast("double"), F.col("duration_s")),
            F.stddev_pop(F.col(route.name).cast("double")) * spread)
        for route in routes
    }
    return known.agg(F.count("*").alias("orders"), *[value.alias(name) for name, value in correlation.items()])
