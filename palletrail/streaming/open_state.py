"""Open transports kept up to date by a stream, as a state and a view of it.

The state has, per carrier and lifecycle, how many starts each KPI saw at each moment and when the lifecycle was last
completed or blocked: sums and maxima, so an event may be as late as it likes.  The view has the starts
that are open, as signed counts.  A batch reads the state of the buckets of its own carriers only, tells which of
their starts were open before and are open with it, and adds the difference to the view; a late completion so
subtracts the starts it ends.  The KPIs are read from the view.

With ``keep`` a lifecycle may be used again: a closing ends starts up to ``keep`` after it, and starts that have left
every KPI's window, and closings that can end none of the others, leave the store when its parts are merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from palletrail import config as c
from palletrail.functions.predicates import rolling_window, stamp
from palletrail.operators.transports import ended, start_predicate
from palletrail.sources.parts import PartTable
from palletrail.streaming.changes import FAN, commit_epoch, compact, has_epoch, of_kind

LIFECYCLE = ["key", "carrier", "zug_id"]
START = ["kpi", "token", "started"]
KEYS = [*LIFECYCLE, *START]
STATE, VIEW = "state", "view"
BUCKETS = 64


def parts() -> list[Column]:
    """How the stored columns of two batches are put together."""
    return [F.sum("n").alias("n"), F.max("done_at").alias("done_at"), F.max("blocked_at").alias("blocked_at")]


def bucket_of(carrier: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(carrier), F.lit(buckets)).cast("int")


def _start(kpi: c.TransportKpi) -> Column:
    token = F.col(kpi.distinct) if kpi.distinct else F.lit(None).cast("string")
    return F.when(start_predicate(kpi, None), F.struct(
        F.lit(kpi.key).alias("key"), F.lit(kpi.name).alias("kpi"), token.alias("token"),
        F.col("created").alias("started")))


def _closing(key: str) -> Column:
    is_closing = F.col("typ_id").isin(c.EVENT_DONE, c.EVENT_BLOCKED)
    return F.when(is_closing, F.struct(
        F.lit(key).alias("key"), F.lit(None).cast("string").alias("kpi"), F.lit(None).cast("string").alias("token"),
        F.lit(None).cast("timestamp_ntz").alias("started")))


def open_transport_state(events: DataFrame, kpis: Sequence[c.TransportKpi] = c.TRANSPORT_KPIS) -> DataFrame:
    """Aggregates of a batch of events; those of several batches merge by ``parts``.

    Starts are grouped by their moment as well, so a carrier with very many starts is many
    groups; its closing events are one group and are combined before the shuffle.
    """
    keys = list(dict.fromkeys(kpi.key for kpi in kpis))
    found = F.filter(
        F.array(*[_start(kpi) for kpi in kpis], *[_closing(key) for key in keys]), lambda part: part.isNotNull())
    rows = events.withColumn("part", F.explode(found))
    carrier = F.coalesce(*[F.when(F.col("part.key") == key, F.col(key)) for key in keys])
    at = lambda event: F.max(F.when(F.col("part.kpi").isNull() & (F.col("typ_id") == event), F.col("created")))
    return (
        rows.groupBy(
            F.col("part.key").alias("key"), carrier.alias("carrier"),
            "zug_id", F.col("part.kpi").alias("kpi"), F.col("part.token").alias("token"),
            F.col("part.started").alias("started"))
        .agg(F.count("*").alias("n"), at(c.EVENT_DONE).alias("done_at"), at(c.EVENT_BLOCKED).alias("blocked_at"))
        .select(*KEYS, "n", "done_at", "blocked_at")
    )


def _over(kpis: Sequence[c.TransportKpi], done_at: Column, blocked_at: Column, keep: timedelta | None) -> Column:
    """Whether a start of the KPI in the row is ended by what is known of its lifecycle."""
    counts = lambda at: at if keep is None else F.when(at > F.col("started") - F.lit(keep), at)
    over = F.lit(False)
    for kpi in kpis:
        over = over | ((F.col("kpi") == kpi.name) & ended(kpi, F.col("started"), counts(done_at), counts(blocked_at).isNotNull()))
    return over


def view_changes(state: DataFrame | None, new: DataFrame, kpis: Sequence[c.TransportKpi], keep: timedelta | None) -> DataFrame:
    """(kpi, token, started, n): how the open starts of the lifecycles of ``new`` change with it, signed."""
    touched = new.select(*LIFECYCLE).distinct()
    tagged = new.withColumns({"m": F.lit(0).cast("bigint"), "done_before": F.lit(None).cast("timestamp_ntz"),
                              "blocked_before": F.lit(None).cast("timestamp_ntz")})
    if state is not None:
        same = [state[name].eqNullSafe(touched[name]) for name in LIFECYCLE]
        old = state.join(touched, same, "left_semi").select(
            *KEYS, "n", "done_at", "blocked_at", F.col("n").alias("m"), F.col("done_at").alias("done_before"),
            F.col("blocked_at").alias("blocked_before"))
        tagged = tagged.unionByName(old)
    at = ["done_at", "blocked_at", "done_before", "blocked_before"]
    closings = tagged.where("kpi is null").groupBy(*LIFECYCLE).agg(*[F.max(name).alias(name) for name in at])
    starts = tagged.where("kpi is not null").groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    # A lifecycle without a number is none: nothing ends its starts, as in the batch reports.
    rows = starts.join(closings, LIFECYCLE, "left")
    now = F.when(_over(kpis, F.col("done_at"), F.col("blocked_at"), keep), 0).otherwise(F.col("n"))
    before = F.when(_over(kpis, F.col("done_before"), F.col("blocked_before"), keep), 0).otherwise(F.col("m"))
    changes = rows.select(*START, (now - before).alias("n")).where("n <> 0")
    return changes.groupBy(*START).agg(F.sum("n").alias("n")).where("n <> 0")


def _merge_state(kpis: Sequence[c.TransportKpi], as_of: datetime, keep: timedelta | None, buckets: int):
    def merge(rows: DataFrame) -> DataFrame:
        rows = rows.groupBy(*KEYS).agg(*parts()).withColumn("bucket", bucket_of(F.col("carrier"), buckets))
        if keep is not None:
            oldest = stamp(as_of - timedelta(days=max(kpi.days for kpi in kpis)))
            last = F.greatest("done_at", "blocked_at")
            rows = rows.where(F.when(F.col("kpi").isNull(), last > oldest - F.lit(keep)).otherwise(F.col("started") > oldest))
        return rows.hint("rebalance", F.col("bucket"))

    return merge


def _merge_view(kpis: Sequence[c.TransportKpi], as_of: datetime, keep: timedelta | None):
    def merge(rows: DataFrame) -> DataFrame:
        rows = rows.groupBy(*START).agg(F.sum("n").alias("n")).where("n <> 0")
        return rows if keep is None else rows.where(F.col("started") > stamp(as_of - timedelta(days=max(kpi.days for kpi in kpis))))

    return merge


def add_batch(batch: DataFrame, epoch: int, folder: str, as_of: datetime, kpis: Sequence[c.TransportKpi] = c.TRANSPORT_KPIS,
              keep: timedelta | None = None, buckets: int = BUCKETS, fan: int = FAN) -> None:
    """Bring state and view up to date with a batch, in one change of the store."""
    table = PartTable(batch.sparkSession, folder)
    if not has_epoch(table, epoch):
        rows = open_transport_state(batch, kpis).withColumn("bucket", bucket_of(F.col("carrier"), buckets))
        new = table.write(rows.hint("rebalance", F.col("bucket")), "bucket", kind=STATE, level=0)
        if not new.rows:
            commit_epoch(table, epoch)
            return
        fresh, old = table.read([new]), table.read(of_kind(table.contents(), STATE))
        if old is not None:
            touched = [row["bucket"] for row in fresh.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
            old = old.where(F.col("bucket").isin(touched)).drop("bucket")
        view = table.write(view_changes(old, fresh.drop("bucket"), kpis, keep), kind=VIEW, level=0)
        commit_epoch(table, epoch, new, *([view] if view.rows else []))
    compact(table, _merge_state(kpis, as_of, keep, buckets), STATE, fan, ["bucket"])
    compact(table, _merge_view(kpis, as_of, keep), VIEW, fan)


def open_transport_stream(events: DataFrame, folder: str, as_of: datetime, **options) -> DataStreamWriter:
    return events.writeStream.foreachBatch(lambda batch, epoch: add_batch(batch, epoch, folder, as_of, **options))


def open_counts(spark: SparkSession, folder: str, as_of: datetime,
                kpis: Sequence[c.TransportKpi] = c.TRANSPORT_KPIS) -> DataFrame:
    """The KPIs at a moment, from the open starts: one row per KPI."""
    table = PartTable(spark, folder)
    view = table.read(of_kind(table.contents(), VIEW))
    names = spark.range(1).select(F.explode(F.array(*[F.lit(kpi.name) for kpi in kpis])).alias("kpi"))
    if view is None:
        return names.withColumn("open_starts", F.lit(0).cast("bigint"))
    rows = view.groupBy(*START).agg(F.sum("n").alias("n")).where("n <> 0")
    inside, number = F.lit(False), F.lit(None).cast("bigint")
    for kpi in kpis:
        mine = F.col("kpi") == kpi.name
        inside = inside | (mine & rolling_window(F.col("started"), as_of, kpi.days))
        number = F.when(mine, F.countDistinct("token") if kpi.distinct else F.sum("n")).otherwise(number)
    counts = rows.where(inside).groupBy("kpi").agg(number.alias("open_starts"))
    return names.join(counts, "kpi", "left").withColumn(
        "open_starts", F.coalesce("open_starts", F.lit(0).cast("bigint")))
