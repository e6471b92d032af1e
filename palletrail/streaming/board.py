"""The KPI board on a stream of transport events."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from palletrail import config as c
from palletrail.functions.predicates import stamp
from palletrail.sources import sinks
from palletrail.streaming.open_state import add_batch, open_counts


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def kpi_board_stream(events: DataFrame, folder: str, as_of: Callable[[], datetime] = utc_now, **options) -> DataStreamWriter:
    """Bring the store of open transports up to date with every batch and read the board from its view.

    A trigger reads the state of the carriers its batch mentions and the starts that are open; rows of
    other types never reach the store.  Start the writer with ``processingTime`` of the board period, or with
    ``availableNow`` to catch up.
    """

    def refresh(batch: DataFrame, epoch: int) -> None:
        moment = as_of()
        add_batch(batch, epoch, f"{folder}/state", moment, **options)
        sinks.full_refresh(board_of(batch.sparkSession, f"{folder}/state", moment), f"{folder}/board")

    return events.writeStream.foreachBatch(refresh)


def board_of(spark: SparkSession, state: str, as_of: datetime) -> DataFrame:
    """The open starts as the one row of the board."""
    counts = open_counts(spark, state, as_of)
    names = sorted(kpi.name for kpi in c.TRANSPORT_KPIS)
    return counts.agg(*[F.max(F.when(F.col("kpi") == name, F.col("open_starts"))).alias(name) for name in names]).select(
        stamp(as_of).alias("last_updated"), *names)


def read_board(spark: SparkSession, folder: str) -> DataFrame:
    """The board as of the last batch."""
    return sinks.read_refreshed(spark, f"{folder}/board")
