"""Sinks that may be run again, and streams that agree with the batch reports."""

import os
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures.views import spark_view
from palletrail.operators.legs import LegFilter, scan_conditions
from palletrail.operators.skew import with_position
from palletrail.plans import receive, transport
from palletrail.sources import readers, sinks
from palletrail.sources.parts import PartTable
from palletrail.streaming import board, changes, ingest, open_state

SF_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_by_key_replaces_only_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "day string, v int").select("v", "day")
    sinks.replace_by_key(frame, path, "day")
    sinks.replace_by_key(frame.where("day = 'a' and v = 3"), path, "day")
    sinks.replace_by_key(frame.where("day = 'a' and v = 3"), path, "day")
    sinks.replace_by_key(frame.where("false"), path, "day")
    assert rows(spark.read.parquet(path)) == [(2, "b"), (3, "a")]


def test_rotation_keeps_one_version_back(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2, 3):
        sinks.rotate_snapshot(spark.createDataFrame([(v,)], "v int"), path, "r", "05.2025")
    assert sinks.rotate_snapshot(spark.createDataFrame([(9,)], "v int"), path, "r", "06.2025") == 1
    stored = sinks.read_snapshots(spark, path)
    assert rows(stored.select("month", "version", "v")) == [
        ("05.2025", "current", 3), ("05.2025", "previous", 2), ("06.2025", "current", 9)]


def test_append_new_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, v int")
    sinks.append_new_keys(first, path, "k", [F.col("v")])
    sinks.append_new_keys(first.union(spark.createDataFrame([("c", 5)], "k string, v int")), path, "k", [F.col("v")])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 1), ("c", 5)]


def test_full_refresh_keeps_the_table_when_there_is_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1,)], "v int")
    assert sinks.full_refresh(frame, path) == 1
    with pytest.raises(ValueError):
        sinks.full_refresh(frame.where("false"), path)
    with pytest.raises(Exception):
        sinks.full_refresh(frame.select(F.raise_error(F.lit("killed")).cast("int").alias("v")), path)
    assert rows(sinks.read_refreshed(spark, path)) == [(1,)]


def test_a_change_is_seen_whole_or_not_at_all(spark, tmp_path):
    """A run that ends between its write and its change, and two writers that meet."""
    path = str(tmp_path / "t")
    one, other = PartTable(spark, path), PartTable(spark, path)
    assert one.read() is None and one.contents().number == 0
    first = one.write(spark.range(3), kind="a")
    assert one.read() is None
    one.change(lambda now: now.but(new=[first]))
    reader, held = one.contents(), one.read()
    second = one.write(spark.range(10, 12), kind="b")
    assert rows(other.read()) == [(0,), (1,), (2,)] and second.rows == 2

    tries = []

    def slow(now):
        tries.append(now.number)
        if len(tries) == 1:
            other.change(lambda late: late.but(new=[second]))
        return now.but(gone=[first])

    assert one.change(slow).number == 3 and tries == [1, 2]
    assert rows(one.read()) == [(10,), (11,)] and not one._put(reader)
    assert rows(held) == [(0,), (1,), (2,)]
    one.vacuum(keep=1)
    assert rows(other.read()) == [(10,), (11,)] and not os.path.exists(f"{path}/{first.name}")
    assert one.write(spark.range(0)).rows == 0


def in_slices(spark, frame, folder, slices):
    """Write the frame as one file per slice, and stream them one file at a time."""
    for i, condition in enumerate(slices):
        frame.where(condition).coalesce(1).write.parquet(f"{folder}/in/{i}")
    return (spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(f"{folder}/in"))


@pytest.fixture
def transports(spark):
    return spark_view(spark, SF_DIR, "transport")


def test_board_stream_equals_batch(spark, transports, tmp_path):
    stream = in_slices(spark, transports, tmp_path, ["sequence % 3 = 0", "sequence % 3 = 1", "sequence % 3 = 2"])
    out = f"{tmp_path}/out"
    changes.run_available(board.kpi_board_stream(stream, out, lambda: AS_OF), f"{tmp_path}/cp")
    assert PartTable(spark, f"{out}/state").contents().notes["epoch"] == 2
    assert rows(board.read_board(spark, out)) == rows(transport.kpi_board(transports, AS_OF))


def test_view_equals_batch_after_each_epoch(spark, transports, tmp_path):
    """Completions arrive before and after their starts; every epoch is delivered twice, and parts are merged on the way."""
    slices = ["typ_id <> 42 and sequence % 3 = 0", "typ_id = 42 and sequence % 2 = 0", "typ_id <> 42 and sequence % 3 = 1",
              "typ_id = 42 and sequence % 2 = 1", "typ_id <> 42 and sequence % 3 = 2"]
    seen = None
    for epoch, condition in enumerate(slices):
        batch = transports.where(condition)
        seen = batch if seen is None else seen.union(batch)
        for _ in range(2):
            open_state.add_batch(batch, epoch, f"{tmp_path}/state", AS_OF, buckets=4, fan=2)
        counts = {r["kpi"]: r["open_starts"] for r in open_state.open_counts(spark, f"{tmp_path}/state", AS_OF).collect()}
        wanted = transport.kpi_board(seen, AS_OF).first().asDict()
        assert counts == {name: wanted[name] for name in counts} and len(counts) == 6
    contents = PartTable(spark, f"{tmp_path}/state").contents()
    assert {part.labels["level"] for part in changes.of_kind(contents, "state")} & {1, 2}


def test_a_batch_reads_the_buckets_of_its_carriers(spark, transports, tmp_path):
    state = f"{tmp_path}/state"
    open_state.add_batch(transports, 0, state, AS_OF)
    carrier = transports.where("typ_id = 42").first()["transportlhmnr"]
    table = PartTable(spark, state)
    new = open_state.open_transport_state(transports.where(F.col("transportlhmnr") == carrier))
    bucket = new.select(open_state.bucket_of(F.col("carrier")).alias("b")).distinct().collect()
    old = table.read(changes.of_kind(table.contents(), "state")).where(F.col("bucket").isin([r["b"] for r in bucket]))
    plan = old.select("n")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ (IN|=|INSET)", plan), plan


def test_expired_starts_and_closings_leave_the_store(spark, tmp_path):
    """Carriers come back every few days over weeks; the store holds the last days, and counts what a full one counts."""
    day = lambda d, h: datetime(2024, 1, 1) + timedelta(days=d, hours=h)
    keep, kept = timedelta(days=3), []
    for d in range(0, 72, 6):
        events = []
        for e in range(6):
            for i in range(20):
                lhm, zug = str(i), f"Z{i % 3}"
                start = (42, lhm, lhm, zug, day(d + e, i % 24), "BGL1", "FIN_AP02", "BSF_OV", None, f"T{i}", "BESTANDFREIGABE")
                events.append(start)
                if (i + d + e) % 4 == 0:
                    events.append((47 if i % 2 else 39, lhm, lhm, zug, day(d + e, i % 24 + 1), "X", "X", "X", None, None, None))
        batch = spark.createDataFrame(events, "typ_id int, lhmnr string, transportlhmnr string, zug_id string, created timestamp_ntz, "
                                      "transporttaskquelle string, transporttaskziel string, transportrequestziel string, lagbez string, "
                                      "zuggruppe_token string, zuggruppe_sender string")
        as_of = day(d + 6, 0)
        open_state.add_batch(batch, d, f"{tmp_path}/a", as_of, keep=keep, buckets=2, fan=2)
        if d % 18 == 0 or d == 66:
            table = PartTable(spark, f"{tmp_path}/a")
            kept.append(sum(part.rows for part in table.contents().parts))
        if d >= 54:
            open_state.add_batch(batch, d, f"{tmp_path}/b", as_of, keep=keep, buckets=2, fan=99)
    assert kept[-1] <= max(kept[1:3]) < 2500, kept
    assert rows(open_state.open_counts(spark, f"{tmp_path}/a", as_of)) == rows(open_state.open_counts(spark, f"{tmp_path}/b", as_of))


def test_ingest_takes_every_row_once(spark, tmp_path):
    ledger = spark_view(spark, SF_DIR, "ledger")
    for i in range(2):
        ledger.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = (spark.readStream.schema(ledger.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
              .parquet(f"{tmp_path}/in"))
    changes.run_available(ingest.ledger_ingest_dedup(stream, f"{tmp_path}/out"), f"{tmp_path}/cp")
    kept = ingest.read_ingested(spark, f"{tmp_path}/out")
    assert kept.count() == ledger.distinct().count() and kept.where("menge < 0").count() == ledger.where("menge < 0").distinct().count()
    assert rows(receive.uph_kpis(kept)) == rows(receive.uph_kpis(ledger.distinct()))


def test_back_fill_of_three_years_and_a_replay(spark, tmp_path):
    """A batch over 1,100 days writes a file per bucket, a replay writes none, and later days read their own buckets."""
    def booked(first, days):
        return spark.range(first * 10, (first + days) * 10).select(
            F.col("id").alias("sequence"), (F.lit(datetime(2021, 1, 1)) + F.make_dt_interval(F.floor(F.col("id") / 10).cast("int"))).cast("timestamp_ntz").alias("created"),
            F.concat(F.lit("t"), F.col("id") % 7).alias("local_transaction_id"))

    folder = f"{tmp_path}/out"
    for i, batch in enumerate([booked(0, 1100), booked(0, 1100), booked(1095, 10), booked(1104, 2), booked(1104, 2)]):
        batch.write.parquet(f"{tmp_path}/in/{i}")
    for i in range(5):  # one micro-batch per delivery, whatever its number of files
        stream = spark.readStream.schema(booked(0, 1).schema).parquet(f"{tmp_path}/in/{i}")
        changes.run_available(ingest.ledger_ingest_dedup(stream, folder, buckets=8, fan=3), f"{tmp_path}/cp{i}")
        table = PartTable(spark, folder)
        files = [len(table.read([part]).inputFiles()) for part in table.contents().parts]
        assert max(files) <= 8 and len(files) == [1, 1, 2, 1, 1][i]
    assert rows(ingest.read_ingested(spark, folder)) == rows(booked(0, 1106))


def test_window_counts_are_merged_level_by_level(spark, tmp_path):
    ledger = spark_view(spark, SF_DIR, "ledger")
    stream = in_slices(spark, ledger, tmp_path, [f"sequence % 5 = {i}" for i in range(5)])
    changes.run_available(ingest.shift_window_stream(stream, f"{tmp_path}/w", fan=2), f"{tmp_path}/cp")
    assert len(PartTable(spark, f"{tmp_path}/w").contents().parts) == 2
    assert rows(ingest.read_shift_windows(spark, f"{tmp_path}/w")) == rows(ingest.shift_window_counts(ledger))


def test_closings_of_other_carriers_are_left_out_first(transports):
    """The semi join with the recent starts stands below the aggregate of the closings."""
    plan = transport.kpi_board(transports, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("max(") < plan.index("LeftSemi")


def test_snapshot_marks_what_fails(spark, transports):
    registry = transport.default_registry()
    registry.register_kpi("broken", lambda ledger, as_of: ledger.select("nothing_like_it"))
    registry.register_kpi("empty", lambda ledger, as_of: ledger.where("false").select("sequence"))
    row = registry.snapshot(spark, transports, AS_OF).first()
    assert row["failed"] == "broken: AnalysisException" and row["broken"] is None and row["empty"] == 0
    board_row = transport.kpi_board(transports, AS_OF).first()
    assert all(row[kpi] == board_row[kpi] for kpi in ("we_bgl", "open_orders"))


def test_snapshot_is_one_plan_unless_a_kpi_fails(spark, transports):
    """A KPI that fails only when it runs is told, and the others keep their numbers."""
    registry = transport.default_registry()
    good = registry.snapshot(spark, transports, AS_OF).first().asDict()
    registry.register_kpi("late", lambda ledger, as_of: ledger.select(F.raise_error(F.lit("late")).cast("double")))
    row = registry.snapshot(spark, transports, AS_OF).first().asDict()
    assert row.pop("failed") == "late: SparkRuntimeException" and row.pop("late") is None and good.pop("failed") == ""
    assert row == good and set(good.values()) != {0.0}


def test_conditions_on_text_reach_the_scan_through_the_reader(spark, tmp_path):
    ledger = spark_view(spark, SF_DIR, "ledger")
    blank = ledger.limit(50).withColumns({"lagbez": F.lit(""), "ziel": F.lit(""), "lhmnr": F.lit("")})
    ledger.unionByName(blank).write.parquet(f"{tmp_path}/raw")
    source = spark.read.parquet(f"{tmp_path}/raw")
    only = scan_conditions(LegFilter()) | {"ziel": lambda c: c.startswith("OV"), "lhmnr": lambda c: c != "4000001"}
    read = readers.read_ledger(source, only=only)
    pushed = spark._jvm.PythonSQLUtils.explainString(read.select("sequence")._jdf.queryExecution(), "formatted")
    assert all(name in pushed for name in ("In(lagbez", "StringStartsWith(ziel,OV)", "Not(EqualTo(lhmnr,4000001))", "Not(EqualTo(ziel,))"))
    plain = readers.read_ledger(source).where(F.col("lagbez").isin(*LegFilter().areas) & F.col("ziel").like("OV%") & (F.col("lhmnr") != "4000001"))
    assert rows(read) == rows(plain) != []
    how = LegFilter()
    assert rows(receive.uph_kpis(readers.read_ledger(source, only=scan_conditions(how)), how)) == rows(receive.uph_kpis(ledger, how))


def test_positions_follow_the_order_of_the_frame(spark):
    frame = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(997)).alias("k"), "id")
    placed = with_position(frame.orderBy("k", "id")).orderBy("position").collect()
    assert [(r["k"], r["id"]) for r in placed] == sorted((r["k"], r["id"]) for r in placed)
    assert [r["position"] for r in placed] == list(range(1, 5001))
    assert with_position(frame.where("false").orderBy("k")).count() == 0


def test_starts_leave_the_board_with_age(spark, transports):
    later = transport.kpi_board(transports, AS_OF + timedelta(days=30)).first().asDict()
    assert set(later.values()) - {AS_OF + timedelta(days=30)} == {0}
