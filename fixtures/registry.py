"""Registered queries: every report and operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fixtures import oracle
from fixtures.views import spark_view, stream_view
from palletrail import config as c, jobs
from palletrail.functions import predicates, rules, text, times
from palletrail.functions.attributes import json_fields
from palletrail.operators import enrich, legs, transports
from palletrail.operators.skew import with_position
from palletrail.plans import hazard, ideas, orders, outlet, quality, receive, sorting, summary, transport, volumes
from palletrail.session import shared_dir
from palletrail.sources import readers, sinks
from palletrail.streaming import board, changes, ingest, open_state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
VIEWS_OF: dict[str, tuple[str, ...]] = {}

OVERRIDES = {"200000007": "Mixed household lot", "200000013": "Mixed footwear lot"}


def query(name: str, sql: str | None, *views: str):
    """Register a function of the named views under ``name``."""

    def register(build: Callable[..., DataFrame]):
        VIEWS_OF[name] = views
        QUERIES[name] = lambda spark, sf_dir: build(*[spark_view(spark, sf_dir, view) for view in views])
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


# --- Reports on goods received ------------------------------------------------------

query("uph_kpis", oracle.UPH_KPIS, "ledger")(receive.uph_kpis)
query("uph_kpis_by_user", oracle.UPH_KPIS_BY_USER, "ledger")(receive.uph_kpis_by_user)
query("shift_report", oracle.SHIFT_REPORT, "ledger")(receive.shift_report)
query("booking_detail", oracle.BOOKING_DETAIL, "ledger")(receive.booking_detail)
query("booking_detail_numeric", oracle.BOOKING_DETAIL_NUMERIC, "ledger")(receive.booking_detail_numeric)
query("booking_detail_terminal", oracle.BOOKING_DETAIL_TERMINAL, "ledger")(
    lambda ledger: receive.booking_detail_numeric(ledger, first_leg_category=True))
query("monthly_zfs", oracle.MONTHLY_ZFS, "ledger", "brand_dim")(
    lambda ledger, brands: receive.monthly_report(ledger, brands, c.MONTHLY_REPORTS["monthly_zfs"], overrides=OVERRIDES))
query("monthly_beauty", oracle.MONTHLY_BEAUTY, "ledger", "brand_dim")(
    lambda ledger, brands: receive.monthly_report(ledger, brands, c.MONTHLY_REPORTS["monthly_beauty"], overrides=OVERRIDES))
query("receive_volume", oracle.RECEIVE_VOLUME, "ledger")(receive.receive_volume)

# --- Manual sorting -------------------------------------------------------------------

query("manual_sorting", oracle.MANUAL_SORTING, "ledger")(sorting.manual_sorting)

# --- Outlet ---------------------------------------------------------------------------

query("outlet_booking", oracle.OUTLET_BOOKING, "outlet", "stock")(outlet.outlet_booking)
query("outlet_booking_simple", oracle.OUTLET_BOOKING_SIMPLE, "outlet", "stock")(outlet.outlet_booking_simple)


@query("net_join", oracle.NET_JOIN, "outlet")
def net_join(ledger):
    return outlet.booked_and_clarified(ledger, None, None).select(
        "lhmnr", "artnr", F.col("total_booked").cast("bigint"), F.col("total_clarified").cast("bigint"))


query("net_booked", oracle.NET_BOOKED, "outlet")(
    lambda ledger: outlet.net_booked(ledger).select("lhmnr", "artnr", "quantity"))
query("representative", oracle.REPRESENTATIVE, "outlet")(
    lambda ledger: outlet.booked_and_clarified(ledger, None, None).select("lhmnr", "artnr", "created", "cust_data"))
query("having_positive", oracle.HAVING_POSITIVE, "outlet")(
    lambda ledger: outlet.having_positive(ledger, ["lhmnr", "artnr"], "menge", "items"))
query("scalar_lookup", oracle.SCALAR_LOOKUP, "outlet")(outlet.graded_history)
query("first_per_key", oracle.FIRST_PER_KEY, "outlet")(outlet.carrier_history)


@query("or_key_lookup", oracle.OR_KEY_LOOKUP, "outlet", "stock")
def or_key_lookup(ledger, stock):
    rows = ledger.where("typ_id = 102").groupBy("lhmnr", "artnr").agg(F.count("*").alias("n"))
    return rows.join(outlet.or_key_lookup(stock).withColumnRenamed("lc", "lhmnr"), "lhmnr", "left")


query("best_grade_dedup", oracle.BEST_GRADE, "stock")(outlet.best_grade_dedup)


@query("stock_quality_join", oracle.STOCK_QUALITY, "outlet", "stock")
def stock_quality_join(ledger, stock):
    rows = ledger.where("typ_id = 103").groupBy("lhmnr", "artnr").agg(F.count("*").alias("n"))
    return rows.join(outlet.best_grade_dedup(stock).withColumnRenamed("lc", "lhmnr"), ["lhmnr", "artnr"], "left")


query("unpivot_carriers", oracle.UNPIVOT, "stock")(lambda stock: outlet.unpivot_carriers(stock, "artnr", "quality"))


@query("union_net_clarified", oracle.UNION_NET, "outlet", "stock")
def union_net_clarified(ledger, stock):
    items = outlet.net_items(ledger, None, None).unionByName(outlet.clarified_items(ledger, stock, None, None))
    flag = rules.clarification_flag(F.col("origin")).alias("clarification")
    return items.groupBy(flag, "fallback").agg(F.sum("quantity").alias("items"))


QUERIES["clarification_flag"], ORACLE["clarification_flag"] = QUERIES["union_net_clarified"], ORACLE["union_net_clarified"]


@query("grade_fallback4", oracle.GRADE_FALLBACK, "outlet", "stock")
def grade_fallback4(ledger, stock):
    return outlet.clarified_items(ledger, stock, None, None).groupBy("lc", "ean", "fallback").agg(
        F.sum("quantity").alias("quantity"))


@query("params_cross", oracle.PARAMS_CROSS, "outlet")
def params_cross(ledger):
    rows = outlet.booked_and_clarified(ledger, datetime(1997, 1, 1), None)
    return rows.select("lhmnr", "artnr", F.col("total_booked").cast("bigint"))


@query("open_window", oracle.OPEN_WINDOW, "outlet")
def open_window(ledger):
    rows = predicates.keep(ledger, predicates.open_window(F.col("created"), None, datetime(1998, 6, 30, 12)))
    return rows.groupBy("typ_id").agg(F.count("*").alias("n"), F.sum("menge").alias("quantity"))


# --- Volumes ----------------------------------------------------------------------------

WINDOW = (datetime(1995, 6, 1), datetime(2001, 5, 31, 23, 59, 59))
query("inbound_lines", oracle.INBOUND_LINES, "inbound")(lambda ledger: volumes.inbound_lines(ledger, *WINDOW))
query("sorter_volume", oracle.SORTER_VOLUME, "inbound")(lambda ledger: volumes.sorter_volume(ledger, *WINDOW))

# --- Transport ---------------------------------------------------------------------------

AS_OF = datetime(2024, 1, 31)
for kpi in c.TRANSPORT_KPIS:
    query(kpi.name, oracle.TRANSPORT_KPI[kpi.name], "transport")(
        lambda ledger, kpi=kpi: transports.count_open(ledger, kpi, AS_OF))
query("count_open", oracle.TRANSPORT_KPI["bgl_bsf_ov"], "transport")(
    lambda ledger: transport.transport_kpi(ledger, "bgl_bsf_ov", AS_OF))
query("count_distinct_open", oracle.TRANSPORT_KPI["open_orders"], "transport")(
    lambda ledger: transport.transport_kpi(ledger, "open_orders", AS_OF))
query("kpi_board", oracle.KPI_BOARD, "transport")(lambda ledger: transport.kpi_board(ledger, AS_OF))


def kpi_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = transport.default_registry()
    registry.register_kpi("broken", lambda ledger, as_of: ledger.select("no_such_column"))
    registry.register_kpi("failing", lambda ledger, as_of: ledger.select(F.when(F.col("sequence").isNotNull(), F.raise_error(F.lit("late"))).cast("double")))
    return registry.snapshot(spark, spark_view(spark, sf_dir, "transport"), AS_OF)


QUERIES["kpi_snapshot"], ORACLE["kpi_snapshot"] = kpi_snapshot, oracle.KPI_SNAPSHOT


def open_rows(name: str, operator: str, as_of: datetime | None = AS_OF) -> None:
    sql = oracle.KPI_ROWS[name] if as_of else oracle.OPEN_ANY_AGE
    query(operator, sql, "transport")(
        lambda ledger: transports.open_starts(ledger, transport.BY_NAME[name], as_of)
        .select("sequence", "transportlhmnr", "zug_id", "created"))


open_rows("we_bgl", "open_starts_antijoin")
open_rows("bgl_bsf_ov", "open_starts_temporal", None)
open_rows("open_positions", "self_antijoin")


@query("rolling_window", oracle.ROLLING_WINDOW, "transport")
def rolling_window(ledger):
    tests = {days: predicates.rolling_window(F.col("created"), AS_OF, days) for days in (2, 5, 7)}
    counts = ledger.agg(*[F.count_if(test).alias(str(days)) for days, test in tests.items()])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(days).alias("days"), F.col(str(days)).alias("n")) for days in tests])).alias("r")).select("r.*")


query("nullable_exclude", oracle.NULLABLE_EXCLUDE, "transport")(
    lambda ledger: ledger.where(predicates.nullable_exclude(F.col("lagbez"), "AKL"))
    .groupBy("lagbez").agg(F.count("*").alias("n")))
query("distinct_rows", oracle.DISTINCT_ROWS, "transport")(
    lambda ledger: ledger.where("typ_id = 47").select("transportlhmnr", "zug_id").distinct())

# --- Hazardous stock -------------------------------------------------------------------------

CLASSES = [("UN1950", "2.1", 1e9), ("UN1266", "3", 5e9), ("UN1170", "3", 1e6)]


def merged(stock: DataFrame, units: DataFrame) -> DataFrame:
    classes = stock.sparkSession.createDataFrame(CLASSES, "un_no string, hazard_class string, volume_limit double")
    return hazard.hazard_merge(stock, units, classes)


query("stock_by_category", oracle.STOCK_BY_CATEGORY, "stock_volume")(
    lambda stock: hazard.stock_by_category(stock, "Beauty").groupBy("place", "channel", "carrier")
    .agg(F.count("*").alias("n")))
query("hazard_stock", oracle.HAZARD_STOCK, "stock_volume")(lambda stock: hazard.hazard_stock(stock, "Beauty"))
query("total_and_ready_volume", oracle.TOTAL_READY, "stock_volume")(hazard.total_and_ready_volume)


@query("mask_and", oracle.MASK_AND, "stock_volume")
def mask_and(stock):
    ready = predicates.mask_ready(F.col("channel"), F.col("place"), F.col("carrier"))
    return stock.groupBy("channel", "place", ready.alias("ready")).agg(F.count("*").alias("n"))


query("hazard_merge", oracle.HAZARD_MERGE, *oracle.HAZARD)(
    lambda stock, units: merged(stock, units).groupBy("un_no", "hazard_class")
    .agg(F.count("*").alias("n"), F.sum("volume").alias("volume")))
query("hazard_volume_rollup", oracle.HAZARD_ROLLUP, *oracle.HAZARD)(
    lambda stock, units: hazard.hazard_volume_rollup(merged(stock, units)))
query("hazard_drill_down", oracle.HAZARD_DRILL, *oracle.HAZARD)(
    lambda stock, units: hazard.drill_down(merged(stock, units)))
query("hazard_compliance", oracle.HAZARD_COMPLIANCE, *oracle.HAZARD)(
    lambda stock, units: hazard.hazard_compliance(merged(stock, units)))

# --- Audits ------------------------------------------------------------------------------------

AUDITS = ("A_F", "A_O", "N_F", "N_O", "R_F", "R_O")


def audit_sources(audit: DataFrame) -> dict[str, DataFrame]:
    """One table per audit source, as the site delivers them; those of the first kind have no bucket."""
    of = {name: audit.where(F.col("sub_process") == name) for name in AUDITS}
    return {name: rows.drop("bucket") if name.startswith("A") else rows for name, rows in of.items()}


query("multi_source_audit", oracle.MULTI_SOURCE, "audit")(
    lambda audit: quality.multi_source_audit(audit_sources(audit)).groupBy("source", "bucket")
    .agg(F.count("*").alias("n"), F.sum("defects").alias("defects")))
query("dpmi_score", oracle.DPMI_SCORE, "audit")(quality.dpmi_score)
query("quality_score", oracle.QUALITY_SCORE, "audit")(quality.quality_score)

# --- Orders ----------------------------------------------------------------------------------------

query("order_duration", oracle.ORDER_DURATION, *oracle.ORDER_TABLES)(orders.order_duration)
query("interval_congestion", oracle.INTERVAL_CONGESTION, *oracle.ORDER_TABLES)(
    lambda *tables: orders.order_duration(*tables).select("order_no", *[route.name for route in c.ROUTES]))


@query("max_if", oracle.MAX_IF, *oracle.ORDER_TABLES)
def max_if(log, status, monitor):
    timed = monitor.join(orders.carton_times(log), "carton", "left")
    return timed.groupBy("order_no").agg(F.max("released").alias("start"), F.max("arrived").alias("end"))


query("first_match_lookup", oracle.FIRST_MATCH, "order_status")(orders.order_sizes)
query("duration_metrics", oracle.DURATION_METRICS, *oracle.ORDER_TABLES)(
    lambda *tables: orders.order_windows(*tables).withColumns(orders.duration_metrics())
    .select("order_no", "duration_s", "seconds_per_colli", "colli_per_minute", "seconds_per_pallet", "shift"))


@query("congestion_correlation", oracle.CORRELATION, *oracle.ORDER_TABLES)
def congestion_correlation(*tables):
    result = orders.congestion_correlation(orders.order_duration(*tables))
    return result.select("orders", *[F.round(route.name, 9).alias(route.name) for route in c.ROUTES])


@query("append_new_keys", oracle.APPEND_NEW_KEYS, "order_monitor", "order_status")
def append_new_keys(monitor, status):
    archive = status.where("status = 'Angelegt'")
    return sinks.new_keys(monitor, archive, "order_no", [F.col("carton")]).select("order_no", "carton")


# --- Ideas -------------------------------------------------------------------------------------------

query("translation_pending", oracle.TRANSLATION_PENDING, "intake")(ideas.translation_pending)


def notification_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("number"))
    return ideas.notification_outbox(spark_view(spark, sf_dir, "intake"), sent)


VIEWS_OF["notification_outbox"] = ("intake",)
QUERIES["notification_outbox"], ORACLE["notification_outbox"] = notification_outbox, oracle.NOTIFICATION_OUTBOX
query("reward_digest", oracle.REWARD_DIGEST, "scoreboard")(ideas.reward_digest)
query("ticket_format", oracle.TICKET_FORMAT, "intake")(
    lambda intake: intake.select(
        "ticket", text.ticket_format(text.ticket_number(F.col("ticket")), c.TICKET_PREFIX).alias("ticket_id")))
query("name_from_mail", oracle.NAME_FROM_MAIL, "scoreboard")(
    lambda board: board.select("mail", text.name_from_mail(F.col("mail")).alias("first_name")))

# --- Single operators over the ledger -------------------------------------------------

YEAR = (datetime(1997, 1, 1), datetime(1997, 12, 31, 23, 59, 59))
HOW = legs.LegFilter()


def tally(df: DataFrame, *columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def all_pairs(ledger: DataFrame, numeric: bool = False) -> DataFrame:
    return legs.pair_legs(legs.out_legs(ledger, HOW), legs.in_legs(ledger, HOW), numeric)


query("read_ledger", oracle.READ_LEDGER, "ledger")(
    lambda ledger: readers.read_ledger(
        ledger, *YEAR, columns=["local_transaction_id", "sequence", "tpartnr", "menge", "created"]))
query("dimension_dedup", oracle.DIMENSION_DEDUP, "brand_dim")(
    lambda brands: enrich.dimension_dedup(brands, "ean", "brand_name"))
query("enrich_dimension", oracle.ENRICH, "ledger", "brand_dim")(
    lambda ledger, brands: enrich.enrich_dimension(
        tally(ledger, F.col("artnr").alias("ean")), brands, "ean", "brand_name", OVERRIDES, c.NO_BRAND))
query("select_rename_reorder", oracle.SELECT_RENAME, "ledger")(
    lambda ledger: enrich.select_rename(
        ledger, {"artnr": "article", "menge": "quantity", "missing": "missing", "ziel": "place"}))


@query("leg_select", oracle.LEG_SELECT, "ledger")
def leg_select(ledger):
    outs = legs.out_legs(ledger, HOW).select("good_type", F.lit("out").alias("side"), "quantity")
    ins = legs.in_legs(ledger, HOW).select("good_type", F.lit("in").alias("side"), F.lit(1).alias("quantity"))
    return outs.unionByName(ins).groupBy("good_type", "side").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


query("between_window", oracle.BETWEEN_WINDOW, "ledger")(
    lambda ledger: tally(ledger.where(predicates.between_window(F.col("created"), *YEAR)), "tpartnr"))

REF_FILTERS = {"all": None, "pattern": "ay%", "list": "z1,AY3,7", "value": "z5", "both": "z%,7"}


@query("ref_filter", oracle.REF_FILTER, "ledger")
def ref_filter(ledger):
    rows = json_fields(ledger, ["reference"])
    tests = {
        name: F.lit(True) if wanted is None else predicates.ref_filter(F.col("reference"), wanted)
        for name, wanted in REF_FILTERS.items()
    }
    counts = rows.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    return counts.unpivot([], list(tests), "filter", "n")


@query("self_transfer_drop", oracle.SELF_TRANSFER, "ledger")
def self_transfer_drop(ledger):
    key = "local_transaction_id"
    outs = ledger.where("menge < 0").select(key, F.col("lhmnr").alias("source_lhm"))
    ins = ledger.where("menge = 1").select(key, F.col("lhmnr").alias("ziel_lhm"))
    kept = outs.join(ins, key).where(predicates.self_transfer_drop(F.col("source_lhm"), F.col("ziel_lhm")))
    return tally(kept, "source_lhm", "ziel_lhm")


query("numeric_target", oracle.NUMERIC_TARGET, "ledger")(
    lambda ledger: tally(ledger.where(predicates.numeric_target(F.col("lhmnr"))), "lhmnr"))
query("prefix_guard", oracle.PREFIX_GUARD, "ledger")(
    lambda ledger: tally(
        ledger.where(predicates.has_prefix(F.col("lhmnr"), ("4", "5")) & ~F.col("lhmnr").like("000%")), "lhmnr"))


@query("report_predicate", oracle.REPORT_PREDICATE, "ledger")
def report_predicate(ledger):
    rows = receive.booking_detail_numeric(ledger)
    counts = rows.agg(*[
        F.count_if(predicates.report_predicate(report.where)).alias(name) for name, report in c.MONTHLY_REPORTS.items()])
    return counts.unpivot([], list(c.MONTHLY_REPORTS), "report", "n")


query("ean_two_step", oracle.EAN_TWO, "ledger")(lambda ledger: tally(receive.booking_detail_numeric(ledger), "ean"))
query("ean_three_step", oracle.EAN_THREE, "ledger")(lambda ledger: tally(sorting.manual_sorting(ledger), "ean"))
query("by_origin_field", oracle.BY_ORIGIN, "ledger")(
    lambda ledger: tally(receive.booking_detail_numeric(ledger), "sku", "sort_id"))
query("pair_legs", oracle.PAIR_LEGS, "ledger")(
    lambda ledger: all_pairs(ledger).groupBy("good_type", "source_lhm", "ziel_lhm")
    .agg(F.count("*").alias("pairs"), F.sum("quantity").alias("quantity")))
query("pair_legs_sequenced", oracle.PAIR_SEQUENCED, "ledger")(
    lambda ledger: legs.pair_legs_sequenced(ledger, HOW).groupBy("good_type", "source_lhm", "ziel_lhm")
    .agg(F.count("*").alias("pairs")))
query("union_goods", oracle.UNION_GOODS, "ledger")(
    lambda ledger: legs.pair_totals(legs.out_legs(ledger, HOW), legs.in_legs(ledger, HOW), [], ["good_type"], [],
                                    {"good_type": F.col("good_type")})
    .groupBy("good_type").agg(F.sum("pairs").alias("pairs"), F.sum("quantity").alias("quantity")))


@query("pair_totals_hot", oracle.PAIR_TOTALS_HOT, "ledger")
def pair_totals_hot(ledger):
    """A third of all legs, out and in, are of one transaction."""
    hot = ledger.withColumn(legs.KEY, F.when(F.col("sequence") % 3 == 0, "hot").otherwise(F.col(legs.KEY)))
    totals = legs.pair_totals(legs.out_legs(hot, HOW), legs.in_legs(hot, HOW), [], ["good_type"], [], {"good_type": F.col("good_type")})
    return totals.groupBy("good_type").agg(F.sum("pairs").alias("pairs"), F.sum("quantity").alias("quantity"))


@query("sequence_index", oracle.SEQUENCE_INDEX, "ledger")
def numbered_legs(ledger):
    outs, _ = legs.sorting_legs(ledger, HOW)
    return legs.number_dummies(outs).where("good_type = 'DUMMY'").select(
        "local_transaction_id", "sequence", "artnr", "created", "rn")


query("kpi_pivot", oracle.UPH_KPIS, "ledger")(receive.uph_kpis)
query("kpi_pivot_user", oracle.UPH_KPIS_BY_USER, "ledger")(receive.uph_kpis_by_user)
query("volume_by_day", oracle.RECEIVE_VOLUME, "ledger")(receive.receive_volume)


@query("report_sort", oracle.REPORT_SORT, "ledger")
def report_sort(ledger):
    """The report with the place at which its order puts each row, the same for rows that tie."""
    placed = with_position(receive.shift_report(ledger))
    tied = Window.partitionBy("date", "shift", "reference")
    return placed.withColumn("position", F.min("position").over(tied))


query("json_fields", oracle.JSON_FIELDS, "ledger")(
    lambda ledger: tally(json_fields(ledger), *c.ATTRIBUTE_KEYS))
query("grade_single", oracle.GRADE_SINGLE, "ledger")(
    lambda ledger: tally(all_pairs(ledger).where("good_type = 'NORMAL'"), receive.quality().alias("quality")))
query("grade_dual", oracle.GRADE_DUAL, "ledger")(
    lambda ledger: tally(all_pairs(ledger).where("good_type = 'DUMMY'"), receive.quality().alias("quality")))


@query("grade_plain", oracle.GRADE_PLAIN, "ledger")
def grade_plain(ledger):
    code = F.col("grade_sector")
    return tally(json_fields(ledger, ["grade_sector"]), code.alias("code"), rules.grade_plain(code).alias("grade"),
                 rules.grade_plain(code, None).alias("grade_or_null"))


query("category_map", oracle.CATEGORY_MAP, "ledger")(
    lambda ledger: tally(
        all_pairs(ledger), receive.category().alias("category"), receive.category(True).alias("first_leg"),
        rules.category_map(F.col("out_category_id"), None).alias("or_null")))
query("source_channel_map", oracle.SOURCE_MAP, "ledger")(
    lambda ledger: tally(
        all_pairs(ledger), receive.source_channel().alias("source_channel"),
        rules.source_channel_map(F.col("out_source_id"), c.SORTING_SOURCE_DEFAULT).alias("sorting_channel")))
query("distribution_rules", oracle.DISTRIBUTION, "ledger")(
    lambda ledger: tally(
        all_pairs(ledger), *[receive.distribution_channel(name).alias(name) for name in ("base", "detail", "kpi")]))
query("shift_of", oracle.SHIFT_OF, "ledger")(
    lambda ledger: tally(
        ledger, times.shift_of(F.col("created")).alias("shift"),
        F.when(times.in_shift(times.seconds_of_day(F.col("created")), c.ORDER_SHIFT_ONE), 1).otherwise(2)
        .alias("order_shift"),
        times.shift_of(F.col("created"), zone=c.SITE_ZONE).alias("local_shift")))
query("date_parts", oracle.DATE_PARTS, "ledger")(
    lambda ledger: tally(
        ledger, times.iso_day(F.col("created")).alias("iso_day"), times.day_text(F.col("created")).alias("day_text"),
        times.month_key(F.col("created")).alias("month_key"), times.stamp_text(F.col("created")).alias("stamp_text"),
        times.stamp_to_date(times.stamp_text(F.col("created"))).alias("day")))


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.to_date("l_shipdate").alias("day")).distinct()


def utc_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = times.utc_window(F.col("day"))
    return ship_days(spark, sf_dir).select("day", start.alias("start_utc"), end.alias("end_utc"))


def month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end, month = times.month_window(F.col("day"))
    return ship_days(spark, sf_dir).select(
        start.alias("start_utc"), end.alias("end_utc"), month.alias("month")).distinct()


def week_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship_days(spark, sf_dir).select("day", times.week_number(F.col("day")).alias("week"))


QUERIES["utc_window"], ORACLE["utc_window"] = utc_window, oracle.UTC_WINDOW
QUERIES["month_window"], ORACLE["month_window"] = month_window, oracle.MONTH_WINDOW
QUERIES["week_number"], ORACLE["week_number"] = week_number, oracle.WEEK_NUMBER

query("num_clean", oracle.NUM_CLEAN, "stock_volume")(
    lambda stock: tally(stock, "volume_text", text.num_clean(F.col("volume_text")).alias("volume")))
query("null_to_blank", oracle.NULL_TO_BLANK, "stock")(
    lambda stock: tally(
        stock, text.null_to_blank(F.col("sublhm")).alias("sublhm"), text.null_to_blank(F.col("quality")).alias("quality"),
        text.null_to_zero(F.when(F.col("quality") == "A", 1)).alias("is_a")))
query("basic_scalars", oracle.BASIC_SCALARS, "ledger")(
    lambda ledger: ledger.groupBy(
        F.upper("ziel").alias("upper_ziel"), F.lower("lagbez").alias("lower_lagbez"),
        F.trim(F.concat(F.lit(" "), "lhmnr", F.lit(" "))).alias("trimmed"), F.instr("ziel", "_").alias("position"),
        F.concat(F.lit("KF_"), "ziel").alias("joined")).agg(F.sum(F.abs("menge")).alias("quantity")))
query("run_summary", oracle.RUN_SUMMARY, "ledger", "stock")(
    lambda ledger, stock: summary.run_summary(
        {"bookings": (receive.booking_detail(ledger), "quantity"),
         "stock": (outlet.unpivot_carriers(stock, "artnr", "quality"), None)}, AS_OF))

# --- Sinks: each is run twice and read back ------------------------------------------------


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "replace")
    days = spark_view(spark, sf_dir, "ledger").groupBy(F.year("created").alias("year"), F.to_date("created").alias("day"),
                                                       "tpartnr").agg(F.sum("menge").alias("quantity"))
    sinks.replace_by_key(days.withColumn("quantity", F.lit(0).cast("bigint")), path, "year")
    sinks.replace_by_key(days, path, "year")
    sinks.replace_by_key(days.where("false"), path, "year")
    return spark.read.parquet(path).select("day", "tpartnr", "quantity")


def rotate_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ledger = new_folder(spark, "rotate"), spark_view(spark, sf_dir, "ledger")
    runs = (ledger.where("menge > 0"), ledger.where("menge < 0"), ledger)
    for rows in runs:
        sinks.rotate_snapshot(tally(rows, "tpartnr"), path, "kpis", "04.2026")
    return sinks.read_snapshots(spark, path)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ledger = new_folder(spark, "refresh"), spark_view(spark, sf_dir, "ledger")
    sinks.full_refresh(tally(ledger, "tpartnr"), path)
    sinks.full_refresh(tally(ledger, "lagbez"), path)
    return sinks.read_refreshed(spark, path)


# --- Jobs: days loaded in turn, the first one twice ---------------------------------------------

JOB_DAYS = [date(1995, 4, 5), date(1998, 12, 25), date(2000, 4, 11)]


def nightly_kpis_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, ledger = new_folder(spark, "nightly"), spark_view(spark, sf_dir, "ledger")
    for day in [*JOB_DAYS, JOB_DAYS[0]]:
        jobs.nightly_kpis(ledger, day, folder, AS_OF)
    columns = ", ".join(f"`{name}` {kind}" for name, kind in receive.uph_kpis(ledger).dtypes)
    return sinks.read_stored(spark, f"{folder}/uph_kpis", columns)


QUERIES["nightly_kpis_job"], ORACLE["nightly_kpis_job"] = nightly_kpis_job, oracle.nightly_kpis([times.run_window(d) for d in JOB_DAYS])
QUERIES["replace_by_key"], ORACLE["replace_by_key"] = replace_by_key, oracle.REPLACE_BY_KEY
QUERIES["rotate_snapshot"], ORACLE["rotate_snapshot"] = rotate_snapshot, oracle.ROTATE
QUERIES["full_refresh"], ORACLE["full_refresh"] = full_refresh, oracle.FULL_REFRESH

# --- Streams: run over the files there are, then read back ----------------------------------


def kpi_board_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, events = new_folder(spark, "board"), stream_view(spark, sf_dir, "transport", "sequence")
    changes.run_available(board.kpi_board_stream(events, folder, lambda: AS_OF), f"{folder}/checkpoint")
    return board.read_board(spark, folder)


def open_transport_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, events = new_folder(spark, "open"), stream_view(spark, sf_dir, "transport", "sequence")
    changes.run_available(open_state.open_transport_stream(events, f"{folder}/state", AS_OF, fan=2), f"{folder}/checkpoint")
    return open_state.open_counts(spark, f"{folder}/state", AS_OF)


def ledger_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source delivers everything twice, in several batches."""
    folder = new_folder(spark, "ingest")
    events = stream_view(spark, sf_dir, "ledger", "local_transaction_id, menge", deliveries=2, batches=2)
    changes.run_available(ingest.ledger_ingest_dedup(events, f"{folder}/ledger"), f"{folder}/checkpoint")
    return ingest.read_ingested(spark, f"{folder}/ledger")


def shift_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, events = new_folder(spark, "windows"), stream_view(spark, sf_dir, "ledger", "sequence")
    changes.run_available(ingest.shift_window_stream(events, f"{folder}/windows"), f"{folder}/checkpoint")
    return ingest.read_shift_windows(spark, f"{folder}/windows")


QUERIES["kpi_board_stream"], ORACLE["kpi_board_stream"] = kpi_board_stream, oracle.KPI_BOARD_STREAM
QUERIES["open_transport_state"], ORACLE["open_transport_state"] = open_transport_state, oracle.OPEN_STATE
QUERIES["ledger_ingest_dedup"], ORACLE["ledger_ingest_dedup"] = ledger_ingest_dedup, oracle.INGEST_DEDUP
QUERIES["shift_window_counts"], ORACLE["shift_window_counts"] = shift_window_counts, oracle.SHIFT_WINDOWS
