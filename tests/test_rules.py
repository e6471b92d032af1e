"""One small frame per rule that the source database and Spark read differently."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from palletrail import config as c
from palletrail.functions import predicates as p, rules, text, times
from palletrail.functions.attributes import json_fields
from palletrail.operators.legs import LegFilter, in_legs, out_legs, pair_legs, pair_legs_sequenced
from palletrail.plans import ideas, outlet, receive
from palletrail.sources.readers import normalize, read_ledger
from palletrail.operators.skew import first_per_key

LEDGER = ("local_transaction_id string, sequence bigint, typ_id int, tpartnr int, artnr string, ziel string, "
          "lagbez string, lhmnr string, menge int, createdby string, created timestamp_ntz, cust_data string")
NOON = datetime(2025, 5, 5, 12)


def leg(txn="t", seq=1, typ=101, process=520, article="2001", place="OV01", area="Overstock", carrier="4001",
        quantity=-1, when=NOON, data='{}'):
    return (txn, seq, typ, process, article, place, area, carrier, quantity, "u", when, data)


def ledger(spark, *legs):
    return spark.createDataFrame(list(legs), LEDGER)


def values(df, column):
    return [row[column] for row in df.select(column).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_blank_text_is_null_at_the_edge(spark):
    raw = spark.createDataFrame([("", "42", "2025-01-01 00:00:00")], "LHMNR string, TYP_ID string, CREATED string")
    row = normalize(raw).first()
    assert (row["lhmnr"], row["typ_id"], row["created"]) == (None, 42, datetime(2025, 1, 1))
    assert dict(normalize(raw).dtypes) == {"lhmnr": "string", "typ_id": "int", "created": "timestamp_ntz"}


def test_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger(spark, leg()).write.parquet(path)
    rows = read_ledger(spark.read.parquet(path), NOON, NOON, ["lhmnr", "created"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created" in plan and "ReadSchema: struct<lhmnr:string,created" in plan
    assert rows.count() == 1


@pytest.mark.parametrize("document, wanted", [
    ('{"SKU_ART":""}', None), ('{"SKU_ART":{"a":1}}', None), ('{"SKU_ART":[1]}', None), ('{"SKU_ART":7}', "7"),
    ('{"SKU_ART":true}', "true"), ('not json', None), (None, None), ('{"SKU_ART":null}', None), ('{"SKU_ART":"x"}', "x"),
])
def test_attribute_values(spark, document, wanted):
    frame = spark.createDataFrame([(document,)], "cust_data string")
    assert json_fields(frame, ["sku"]).first()["sku"] == wanted


def test_document_is_parsed_once(spark):
    plan = json_fields(ledger(spark, leg()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField") == 1 and plan.count("from_json(MapType") == 1  # the latter for rare documents only


@pytest.mark.parametrize("wanted, matches", [
    (None, ["AY1", "z_1", None, "11"]), ("", ["AY1", "z_1", None, "11"]), ("ay%", ["AY1"]), ("11,ay1", ["AY1", "11"]),
    ("Z_1", ["z_1"]), ("zx1,11", ["11"]), ("nothing", []), ("a%,11", ["11"]),
])
def test_reference_filter(spark, wanted, matches):
    frame = spark.createDataFrame([("AY1",), ("z_1",), (None,), ("11",)], "r string")
    assert values(p.keep(frame, p.ref_filter(F.col("r"), wanted)), "r") == matches


def test_missing_grade_counts_as_highest(spark):
    stock = spark.createDataFrame([("4a", None, "e", "A"), ("4a", None, "e", None), ("4b", "5b", "e", "A"), ("9c", "5b", "e", "C")],
                                  "mainlhm string, sublhm string, artnr string, quality string")
    grades = {(r["lc"], r["artnr"]): r["quality"] for r in outlet.best_grade_dedup(stock).collect()}
    assert grades == {("4a", "e"): None, ("4b", "e"): "A", ("5b", "e"): "C"}


def test_unpivot_leaves_out_missing_carriers(spark):
    stock = spark.createDataFrame([("4a", None, "e", "A")], "mainlhm string, sublhm string, artnr string, quality string")
    assert values(outlet.unpivot_carriers(stock, "artnr"), "lc") == ["4a"]


def test_code_tables_with_and_without_default(spark):
    assert one(spark, rules.category_map(F.lit("9"))) == "Unknown"
    assert one(spark, rules.category_map(F.lit("9"), None)) is None
    assert one(spark, rules.category_map(F.lit(None).cast("string"))) == "Unknown"
    assert one(spark, rules.map_codes(F.lit("1"), c.GRADES)) == "A"


def test_underscore_is_a_wildcard_in_patterns(spark):
    assert one(spark, F.lit("KFXOV7").like("KF_OV%"))
    stock = spark.createDataFrame([("Beauty", "BSFXT1"), ("Beauty", "OK"), ("Home", "OK")], "category string, place string")
    from palletrail.plans.hazard import stock_by_category
    assert values(stock_by_category(stock, "Beauty"), "place") == ["OK"]


def paired(spark, *legs, numeric=False):
    frame = ledger(spark, *legs)
    return pair_legs(out_legs(frame, LegFilter()), in_legs(frame, LegFilter()), numeric)


def test_dummy_goods_without_arrival_are_dropped_and_normal_goods_stay(spark):
    normal, dummy = leg("n"), leg("d", process=614)
    assert values(paired(spark, normal, dummy), "good_type") == ["NORMAL"]
    assert paired(spark, normal, dummy, numeric=True).count() == 0


def test_arrivals_on_000_carriers_do_not_count(spark):
    arrival = leg("n", carrier="0007", quantity=1)
    assert values(paired(spark, leg("n"), arrival), "ziel_lhm") == [None]
    assert paired(spark, leg("d", process=614), leg("d", process=207, carrier="0007", quantity=1)).count() == 0


def test_self_transfer_is_dropped_and_missing_carriers_are_not(spark):
    assert paired(spark, leg("n"), leg("n", quantity=1)).count() == 0
    assert paired(spark, leg("n", carrier=None), leg("n", quantity=1)).count() == 1


def test_pairs_of_a_repeated_transaction(spark):
    legs = [leg("n"), leg("n"), leg("n", carrier="61", quantity=1), leg("n", carrier="62", quantity=1)]
    assert paired(spark, *legs).count() == 4
    dummies = [leg("d", 1, 120, 614, place="IN_SZR_OV"), leg("d", 2, 120, 614, place="IN_SZR_OV"),
               leg("d", 1, 101, 207, place="IN_SZR_OV", carrier="61", quantity=1),
               leg("d", 2, 101, 207, place="IN_SZR_OV", carrier="62", quantity=2)]
    pairs = pair_legs_sequenced(ledger(spark, *dummies), LegFilter())
    assert sorted((r["sequence"], r["ziel_lhm"]) for r in pairs.collect()) == [(1, "61"), (2, "62")]


def test_sortable_flag_has_a_case_for_dummy_goods_only(spark):
    data = '{"QUALITYID_SEKTOR":"1","SORTABLE_ART":"FALSE"}'
    rows = paired(spark, leg("n", data=data), leg("d", process=614, data=data),
                  leg("d", process=207, carrier="61", quantity=1))
    graded = {r["good_type"]: r["q"] for r in rows.select("good_type", receive.quality().alias("q")).collect()}
    assert graded == {"NORMAL": "B", "DUMMY": "A"}


@pytest.mark.parametrize("start, end, kept", [(None, None, 1), (None, NOON, 1), (NOON, None, 0), (NOON, NOON, 1)])
def test_between_window_is_switched_by_its_start(spark, start, end, kept):
    assert p.keep(ledger(spark, leg()), p.between_window(F.col("created"), start, end)).count() == kept


@pytest.mark.parametrize("start, end, kept", [(None, None, 1), (NOON, None, 1), (None, datetime(2025, 1, 1), 0)])
def test_open_window_ends_are_independent(spark, start, end, kept):
    assert p.keep(ledger(spark, leg()), p.open_window(F.col("created"), start, end)).count() == kept


@pytest.mark.parametrize("clock, shift", [
    ("05:49:59", None), ("05:50:00", 1), ("14:44:59", 1), ("14:45:00", 2), ("23:59:00", 2), ("23:59:01", None), ("00:00:00", None)])
def test_shift_bounds(spark, clock, shift):
    when = F.lit(f"2025-07-01 {clock}").cast("timestamp_ntz")
    assert one(spark, times.shift_of(when)) == shift


def test_shift_on_the_local_clock(spark):
    when = F.lit("2025-07-01 04:00:00").cast("timestamp_ntz")
    assert one(spark, times.shift_of(when)) is None
    assert one(spark, times.shift_of(when, zone="Europe/Berlin")) == 1


@pytest.mark.parametrize("day, start, end", [
    ("2025-03-30", "2025-03-30 03:50:00", "2025-03-30 21:59:00"), ("2025-03-29", "2025-03-29 04:50:00", "2025-03-29 22:59:00"),
    ("2025-10-26", "2025-10-26 04:50:00", "2025-10-26 22:59:00"), ("2025-10-25", "2025-10-25 03:50:00", "2025-10-25 21:59:00")])
def test_utc_window_on_days_the_clock_changes(spark, day, start, end):
    wanted = (datetime.fromisoformat(start), datetime.fromisoformat(end))
    row = spark.range(1).select(*times.utc_window(F.lit(day).cast("date"))).first()
    assert tuple(row) == wanted
    assert times.run_window(datetime.fromisoformat(day).date()) == wanted


def test_month_window(spark):
    wanted = (datetime(2025, 9, 30, 22), datetime(2025, 10, 31, 22, 59, 59), "10.2025")
    day = datetime(2025, 10, 17).date()
    assert tuple(spark.range(1).select(*times.month_window(F.lit(day))).first()) == wanted
    assert times.run_month(day) == wanted


@pytest.mark.parametrize("day, week", [("2023-01-01", 1), ("2023-01-07", 1), ("2023-01-08", 2), ("2022-01-01", 1),
                                       ("2022-01-02", 2), ("2024-12-31", 53), ("2023-12-31", 53)])
def test_week_number(spark, day, week):
    assert one(spark, times.week_number(F.lit(day).cast("date"))) == week


def test_first_row_is_the_same_every_time(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("k", None, "c")], "key string, at int, v string")
    assert values(first_per_key(rows, ["key"], [F.col("at").asc_nulls_last()]), "v") == ["a"]


@pytest.mark.parametrize("raw, number", [(" 1,234.5 ", 1234.5), ("n/a", 0.0), ("", 0.0), (None, 0.0), ("-3", -3.0)])
def test_numbers_from_text(spark, raw, number):
    assert one(spark, text.num_clean(F.lit(raw).cast("string"))) == number


@pytest.mark.parametrize("raw, ticket", [("7", "T-007"), ("65 b", "T-065"), ("1234", "T-234"), ("x1", None)])
def test_tickets(spark, raw, ticket):
    assert one(spark, text.ticket_format(text.ticket_number(F.lit(raw)), "T-")) == ticket


@pytest.mark.parametrize("mail, name", [("anna.b@x.org", "Anna"), ("bob@x.org", "Bob"), ("", "")])
def test_names(spark, mail, name):
    assert one(spark, text.name_from_mail(F.lit(mail))) == name


def test_outbox_and_digest_thresholds(spark):
    intake = spark.createDataFrame([("64", "s", ""), ("65", "s", ""), ("66", "s", "Sent"), ("67", "s", None)],
                                   "ticket string, source_text string, status string")
    assert sorted(values(ideas.notification_outbox(intake), "number")) == [65, 67]
    sent = spark.createDataFrame([(65,)], "number bigint")
    assert values(ideas.notification_outbox(intake, sent), "number") == [67]
    board = spark.createDataFrame([("a.b@x", 1.0), (" ", 5.0), (None, 5.0), ("c@x", 0.0)], "mail string, points double")
    assert values(ideas.reward_digest(board), "first_name") == ["A"]


def test_kpis_overlap_and_a_row_counts_in_both(spark):
    data = '{"QUALITYID_SEKTOR":"2","SOURCEID_SEKTOR":"1","DISTRIBUTIONCHANNELID_ART":"8"}'
    row = receive.uph_kpis(ledger(spark, leg("n", quantity=-3, data=data))).first()
    assert (row["grade_b"], row["blocklist"], row["grade_a"]) == (3, 3, 0)


def test_window_parts_add_up(spark):
    legs = [leg(f"t{i}", when=datetime(2025, 5, i, 12)) for i in range(1, 11)]
    frame = ledger(spark, *legs)
    whole = receive.booking_detail(frame, LegFilter(start=datetime(2025, 5, 1), end=datetime(2025, 5, 31)))
    parts = [receive.booking_detail(frame, LegFilter(start=datetime(2025, 5, a), end=datetime(2025, 5, b, 23, 59, 59)))
             for a, b in ((1, 4), (5, 31))]
    assert sorted(whole.collect()) == sorted(parts[0].collect() + parts[1].collect())
