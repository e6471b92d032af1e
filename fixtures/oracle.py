"""DuckDB statements that the registered queries are compared with."""

from __future__ import annotations

import re

from fixtures.views import with_views

AREAS = "('Overstock','SZROV')"


def attr(document: str, key: str) -> str:
    return f"nullif({document}->>'{key}', '')"


def labels(code: str, table: dict[str, str], default: str | None) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    tail = "NULL" if default is None else f"'{default}'"
    return f"CASE {code} {arms} ELSE {tail} END"


GRADES = {"1": "A", "2": "B", "3": "C", "4": "D"}
CATEGORIES = {"1": "Schuhe", "2": "Textil", "3": "ACC", "4": "Home", "5": "Beauty"}
SOURCES = {"1": "Main", "10": "OSR", "11": "OSR (OV)"}


def shift(when: str) -> str:
    clock = f"strftime({when}, '%H:%M:%S')"
    return (f"CASE WHEN {clock} BETWEEN '05:50:00' AND '14:44:59' THEN 1 "
            f"WHEN {clock} BETWEEN '14:45:00' AND '23:59:00' THEN 2 END")


def both(key: str) -> str:
    return f"coalesce({attr('cd2', key)}, {attr('cd1', key)})"


def grade(code: str, unsortable: str) -> str:
    return f"CASE WHEN {code}='1' AND {unsortable} THEN 'B' ELSE {labels(code, GRADES, 'Unknown')} END"


QUALITY_NORMAL = grade(attr("cd1", "QUALITYID_SEKTOR"), f"lower({attr('cd1', 'SORTABLE_ART')})='false'")
QUALITY_DUMMY = grade(
    f"coalesce({attr('cd2', 'QUALITYID_ART')}, {attr('cd1', 'QUALITYID_SEKTOR')})",
    f"{both('SORTABLE_ART')}='false'")
CATEGORY_NORMAL = labels(attr("cd1", "CATEGORYID_ART"), CATEGORIES, "Unknown")
CATEGORY_DUMMY = labels(both("CATEGORYID_ART"), CATEGORIES, "Unknown")
SOURCE = labels(both("SOURCEID_SEKTOR"), SOURCES, "Unknown")


def channel(disposal: bool = False, clarify: bool = False, blocked: bool = False) -> str:
    arms = ["WHEN dst LIKE '50%' THEN 'Overstock'"]
    if disposal:
        arms.append("WHEN dst = 'SPENDENLHM' THEN 'disposal'")
    if clarify:
        arms.append("WHEN dst LIKE 'KF_OV%' THEN 'Clarification'")
    code = both("DISTRIBUTIONCHANNELID_ART")
    arms += [f"WHEN {code}='4' THEN 'Outlet'", f"WHEN {code}='3' THEN 'Overstock'",
             f"WHEN {both('SOURCEID_SEKTOR')}='11' THEN 'Overstock'"]
    if blocked:
        arms.append(f"WHEN {code}='8' THEN 'Blocklist'")
    return "CASE " + " ".join(arms) + " ELSE 'Unknown' END"


CHANNEL_BASE = channel()
CHANNEL_DETAIL = channel(disposal=True, blocked=True)
CHANNEL_KPI = channel(True, True, True)


def pairs(where: str = "TRUE", target: bool = True, numeric: bool = False) -> str:
    """CTE ``p``: normal pairs by left join, dummy pairs by inner join, stacked."""
    at = "AND ziel LIKE 'OV%'" if target else ""
    columns = "o.created, o.artnr, o.ziel, o.createdby, o.lhmnr AS src, i.lhmnr AS dst, o.menge, o.cust_data AS cd1, i.cust_data AS cd2"
    only = "AND regexp_full_match(i.lhmnr, '[0-9]+')" if numeric else ""
    return f"""p AS (
  SELECT 'NORMAL' AS good_type, {columns}, {QUALITY_NORMAL.replace('cd1', 'o.cust_data')} AS quality, {CATEGORY_NORMAL.replace('cd1', 'o.cust_data')} AS category
  FROM (SELECT * FROM ledger WHERE tpartnr=520 AND menge<0 AND lagbez IN {AREAS} {at}) o
  LEFT JOIN (SELECT * FROM ledger WHERE tpartnr=520 AND menge=1 AND lagbez IN {AREAS} AND lhmnr NOT LIKE '000%') i
    ON o.local_transaction_id = i.local_transaction_id
  WHERE (o.lhmnr IS NULL OR i.lhmnr IS NULL OR o.lhmnr <> i.lhmnr) AND ({where}) {only}
  UNION ALL
  SELECT 'DUMMY', {columns}, {QUALITY_DUMMY.replace('cd1', 'o.cust_data').replace('cd2', 'i.cust_data')}, {CATEGORY_DUMMY.replace('cd1', 'o.cust_data').replace('cd2', 'i.cust_data')}
  FROM (SELECT * FROM ledger WHERE tpartnr=614 AND menge<0 AND lagbez IN {AREAS} {at}) o
  JOIN (SELECT * FROM ledger WHERE tpartnr=207 AND menge=1 AND lagbez IN {AREAS} {at}) i
    ON o.local_transaction_id = i.local_transaction_id AND i.lhmnr NOT LIKE '000%'
  WHERE (o.lhmnr IS NULL OR i.lhmnr IS NULL OR o.lhmnr <> i.lhmnr) AND ({where}) {only}
)"""


def total(test: str, name: str, quantity: str = "abs(menge)") -> str:
    return f"CAST(sum(CASE WHEN {test} THEN {quantity} ELSE 0 END) AS BIGINT) AS {name}"


def kpis(keys: str, by: str, where: str = "TRUE") -> str:
    return with_views(f"""WITH {pairs(where)},
d AS (SELECT *, {SOURCE} AS sc, {CHANNEL_KPI} AS dc FROM p)
SELECT {keys}, category,
 {total("quality='A' AND sc='Main'", 'grade_a')}, {total("quality='B' AND sc='Main'", 'grade_b')},
 {total("quality='C' AND sc='Main'", 'grade_c')}, {total("quality='D' AND sc='Main'", 'grade_d')},
 {total("sc='OSR'", 'store_returns_outlet')}, {total("sc='OSR (OV)'", 'store_returns_overstock')},
 {total("dc='Blocklist'", 'blocklist')}, {total("dc='disposal'", 's_item')}, {total("dc='Clarification'", 'clarification')}
FROM d GROUP BY {by}, category""", "ledger")


PLACE = f"strftime(created, '%Y-%m-%d') AS date, {shift('created')} AS shift, ziel AS workstation"
PLACE_BY = f"strftime(created, '%Y-%m-%d'), {shift('created')}, ziel"

UPH_KPIS = kpis(PLACE, PLACE_BY)


def nightly_kpis(windows) -> str:
    return kpis(PLACE, PLACE_BY, " OR ".join(f"o.created BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'" for start, end in windows))


UPH_KPIS_BY_USER = kpis(PLACE + ', createdby AS "user"', PLACE_BY + ", createdby")

SORT_ID = f"CASE good_type WHEN 'NORMAL' THEN {attr('cd1', 'SORTINGCRITERIAID_ART')} ELSE {attr('cd2', 'SORTINGCRITERIAID_ART')} END"
SKU = f"CASE good_type WHEN 'NORMAL' THEN {attr('cd1', 'SKU_ART')} ELSE {attr('cd2', 'SKU_ART')} END"
REFERENCE = attr("cd1", "REFERENCENUMBER_LHM")
LAST_EAN = attr("cd1", "LASTEANGOTFROMMAUS_ZIEL")
EAN = (f"coalesce({LAST_EAN}, CASE WHEN good_type='DUMMY' AND artnr NOT LIKE '2%' THEN {LAST_EAN} ELSE artnr END)")

SHIFT_REPORT = with_views(f"""WITH {pairs(numeric=True)},
d AS (SELECT strftime(created, '%d.%m.%Y') AS date, {shift('created')} AS shift, {SOURCE} AS source, quality,
  {CHANNEL_BASE} AS distchannel, {REFERENCE} AS reference, category, {SORT_ID} AS sortid, abs(menge) AS q FROM p)
SELECT date, shift, source, quality, distchannel, reference, category, sortid, CAST(sum(q) AS BIGINT) AS quantity
FROM d GROUP BY ALL""", "ledger")


def detail(channel_sql: str, numeric: bool, category: str = "category", where: str = "TRUE") -> str:
    return f"""WITH {pairs(numeric=numeric, where=where)},
d AS (SELECT strftime(created, '%d.%m.%Y %H:%M:%S') AS timestamp, {EAN} AS ean, ziel AS ap, createdby AS benutzer,
  src AS source_lhm, dst AS ziel_lhm, CAST(abs(menge) AS BIGINT) AS quantity, {REFERENCE} AS reference_lhm,
  {SOURCE} AS source_channel, quality, {category} AS category, {channel_sql} AS distribution_channel,
  {SKU} AS sku, {SORT_ID} AS sort_id FROM p)
"""


BOOKING_DETAIL = with_views(detail(CHANNEL_DETAIL, False) + "SELECT * FROM d", "ledger")
BOOKING_DETAIL_NUMERIC = with_views(detail(CHANNEL_BASE, True) + "SELECT * FROM d", "ledger")
BOOKING_DETAIL_TERMINAL = with_views(detail(CHANNEL_BASE, True, CATEGORY_NORMAL) + "SELECT * FROM d", "ledger")

BRANDS = """brands AS (SELECT ean, min(brand_name) AS brand_name FROM brand_dim GROUP BY ean)"""
BRAND = ("coalesce(CASE d.ean WHEN '200000007' THEN 'Mixed household lot' WHEN '200000013' THEN 'Mixed footwear lot' END, "
         "brands.brand_name, 'no brand info')")


def monthly(where: str) -> str:
    return with_views(detail(CHANNEL_BASE, True) + f""", {BRANDS}
SELECT timestamp, d.ean, quality, category, distribution_channel AS zielkanal, reference_lhm, {BRAND} AS brand_name
FROM d LEFT JOIN brands ON d.ean = brands.ean WHERE {where}""", "ledger", "brand_dim")


MONTHLY_ZFS = monthly("upper(reference_lhm) LIKE 'Z%'")
MONTHLY_BEAUTY = monthly("category='Beauty' AND quality='B'")

NOT_SORTING = "(ziel IS NULL OR ziel <> 'IN_SZR_OV')"
RECEIVE_VOLUME = with_views(f"""WITH {pairs(target=False, numeric=True)},
d AS (SELECT *, {CHANNEL_BASE} AS dc FROM p)
SELECT strftime(created, '%d.%m.%Y') AS date_only, strftime(created, '%Y_%m') AS year_month,
 {total("dst LIKE '6%' AND dc='Outlet'", 'ou_bsf_sort')}, {total("dst LIKE '3%' AND dc='Outlet'", 'ou_bigitems')},
 {total("dc='Outlet'", 'total_outlet')}, {total("ziel = 'IN_SZR_OV'", 'in_srz')},
 {total(f"dst LIKE '6%' AND dc='Overstock' AND {NOT_SORTING}", 'ov_overstock_sort')},
 {total(f"dst LIKE '5%' AND dc='Overstock' AND {NOT_SORTING}", 'ov_fin_ap')},
 {total(f"dc='Overstock' AND {NOT_SORTING}", 'total_overstock')}
FROM d GROUP BY 1, 2""", "ledger")

# --- Manual sorting -----------------------------------------------------------------

SORTED_BY = "sequence, created, artnr, lhmnr, menge, ziel, createdby, cust_data"
DUMMY_OUT = "tpartnr=614 AND typ_id=120 AND menge<0 AND ziel='IN_SZR_OV'"
DUMMY_IN = "tpartnr=207 AND ziel IN ('IN_SZR_OV','SZR_OV') AND menge>0"


def numbered(where: str) -> str:
    return (f"(SELECT *, row_number() OVER (PARTITION BY local_transaction_id ORDER BY {SORTED_BY}) AS rn "
            f"FROM ledger WHERE {where})")


SORTING_PAIRS = f"""p AS (
  SELECT 'NORMAL' AS good_type, o.created, o.artnr AS ean, o.ziel, o.createdby, o.lhmnr AS src, i.lhmnr AS dst, o.menge, o.cust_data AS cd1, NULL AS cd2
  FROM (SELECT * FROM ledger WHERE tpartnr=520 AND menge<0 AND ziel IN ('IN_SZR_OV','SZR_OV')) o
  JOIN (SELECT * FROM ledger WHERE tpartnr=520 AND menge=1 AND ziel IN ('IN_SZR_OV','SZR_OV')) i USING (local_transaction_id)
  UNION ALL
  SELECT 'DUMMY', o.created, CASE WHEN o.artnr LIKE '2%' THEN o.artnr WHEN {attr('o.cust_data', 'LASTEANGOTFROMMAUS_ZIEL')} IS NOT NULL THEN {attr('o.cust_data', 'LASTEANGOTFROMMAUS_ZIEL')} WHEN i.artnr LIKE '2%' THEN i.artnr ELSE o.artnr END,
   o.ziel, o.createdby, o.lhmnr, i.lhmnr, o.menge, o.cust_data, i.cust_data
  FROM {numbered(DUMMY_OUT)} o JOIN {numbered(DUMMY_IN)} i ON o.local_transaction_id=i.local_transaction_id AND o.rn=i.rn
)"""
def parsed_once(select: str, source: str) -> str:
    """CTE ``parsed`` with every attribute that ``select`` reads as a column of its own, and ``select`` over these."""
    found = sorted(set(re.findall(r"nullif\((cd[12])->>'(\w+)', ''\)", select)))
    columns = ", ".join(f"{attr(document, key)} AS {document}_{key}" for document, key in found)
    for document, key in found:
        select = select.replace(attr(document, key), f"{document}_{key}")
    return f"parsed AS MATERIALIZED (SELECT *, {columns} FROM {source})\n{select}"


SORTED_ROWS = f"""SELECT strftime(created, '%d.%m.%Y %H:%M:%S') AS timestamp, ean, ziel AS ap, createdby AS benutzer, src AS source_lhm, dst AS ziel_lhm,
 CAST(abs(menge) AS BIGINT) AS quantity, {REFERENCE} AS reference_lhm,
 {labels(attr('cd1', 'SOURCEID_SEKTOR'), SOURCES, 'Resale')} AS source_channel,
 {labels(attr('cd1', 'QUALITYID_SEKTOR'), GRADES, 'Unknown')} AS quality, {CATEGORY_NORMAL} AS category,
 CASE WHEN dst LIKE '50%' THEN 'Overstock' WHEN {attr('cd1', 'QUALITYID_SEKTOR')} IN ('3','4') THEN 'Overstock'
  WHEN {attr('cd1', 'DISTRIBUTIONCHANNELID_ART')}='4' THEN 'Outlet' WHEN {attr('cd1', 'DISTRIBUTIONCHANNELID_ART')}='3' THEN 'Overstock' ELSE 'Unknown' END AS distribution_channel,
 {SKU} AS sku, {SORT_ID} AS sort_id
FROM parsed WHERE (src IS NULL OR src <> dst) AND regexp_full_match(dst, '[0-9]+')"""
MANUAL_SORTING = with_views(f"WITH {SORTING_PAIRS},\n{parsed_once(SORTED_ROWS, 'p')}", "ledger")

SEQUENCE_INDEX = with_views(
    f"SELECT local_transaction_id, sequence, artnr, created, CAST(rn AS INTEGER) AS rn FROM {numbered(DUMMY_OUT)}", "ledger")
PAIR_LEGS = with_views(f"""WITH {pairs()}
SELECT good_type, src AS source_lhm, dst AS ziel_lhm, count(*) AS pairs, CAST(sum(abs(menge)) AS BIGINT) AS quantity
FROM p GROUP BY ALL""", "ledger")
PAIR_SEQUENCED = with_views(f"""WITH {SORTING_PAIRS}
SELECT good_type, src AS source_lhm, dst AS ziel_lhm, count(*) AS pairs FROM p
WHERE (src IS NULL OR src <> dst) AND regexp_full_match(dst, '[0-9]+') GROUP BY ALL""", "ledger")
UNION_GOODS = with_views(f"""WITH {pairs()}
SELECT good_type, count(*) AS pairs, CAST(sum(abs(menge)) AS BIGINT) AS quantity FROM p GROUP BY ALL""", "ledger")

PAIR_TOTALS_HOT = with_views(f"""WITH l AS (SELECT * REPLACE (CASE WHEN sequence % 3 = 0 THEN 'hot' ELSE local_transaction_id END AS local_transaction_id) FROM ledger),
o AS (SELECT CASE tpartnr WHEN 520 THEN 'NORMAL' ELSE 'DUMMY' END AS good_type, local_transaction_id AS txn, lhmnr, count(*) AS n, sum(abs(menge)) AS q
  FROM l WHERE tpartnr IN (520, 614) AND menge < 0 AND lagbez IN {AREAS} AND ziel LIKE 'OV%' GROUP BY ALL),
i AS (SELECT CASE tpartnr WHEN 520 THEN 'NORMAL' ELSE 'DUMMY' END AS good_type, local_transaction_id AS txn, lhmnr, count(*) AS m
  FROM l WHERE (tpartnr = 520 OR tpartnr = 207 AND ziel LIKE 'OV%') AND menge = 1 AND lagbez IN {AREAS} AND lhmnr NOT LIKE '000%' GROUP BY ALL),
w AS (SELECT good_type, txn, sum(m) AS m FROM i GROUP BY ALL)
SELECT o.good_type, CAST(sum(n * (coalesce(w.m, 1) - coalesce(i.m, 0))) AS BIGINT) AS pairs, CAST(sum(q * (coalesce(w.m, 1) - coalesce(i.m, 0))) AS BIGINT) AS quantity
FROM o LEFT JOIN w ON o.good_type = w.good_type AND o.txn = w.txn LEFT JOIN i ON o.good_type = i.good_type AND o.txn = i.txn AND o.lhmnr = i.lhmnr
WHERE o.good_type = 'NORMAL' OR w.m IS NOT NULL GROUP BY ALL""", "ledger")

# --- Outlet ---------------------------------------------------------------------------

IS_45 = "(lhmnr LIKE '4%' OR lhmnr LIKE '5%')"
GRADE_CODE = attr("cust_data", "QUALITYID_SEKTOR")


def first_grade(where: str, keys: str) -> str:
    return f"""(SELECT {keys}, {labels('code', GRADES, None)} AS grade FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY created NULLS LAST, sequence NULLS LAST, code NULLS LAST) AS n
  FROM (SELECT *, {GRADE_CODE} AS code, trim(lhmnr) AS station FROM outlet) WHERE {where}) WHERE n = 1)"""


H120 = first_grade(f"typ_id=120 AND tpartnr=614 AND menge<0 AND {IS_45}", "lhmnr, artnr")
STATION = first_grade("typ_id=101 AND tpartnr=520 AND station LIKE 'KF\\_%' ESCAPE '\\'", "artnr, station")
HISTORY = first_grade(f"code IN ('1','2','3','4') AND {IS_45}", "lhmnr")
NET = f"""booked AS (SELECT lhmnr, artnr, sum(menge) AS b, max(created) AS created, max(cust_data) AS cust_data FROM outlet
  WHERE typ_id=103 AND tpartnr=202 AND {IS_45} GROUP BY 1,2),
clarified AS (SELECT lhmnr, artnr, sum(abs(menge)) AS c FROM outlet WHERE typ_id=102 AND tpartnr=402 AND {IS_45} GROUP BY 1,2),
net AS (SELECT booked.*, c, b - coalesce(c,0) AS q FROM booked LEFT JOIN clarified USING (lhmnr, artnr))"""
CARRIERS = """carriers AS (SELECT mainlhm AS lc, artnr, quality, 'mainlhm' AS lhm_type FROM stock WHERE mainlhm IS NOT NULL
  UNION ALL SELECT sublhm, artnr, quality, 'sublhm' FROM stock WHERE sublhm IS NOT NULL)"""
BEST = """best AS (SELECT lc, artnr, quality FROM (SELECT *, row_number() OVER (PARTITION BY lc, artnr ORDER BY quality DESC NULLS FIRST) AS n
  FROM carriers WHERE lc LIKE '4%' OR lc LIKE '5%') WHERE n = 1)"""
OUTLET_PARTS = f"""{NET}, {CARRIERS}, {BEST},
items AS (
  SELECT strftime(created,'%Y-%m-%d') AS date, {shift('created')} AS shift, lhmnr AS lc, {labels(attr('cust_data', 'CATEGORYID_ART'), CATEGORIES, None)} AS category,
   {attr('cust_data', 'SORTINGCRITERIAID_ART')} AS sort_id, artnr AS ean, q, grade AS fallback, 1 AS origin
  FROM net LEFT JOIN {H120} h USING (lhmnr, artnr) WHERE q > 0
  UNION ALL
  SELECT strftime(o.created,'%Y-%m-%d'), {shift('o.created')}, o.lhmnr, {labels(attr('o.cust_data', 'CATEGORYID_ART'), CATEGORIES, None)},
   {attr('o.cust_data', 'SORTINGCRITERIAID_ART')}, o.artnr, abs(o.menge), FALLBACK, 2
  FROM outlet o
  LEFT JOIN {STATION} s ON s.artnr=o.artnr AND s.station = 'KF_' || coalesce(trim(o.ziel),'')
  LEFT JOIN (SELECT lc, max(quality) AS grade FROM carriers WHERE quality IS NOT NULL GROUP BY 1) z ON z.lc = o.lhmnr
  LEFT JOIN {HISTORY} t ON t.lhmnr = o.lhmnr
  WHERE o.typ_id=102 AND o.tpartnr=402 AND (o.lhmnr LIKE '4%' OR o.lhmnr LIKE '5%')
)"""
OWN_GRADE = labels(attr("o.cust_data", "QUALITYID_SEKTOR"), GRADES, None)
FOUR_TIERS = f"coalesce({OWN_GRADE}, s.grade, z.grade, t.grade)"


def outlet(fallback: str, carrier: str) -> str:
    return with_views(f"""WITH {OUTLET_PARTS.replace('FALLBACK', fallback)}
SELECT date, shift, items.lc AS {carrier}, category, sort_id, coalesce(best.quality, fallback) AS quality,
 CASE origin WHEN 2 THEN 'Yes' ELSE 'No' END AS clarification, CAST(sum(q) AS BIGINT) AS items
FROM items LEFT JOIN best ON best.lc=items.lc AND best.artnr=items.ean GROUP BY ALL HAVING sum(q) > 0""", "outlet", "stock")


OUTLET_BOOKING = outlet(FOUR_TIERS, "hus")
OUTLET_BOOKING_SIMPLE = outlet(OWN_GRADE, "lhm")
NET_JOIN = with_views(f"""WITH {NET}
SELECT lhmnr, artnr, CAST(b AS BIGINT) AS total_booked, CAST(c AS BIGINT) AS total_clarified FROM net""", "outlet")
NET_BOOKED = with_views(f"""WITH {NET} SELECT lhmnr, artnr, CAST(q AS BIGINT) AS quantity FROM net WHERE q > 0""", "outlet")
REPRESENTATIVE = with_views(f"WITH {NET} SELECT lhmnr, artnr, created, cust_data FROM net", "outlet")
HAVING_POSITIVE = with_views(f"""SELECT lhmnr, artnr, CAST(sum(menge) AS BIGINT) AS items FROM outlet GROUP BY ALL HAVING sum(menge) > 0""", "outlet")
SCALAR_LOOKUP = with_views(f"SELECT lhmnr, artnr, grade FROM {H120}", "outlet")
FIRST_PER_KEY = with_views(f"SELECT lhmnr, grade FROM {HISTORY}", "outlet")
OR_KEY_LOOKUP = with_views(f"""SELECT o.lhmnr, o.artnr, count(*) AS n, max(z.quality) AS grade FROM outlet o
LEFT JOIN (SELECT lhmnr, max(quality) AS quality FROM (SELECT DISTINCT lhmnr FROM outlet) c JOIN stock ON mainlhm = lhmnr OR sublhm = lhmnr GROUP BY 1) z USING (lhmnr)
WHERE typ_id=102 GROUP BY ALL""", "outlet", "stock")
BEST_GRADE = with_views(f"WITH {CARRIERS}, {BEST} SELECT * FROM best", "stock")
STOCK_QUALITY = with_views(f"""WITH {CARRIERS}, {BEST}
SELECT lhmnr, outlet.artnr, best.quality, count(*) AS n FROM outlet LEFT JOIN best ON lc=lhmnr AND best.artnr=outlet.artnr
WHERE typ_id=103 GROUP BY ALL""", "outlet", "stock")
UNPIVOT = with_views(f"WITH {CARRIERS} SELECT lc, lhm_type, artnr, quality FROM carriers", "stock")
UNION_NET = with_views(f"""WITH {OUTLET_PARTS.replace('FALLBACK', FOUR_TIERS)}
SELECT CASE origin WHEN 2 THEN 'Yes' ELSE 'No' END AS clarification, fallback, CAST(sum(q) AS BIGINT) AS items
FROM items GROUP BY ALL""", "outlet", "stock")
GRADE_FALLBACK = with_views(f"""WITH {OUTLET_PARTS.replace('FALLBACK', FOUR_TIERS)}
SELECT lc, ean, fallback, CAST(sum(q) AS BIGINT) AS quantity FROM items WHERE origin = 2 GROUP BY ALL""", "outlet", "stock")
PARAMS_CROSS = with_views(f"""WITH params AS (SELECT TIMESTAMP '1997-01-01 00:00:00' AS start_dt, CAST(NULL AS TIMESTAMP) AS end_dt)
SELECT lhmnr, artnr, CAST(sum(menge) AS BIGINT) AS total_booked FROM outlet CROSS JOIN params
WHERE typ_id=103 AND tpartnr=202 AND {IS_45} AND (start_dt IS NULL OR created >= start_dt) AND (end_dt IS NULL OR created <= end_dt)
GROUP BY ALL""", "outlet")
OPEN_WINDOW = with_views("""SELECT typ_id, count(*) AS n, CAST(sum(menge) AS BIGINT) AS quantity FROM outlet
WHERE created <= TIMESTAMP '1998-06-30 12:00:00' GROUP BY ALL""", "outlet")

# --- Volumes ----------------------------------------------------------------------------

LONG_WINDOW = "created BETWEEN TIMESTAMP '1995-06-01 00:00:00' AND TIMESTAMP '2001-05-31 23:59:59'"
INBOUND_LINES = with_views(f"""SELECT strftime(created,'%d.%m.%Y') AS date_only, strftime(created,'%Y_%m') AS year_month, transportlhmnr,
 ziel AS source, {attr('cust_data', 'REFERENCENUMBER_LHM')} AS reference_lhm,
 {labels(attr('cust_data', 'QUALITYID_ART'), GRADES, 'Unknown')} AS quality, menge
FROM inbound WHERE typ_id=103 AND {LONG_WINDOW} AND ziel='WE' AND hostauftrnr LIKE 'UN%'""", "inbound")
SORTER_VOLUME = with_views(f"""SELECT strftime(created,'%d.%m.%Y') AS date_only, strftime(created,'%Y_%m') AS year_month, CAST(sum(menge) AS BIGINT) AS quantity
FROM inbound WHERE lagbez='Sorter' AND {LONG_WINDOW} AND hostauftrnr LIKE 'LCCONTENT%' AND menge=1 GROUP BY 1, 2""", "inbound")

# --- Transport ---------------------------------------------------------------------------

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def since(days: int) -> str:
    return f"created >= {AS_OF} - INTERVAL {days} DAY"


WE_BGL = f"typ_id=42 AND transporttaskquelle LIKE '%WE%' AND transporttaskziel LIKE '%BGL%' AND {since(7)}"
WE_BSF = f"typ_id=42 AND transporttaskquelle='WE' AND transportrequestziel LIKE '%BSF_O%' AND lagbez='Wareneingang' AND {since(2)}"
FIN_BGL = f"typ_id=42 AND transporttaskquelle='FIN_AP01' AND transportrequestziel LIKE '%BGL%' AND {since(5)}"
BGL_BSF = f"typ_id=42 AND transporttaskquelle LIKE '%BGL%' AND transportrequestziel LIKE '%BSF_O%' AND {since(7)}"
BGL_FIN = (f"typ_id=42 AND transporttaskquelle LIKE 'BGL%' AND transporttaskziel LIKE '%FIN_AP%' "
           f"AND (lagbez <> 'AKL' OR lagbez IS NULL) AND zuggruppe_sender='BESTANDFREIGABE' AND {since(5)}")


def no_event(types: str, key: str = "transportlhmnr", later: bool = False) -> str:
    more = "AND e.created > s.created" if later else ""
    return (f"NOT EXISTS (SELECT 1 FROM transport e WHERE e.typ_id IN ({types}) AND e.{key} = s.{key} "
            f"AND e.zug_id = s.zug_id {more})")


OPEN_STARTS = {
    "we_bgl": ("count(*)", WE_BGL, no_event("47, 39")),
    "we_bsf_ov": ("count(*)", WE_BSF, no_event("47, 39")),
    "fin_ap_bgl": ("count(*)", FIN_BGL, no_event("47, 39")),
    "bgl_bsf_ov": ("count(*)", BGL_BSF, no_event("47", later=True) + " AND " + no_event("39")),
    "open_orders": ("count(DISTINCT zuggruppe_token)", BGL_FIN, no_event("47", "lhmnr")),
    "open_positions": ("count(*)", BGL_FIN, no_event("47", "lhmnr")),
}


def open_count(name: str) -> str:
    number, where, still = OPEN_STARTS[name]
    return f"SELECT {number} AS {name} FROM transport s WHERE {where} AND {still}"


TRANSPORT_KPI = {name: with_views(open_count(name), "transport") for name in OPEN_STARTS}


def board(cast: str = "BIGINT") -> str:
    return ", ".join(f"CAST(({open_count(name)}) AS {cast}) AS {name}" for name in sorted(OPEN_STARTS))


KPI_BOARD = with_views(f"SELECT {AS_OF} AS last_updated, {board()}", "transport")
KPI_SNAPSHOT = with_views(
    f"SELECT {AS_OF} AS last_updated, {board('DOUBLE')}, CAST(NULL AS DOUBLE) AS broken, CAST(NULL AS DOUBLE) AS failing, 'broken: AnalysisException,failing: SparkRuntimeException' AS failed", "transport")
KPI_ROWS = {
    name: with_views(f"SELECT sequence, transportlhmnr, zug_id, created FROM transport s WHERE {where} AND {still}", "transport")
    for name, (_, where, still) in OPEN_STARTS.items()
}
# The same starts whatever their age.
OPEN_ANY_AGE = with_views(
    "SELECT sequence, transportlhmnr, zug_id, created FROM transport s WHERE "
    + BGL_BSF.replace(f" AND {since(7)}", "") + " AND " + OPEN_STARTS["bgl_bsf_ov"][2], "transport")
ROLLING_WINDOW = with_views(f"""SELECT 2 AS days, count(*) AS n FROM transport WHERE {since(2)}
UNION ALL SELECT 5, count(*) FROM transport WHERE {since(5)} UNION ALL SELECT 7, count(*) FROM transport WHERE {since(7)}""", "transport")
NULLABLE_EXCLUDE = with_views("SELECT lagbez, count(*) AS n FROM transport WHERE lagbez <> 'AKL' OR lagbez IS NULL GROUP BY ALL", "transport")
DISTINCT_ROWS = with_views("SELECT DISTINCT transportlhmnr, zug_id FROM transport WHERE typ_id=47", "transport")

# --- Hazardous stock -------------------------------------------------------------------------

VOLUME = ("CASE WHEN regexp_full_match(trim(replace(volume_text, ',', '')), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
          "THEN CAST(trim(replace(volume_text, ',', '')) AS DOUBLE) ELSE 0 END")
READY = ("(upper(trim(coalesce(channel,''))) = 'OUTLET' AND NOT upper(trim(place)) LIKE 'OLAP%' "
         "AND NOT upper(trim(place)) LIKE 'FIN%' AND trim(carrier) LIKE '50%')")
OF_CATEGORY = "category = 'Beauty' AND place NOT LIKE 'T%' AND place NOT LIKE 'BSF_T%'"
STOCK_BY_CATEGORY = with_views(f"SELECT place, channel, carrier, count(*) AS n FROM stock_volume WHERE {OF_CATEGORY} GROUP BY ALL", "stock_volume")
HAZARD_STOCK = with_views(f"""SELECT carrier, mainlhm, artnr, place, coalesce(channel,'') AS channel, coalesce(volume_text,'') AS volume_text,
 category, booked, coalesce(direction,'') AS direction, {VOLUME} AS volume, {READY} AS ready
FROM stock_volume WHERE {OF_CATEGORY} AND regexp_matches(mainlhm, '^[0-9]')""", "stock_volume")
TOTAL_READY = with_views(f"""SELECT count(*) AS rows, sum({VOLUME}) AS total_vol, sum(CASE WHEN {READY} THEN {VOLUME} ELSE 0 END) AS ready_vol
FROM stock_volume""", "stock_volume")
MASK_AND = with_views(f"SELECT channel, place, {READY} AS ready, count(*) AS n FROM stock_volume GROUP BY ALL", "stock_volume")
CLASSES = "classes(un_no, hazard_class, volume_limit) AS (VALUES ('UN1950','2.1',1e9), ('UN1266','3',5e9), ('UN1170','3',1e6))"
MERGED = f"""{CLASSES},
merged AS (SELECT s.*, {VOLUME} AS volume, h.un_no, hazard_class, volume_limit
  FROM stock_volume s LEFT JOIN handling_unit h USING (artnr) LEFT JOIN classes ON classes.un_no = h.un_no)"""
HAZARD = ("stock_volume", "handling_unit")
HAZARD_MERGE = with_views(f"WITH {MERGED} SELECT un_no, hazard_class, count(*) AS n, sum(volume) AS volume FROM merged GROUP BY ALL", *HAZARD)
HAZARD_ROLLUP = with_views(f"""WITH {MERGED} SELECT place, hazard_class, un_no, CAST(grouping(place, hazard_class, un_no) AS BIGINT) AS level, sum(volume) AS volume
FROM merged GROUP BY ROLLUP (place, hazard_class, un_no)""", *HAZARD)
HAZARD_DRILL = with_views(f"""WITH {MERGED} SELECT carrier, artnr, CAST(grouping(carrier, artnr) AS BIGINT) AS level, sum(volume) AS volume
FROM merged GROUP BY ROLLUP (carrier, artnr)""", *HAZARD)
HAZARD_COMPLIANCE = with_views(f"""WITH {MERGED},
t AS (SELECT hazard_class, un_no, CAST(volume_limit AS DOUBLE) AS volume_limit, sum(CASE direction WHEN 'out' THEN -volume ELSE volume END) AS volume,
  CAST(date_diff('day', min(booked), max(booked)) + 1 AS BIGINT) AS days FROM merged WHERE hazard_class IS NOT NULL GROUP BY 1, 2, 3)
SELECT *, CASE WHEN volume > 0 THEN greatest(0.0, volume_limit - volume) / (volume / days) END AS days_to_limit, volume > volume_limit AS over_limit FROM t""", *HAZARD)

# --- Audits ------------------------------------------------------------------------------------

DPMI = """s AS (SELECT bucket, sub_process, CAST(sum(items) AS BIGINT) AS items, CAST(sum(defects) AS BIGINT) AS defects, sum(defects) * 1e6 / sum(items) AS dpmi
  FROM audit GROUP BY ALL),
t AS (SELECT bucket, sub_process, items, defects, CAST(dpmi AS DOUBLE) AS dpmi, dpmi < 3500 AS target_met FROM s)"""
MULTI_SOURCE = with_views("""SELECT sub_process AS source, CASE WHEN sub_process NOT LIKE 'A%' THEN bucket END AS bucket, count(*) AS n, CAST(sum(defects) AS BIGINT) AS defects FROM audit GROUP BY ALL""", "audit")
DPMI_SCORE = with_views(f"WITH {DPMI} SELECT * FROM t", "audit")
QUALITY_SCORE = with_views(f"""WITH {DPMI} SELECT CASE WHEN grouping(bucket) = 1 THEN 'overall' ELSE bucket END AS bucket, count(*) AS targets, count(*) FILTER (target_met) AS met,
 CAST(count(*) FILTER (target_met) * 100.0 / count(*) AS DOUBLE) AS score FROM t GROUP BY ROLLUP (bucket)""", "audit")

# --- Orders ----------------------------------------------------------------------------------------


def moment(text: str) -> str:
    return f"strptime({text}, '%d.%m.%Y %H:%M:%S')"


def second(when: str) -> str:
    return f"CAST(hour({when})*3600 + minute({when})*60 + second({when}) AS INTEGER)"


CARTONS = f"""cartons AS (SELECT carrier AS carton,
  min(CASE WHEN event='Transportrequest erstellt' THEN {moment('stamp')} END) AS released,
  min(CASE WHEN event='Transportrequest erledigt' AND to_place LIKE 'PALAP%' THEN {moment('stamp')} END) AS arrived
  FROM transport_log WHERE carrier_type LIKE 'Versand%' GROUP BY 1)"""
SIZES = """ranked AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY changed, colli) AS n_any,
  row_number() OVER (PARTITION BY order_no, channel ORDER BY changed, pallets) AS n_own FROM order_status WHERE status='Finalisierung gestartet'),
sizes AS (SELECT o.order_no, o.pallets, a.colli FROM ranked o JOIN ranked a ON a.order_no=o.order_no AND a.n_any=1 WHERE o.channel='OUTLET' AND o.n_own=1)"""
WINDOWS = f"""{CARTONS}, {SIZES},
monitor AS (SELECT m.*, CAST({moment('release_text')} AS DATE) AS day, {second('released')} AS s, {second('arrived')} AS e FROM order_monitor m LEFT JOIN cartons USING (carton)
  WHERE channel='OUTLET' AND carton LIKE '4%' AND state <> 'Deleted'),
win AS (SELECT DISTINCT order_no, day, station, max(s) OVER (PARTITION BY order_no) AS start, max(e) OVER (PARTITION BY order_no) AS "end" FROM monitor),
orders_in AS (SELECT win.*, pallets, colli, CAST(floor((dayofyear(day) + dayofweek(date_trunc('year', day)) - 1) / 7) + 1 AS INTEGER) AS week
  FROM win JOIN sizes USING (order_no) WHERE colli > 16)"""
ROUTES = {
    "aklg_to_zu": "from_place='AKL_G' AND to_place='ZU' AND carrier_type='Outletbehälter'",
    "pall_to_vd": "from_place='PALL' AND to_place='VD' AND carrier_type='Outletbehälter'",
    "akl_to_pallpzu": "from_place='AKL' AND to_place='PALLPZU' AND carrier_type='Outletbehälter'",
    "aklg_to_ol": "from_place='AKL G' AND to_place='OL' AND carrier_type='Outletbehälter'",
    "gs_to_akl": "from_place='GS' AND to_place='AKL' AND carrier_type='Outletbehälter'",
    "any_to_akl": "to_place='AKL' AND carrier_type='Outletbehälter'",
    "aklg_out": "from_place='AKL G' AND carrier_type='Outletbehälter'",
    "akl_carton_out": "from_place='AKL' AND carrier_type='Versandkarton'",
    "aklg_any_out": "from_place='AKL G'",
}
INCLUSIVE = ("aklg_out", "akl_carton_out", "aklg_any_out")


def route_count(name: str) -> str:
    inside = "x.at >= start AND x.at <= \"end\"" if name in INCLUSIVE else "x.at > start AND x.at < \"end\""
    return f"count(DISTINCT CASE WHEN {inside} AND {ROUTES[name]} THEN x.carrier END) AS {name}"


COUNTED = f"""{WINDOWS},
moves AS (SELECT carrier, carrier_type, from_place, to_place, CAST({moment('stamp')} AS DATE) AS day, {second(moment('stamp'))} AS at
  FROM transport_log WHERE event='Transportrequest gestartet'),
counted AS (SELECT o.order_no, o.day, o.station, o.start, o."end", o.pallets, o.colli, o.week, {', '.join(route_count(name) for name in ROUTES)}
  FROM orders_in o LEFT JOIN moves x ON x.day = o.day AND x.at BETWEEN o.start AND o."end" GROUP BY ALL)"""
DURATION = f"""{COUNTED},
timed AS (SELECT *, CAST("end" - start AS DOUBLE) AS duration_s FROM counted)"""
ORDER_TABLES = ("transport_log", "order_status", "order_monitor")
RATES = """duration_s, duration_s / nullif(colli, 0) AS seconds_per_colli, CAST(colli AS DOUBLE) / nullif(duration_s / 60, 0) AS colli_per_minute,
 duration_s / nullif(pallets, 0) AS seconds_per_pallet, CASE WHEN start BETWEEN 21600 AND 53100 THEN 1 ELSE 2 END AS shift"""
ORDER_DURATION = with_views(f"""WITH {DURATION} SELECT order_no, day AS date, station, start, "end", pallets, colli, week, {', '.join(ROUTES)}, {RATES} FROM timed""", *ORDER_TABLES)
INTERVAL_CONGESTION = with_views(f"WITH {COUNTED} SELECT order_no, {', '.join(ROUTES)} FROM counted", *ORDER_TABLES)
MAX_IF = with_views(f"""WITH {CARTONS} SELECT order_no, max({second('released')}) AS start, max({second('arrived')}) AS "end" FROM order_monitor LEFT JOIN cartons USING (carton) GROUP BY 1""", *ORDER_TABLES)
FIRST_MATCH = with_views(f"WITH {SIZES} SELECT order_no, pallets, colli FROM sizes", "order_status")
DURATION_METRICS = with_views(f"WITH {WINDOWS}, timed AS (SELECT *, CAST(\"end\" - start AS DOUBLE) AS duration_s FROM orders_in) SELECT order_no, {RATES} FROM timed", *ORDER_TABLES)
CORRELATION = with_views(f"""WITH {DURATION} SELECT count(duration_s) AS orders, {', '.join(f"round(CASE WHEN var_pop({r}) > 0 THEN corr(CAST({r} AS DOUBLE), duration_s) END, 9) AS {r}" for r in ROUTES)} FROM timed""", *ORDER_TABLES)
APPEND_NEW_KEYS = with_views(f"""SELECT order_no, carton FROM (SELECT order_no, carton, row_number() OVER (PARTITION BY order_no ORDER BY carton) AS n FROM order_monitor)
WHERE n = 1 AND order_no NOT IN (SELECT order_no FROM order_status WHERE status = 'Angelegt')""", "order_monitor", "order_status")

# --- Ideas -------------------------------------------------------------------------------------------

TICKET = r"TRY_CAST(nullif(regexp_extract(ticket, '^\s*([+-]?[0-9]+)', 1), '') AS BIGINT)"
TRANSLATION_PENDING = with_views("SELECT ticket, source_text FROM intake WHERE coalesce(target_text,'')='' AND coalesce(source_text,'')<>''", "intake")
NOTIFICATION_OUTBOX = with_views(f"""SELECT number, 'TKT-' || right('000' || number, 3) AS ticket_id, source_text FROM (SELECT *, {TICKET} AS number FROM intake)
WHERE number >= 65 AND coalesce(status,'')='' AND number NOT IN (SELECT doc_id FROM labels)""", "intake")
FIRST_NAME = "upper(substr(split_part(split_part(mail,'@',1),'.',1),1,1)) || substr(split_part(split_part(mail,'@',1),'.',1),2)"
POINTS = r"TRY_CAST(nullif(regexp_extract(points, '^\s*([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)', 1), '') AS DOUBLE)"
REWARD_DIGEST = with_views(f"SELECT mail, {FIRST_NAME} AS first_name, {POINTS} AS points FROM scoreboard WHERE trim(mail) <> '' AND {POINTS} > 0", "scoreboard")
TICKET_FORMAT = with_views(f"SELECT ticket, 'TKT-' || right('000' || {TICKET}, 3) AS ticket_id FROM intake", "intake")
NAME_FROM_MAIL = with_views(f"SELECT mail, {FIRST_NAME} AS first_name FROM scoreboard", "scoreboard")

# --- Single operators over the ledger -------------------------------------------------

READ_LEDGER = with_views(f"""SELECT local_transaction_id, sequence, tpartnr, menge, created FROM ledger
WHERE created BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59'""", "ledger")
DIMENSION_DEDUP = with_views("SELECT ean, min(brand_name) AS brand_name FROM brand_dim GROUP BY 1", "brand_dim")
ENRICH = with_views(f"""WITH {BRANDS}, d AS (SELECT artnr AS ean, count(*) AS n FROM ledger GROUP BY 1)
SELECT d.ean, n, {BRAND} AS brand_name FROM d LEFT JOIN brands ON d.ean = brands.ean""", "ledger", "brand_dim")
SELECT_RENAME = with_views("SELECT artnr AS article, menge AS quantity, ziel AS place FROM ledger", "ledger")
LEG_SELECT = with_views(f"""SELECT good_type, side, count(*) AS n, CAST(sum(q) AS BIGINT) AS quantity FROM (
 SELECT CASE tpartnr WHEN 520 THEN 'NORMAL' ELSE 'DUMMY' END AS good_type, 'out' AS side, abs(menge) AS q FROM ledger
  WHERE tpartnr IN (520,614) AND menge<0 AND lagbez IN {AREAS} AND ziel LIKE 'OV%'
 UNION ALL SELECT CASE tpartnr WHEN 520 THEN 'NORMAL' ELSE 'DUMMY' END, 'in', menge FROM ledger
  WHERE menge=1 AND lagbez IN {AREAS} AND lhmnr NOT LIKE '000%' AND (tpartnr=520 OR tpartnr=207 AND ziel LIKE 'OV%')) GROUP BY ALL""", "ledger")
BETWEEN_WINDOW = with_views(f"""SELECT tpartnr, count(*) AS n FROM ledger
WHERE created BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59' GROUP BY ALL""", "ledger")
REFERENCE_OF = attr("cust_data", "REFERENCENUMBER_LHM")
REF_FILTER = with_views(f"""WITH r AS (SELECT {REFERENCE_OF} AS reference FROM ledger)
SELECT 'all' AS filter, count(*) AS n FROM r
UNION ALL SELECT 'pattern', count(*) FROM r WHERE upper(reference) LIKE 'AY%'
UNION ALL SELECT 'list', count(*) FROM r WHERE upper(reference) IN ('Z1','AY3','7')
UNION ALL SELECT 'value', count(*) FROM r WHERE upper(reference) = 'Z5'
UNION ALL SELECT 'both', count(*) FROM r WHERE upper(reference) LIKE 'Z%,7' OR upper(reference) IN ('Z%','7')""", "ledger")
SELF_TRANSFER = with_views("""SELECT o.lhmnr AS source_lhm, i.lhmnr AS ziel_lhm, count(*) AS n
FROM (SELECT * FROM ledger WHERE menge<0) o JOIN (SELECT * FROM ledger WHERE menge=1) i USING (local_transaction_id)
WHERE (o.lhmnr IS NULL OR i.lhmnr IS NULL OR o.lhmnr <> i.lhmnr) GROUP BY ALL""", "ledger")
NUMERIC_TARGET = with_views("SELECT lhmnr, count(*) AS n FROM ledger WHERE regexp_full_match(lhmnr,'[0-9]+') GROUP BY ALL", "ledger")
PREFIX_GUARD = with_views("SELECT lhmnr, count(*) AS n FROM ledger WHERE (lhmnr LIKE '4%' OR lhmnr LIKE '5%') AND lhmnr NOT LIKE '000%' GROUP BY ALL", "ledger")
REPORT_PREDICATE = with_views(detail(CHANNEL_BASE, True) + """SELECT 'monthly_zfs' AS report, count(*) AS n FROM d WHERE upper(reference_lhm) LIKE 'Z%'
UNION ALL SELECT 'monthly_beauty', count(*) FROM d WHERE category='Beauty' AND quality='B'""", "ledger")
EAN_TWO = with_views(detail(CHANNEL_BASE, True) + "SELECT ean, count(*) AS n FROM d GROUP BY ALL", "ledger")
EAN_THREE = with_views(f"""WITH {SORTING_PAIRS} SELECT ean, count(*) AS n FROM p
WHERE (src IS NULL OR src <> dst) AND regexp_full_match(dst, '[0-9]+') GROUP BY ALL""", "ledger")
BY_ORIGIN = with_views(detail(CHANNEL_BASE, True) + "SELECT sku, sort_id, count(*) AS n FROM d GROUP BY ALL", "ledger")
JSON_KEYS = ("REFERENCENUMBER_LHM", "QUALITYID_SEKTOR", "QUALITYID_ART", "SORTABLE_ART", "CATEGORYID_ART", "SOURCEID_SEKTOR",
             "DISTRIBUTIONCHANNELID_ART", "SKU_ART", "SORTINGCRITERIAID_ART", "LASTEANGOTFROMMAUS_ZIEL")
JSON_NAMES = ("reference", "grade_sector", "grade_article", "sortable", "category_id", "source_id", "channel_id", "sku", "sort_id", "last_ean")
JSON_FIELDS = with_views("SELECT " + ", ".join(f"{attr('cust_data', k)} AS {n}" for k, n in zip(JSON_KEYS, JSON_NAMES))
                         + ", count(*) AS n FROM ledger GROUP BY ALL", "ledger")
GRADE_SINGLE = with_views(f"WITH {pairs()} SELECT quality, count(*) AS n FROM p WHERE good_type='NORMAL' GROUP BY ALL", "ledger")
GRADE_DUAL = with_views(f"WITH {pairs()} SELECT quality, count(*) AS n FROM p WHERE good_type='DUMMY' GROUP BY ALL", "ledger")
GRADE_PLAIN = with_views(f"SELECT {GRADE_CODE} AS code, {labels(GRADE_CODE, GRADES, 'Unknown')} AS grade, {labels(GRADE_CODE, GRADES, None)} AS grade_or_null, count(*) AS n FROM ledger GROUP BY ALL", "ledger")
CATEGORY_CODE = attr("cust_data", "CATEGORYID_ART")
CATEGORY_MAP = with_views(f"""WITH {pairs()},
d AS (SELECT category, {CATEGORY_NORMAL} AS first_leg, {labels(attr('cd1', 'CATEGORYID_ART'), CATEGORIES, None)} AS or_null FROM p)
SELECT category, first_leg, or_null, count(*) AS n FROM d GROUP BY ALL""", "ledger")
SOURCE_MAP = with_views(f"""WITH {pairs()}, d AS (SELECT {SOURCE} AS source_channel, {labels(attr('cd1', 'SOURCEID_SEKTOR'), SOURCES, 'Resale')} AS sorting_channel FROM p)
SELECT source_channel, sorting_channel, count(*) AS n FROM d GROUP BY ALL""", "ledger")
DISTRIBUTION = with_views(f"""WITH {pairs()}, d AS (SELECT {CHANNEL_BASE} AS base, {CHANNEL_DETAIL} AS detail, {CHANNEL_KPI} AS kpi FROM p)
SELECT base, detail, kpi, count(*) AS n FROM d GROUP BY ALL""", "ledger")
SHIFT_OF = with_views(f"""WITH d AS (SELECT {shift('created')} AS shift, CASE WHEN strftime(created,'%H:%M:%S') BETWEEN '06:00:00' AND '14:45:00' THEN 1 ELSE 2 END AS order_shift,
 {shift("(created AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin'")} AS local_shift FROM ledger)
SELECT shift, order_shift, local_shift, count(*) AS n FROM d GROUP BY ALL""", "ledger")
DATE_PARTS = with_views("""SELECT strftime(created,'%Y-%m-%d') AS iso_day, strftime(created,'%d.%m.%Y') AS day_text, strftime(created,'%Y_%m') AS month_key,
 strftime(created,'%d.%m.%Y %H:%M:%S') AS stamp_text, CAST(created AS DATE) AS day, count(*) AS n FROM ledger GROUP BY ALL""", "ledger")
DAYS = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)"


def to_utc(local: str) -> str:
    return f"(({local}) AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC'"


UTC_WINDOW = f"""SELECT day, {to_utc("day + INTERVAL '5 hours 50 minutes'")} AS start_utc, {to_utc("day + INTERVAL '23 hours 59 minutes'")} AS end_utc FROM {DAYS}"""
MONTH_WINDOW = f"""SELECT DISTINCT {to_utc("CAST(date_trunc('month', day) AS TIMESTAMP)")} AS start_utc,
 {to_utc("CAST(last_day(day) AS TIMESTAMP) + INTERVAL '86399 seconds'")} AS end_utc, strftime(day, '%m.%Y') AS month FROM {DAYS}"""
WEEK_NUMBER = f"""SELECT day, CAST(floor((dayofyear(day) + dayofweek(date_trunc('year', day)) - 1) / 7) + 1 AS INTEGER) AS week FROM {DAYS}"""
NUM_CLEAN = with_views(f"SELECT volume_text, {VOLUME} AS volume, count(*) AS n FROM stock_volume GROUP BY ALL", "stock_volume")
NULL_TO_BLANK = with_views("""SELECT coalesce(sublhm,'') AS sublhm, coalesce(quality,'') AS quality, coalesce(CASE quality WHEN 'A' THEN 1 END, 0) AS is_a, count(*) AS n
FROM stock GROUP BY ALL""", "stock")
BASIC_SCALARS = with_views("""SELECT upper(ziel) AS upper_ziel, lower(lagbez) AS lower_lagbez, trim(' ' || lhmnr || ' ') AS trimmed, CAST(instr(ziel,'_') AS INTEGER) AS position,
 'KF_' || ziel AS joined, CAST(sum(abs(menge)) AS BIGINT) AS quantity FROM ledger GROUP BY ALL""", "ledger")
REPORT_SORT = f"""SELECT *, rank() OVER (ORDER BY strptime(date, '%d.%m.%Y') NULLS FIRST, shift NULLS LAST, reference NULLS LAST) AS position
FROM ({SHIFT_REPORT}) AS r"""
RUN_SUMMARY = with_views(f"""WITH {pairs()}, {CARRIERS}
SELECT 'bookings' AS report, count(*) AS rows, CAST(coalesce(sum(abs(menge)),0) AS DOUBLE) AS total, CASE WHEN count(*) > 0 THEN 'SUCCESS' ELSE 'NO_DATA' END AS status, {AS_OF} AS run_time FROM p
UNION ALL SELECT 'stock', count(*), NULL, CASE WHEN count(*) > 0 THEN 'SUCCESS' ELSE 'NO_DATA' END, {AS_OF} FROM carriers""", "ledger", "stock")

# --- Sinks: what is stored after two runs ------------------------------------------------

REPLACE_BY_KEY = with_views("""SELECT CAST(created AS DATE) AS day, tpartnr, CAST(sum(menge) AS BIGINT) AS quantity FROM ledger GROUP BY ALL""", "ledger")
ROTATE = with_views("""SELECT tpartnr, count(*) AS n, 'kpis' AS report, '04.2026' AS month, 'current' AS version FROM ledger GROUP BY 1
UNION ALL SELECT tpartnr, count(*), 'kpis', '04.2026', 'previous' FROM ledger WHERE menge < 0 GROUP BY 1""", "ledger")
FULL_REFRESH = with_views("SELECT lagbez, count(*) AS n FROM ledger GROUP BY ALL", "ledger")

# --- Streams: what the batch reports say ----------------------------------------------------

KPI_BOARD_STREAM = KPI_BOARD
OPEN_STATE = with_views(" UNION ALL ".join(
    f"SELECT '{name}' AS kpi, {number} AS open_starts FROM transport s WHERE {where} AND {still}"
    for name, (number, where, still) in sorted(OPEN_STARTS.items())), "transport")
INGEST_DEDUP = with_views("""SELECT DISTINCT * FROM ledger""", "ledger")
SHIFT_WINDOWS = with_views(f"""SELECT time_bucket(INTERVAL 5 MINUTE, created) AS window_start, {shift('created')} AS shift, count(*) AS events,
 CAST(sum(abs(menge)) AS BIGINT) AS quantity FROM ledger GROUP BY ALL""", "ledger")
