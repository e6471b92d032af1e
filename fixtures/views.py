"""Input tables of the tests and registered queries, derived from the given parquet files.

Each view is one SELECT for both engines; the tokens in braces are the few places
where the dialects differ.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from palletrail.session import brief_shuffles, shared_dir

TOKENS = {
    "spark": {
        "J": "get_json_object",
        "DIV4": "(event_id div 4)",
        "AT": "l_shipdate + make_dt_interval(0,0,0,(l_orderkey*7919+l_partkey*104729)%86400)",
        "AT_LEDGER": "d + make_dt_interval(0,0,0,(k*7919+p*104729)%86400)",
        "RELEASED": "o_orderdate + make_dt_interval(0,0,0,(o_orderkey*7919)%86400)",
        "ENDED": "o_orderdate + make_dt_interval(0,0,0,(o_orderkey*7919)%86400 + (o_orderkey%240)*60 + l_linenumber)",
        "MOVED": "o_orderdate + make_dt_interval(0,0,0,(l_orderkey*7919+l_partkey*104729)%86400)",
        "STAMP": "date_format({}, 'dd.MM.yyyy HH:mm:ss')",
    },
    "duckdb": {
        "J": "json_extract_string",
        "DIV4": "(event_id // 4)",
        "AT": "l_shipdate + to_seconds((l_orderkey*7919+l_partkey*104729)%86400)",
        "AT_LEDGER": "d + to_seconds((k*7919+p*104729)%86400)",
        "RELEASED": "o_orderdate + to_seconds((o_orderkey*7919)%86400)",
        "ENDED": "o_orderdate + to_seconds((o_orderkey*7919)%86400 + (o_orderkey%240)*60 + l_linenumber)",
        "MOVED": "o_orderdate + to_seconds((l_orderkey*7919+l_partkey*104729)%86400)",
        "STAMP": "strftime({}, '%d.%m.%Y %H:%M:%S')",
    },
}

VIEWS: dict[str, str] = {}

VIEWS["ledger"] = """
WITH b AS (
  SELECT l_orderkey k, l_linenumber n, l_partkey p, l_suppkey s, CAST(l_quantity AS INT) q,
         l_partkey % 4 = 0 AS dummy, l_shipdate AS d,
         concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING)) txn,
         l_partkey*100000+l_suppkey AS seq,
         concat('4',lpad(CAST(l_suppkey AS STRING),6,'0')) AS src
  FROM lineitem),
j AS (SELECT *, CASE WHEN k%13=0 THEN '' WHEN k%5=0 THEN concat('"REFERENCENUMBER_LHM":"Z',CAST(k%9 AS STRING),'",') WHEN k%5=1 THEN concat('"REFERENCENUMBER_LHM":"ay',CAST(k%9 AS STRING),'",') ELSE concat('"REFERENCENUMBER_LHM":"',CAST(k%9 AS STRING),'",') END AS ref,
  concat('"CATEGORYID_ART":"',CAST(p%6 AS STRING),'","SORTABLE_ART":"',CASE WHEN p%7=0 THEN 'false' ELSE 'true' END,
   '","SOURCEID_SEKTOR":"',CASE s%4 WHEN 0 THEN '10' WHEN 1 THEN '11' WHEN 2 THEN '7' ELSE '1' END,
   '","DISTRIBUTIONCHANNELID_ART":"',CASE (k+p)%4 WHEN 0 THEN '3' WHEN 1 THEN '4' WHEN 2 THEN '8' ELSE '0' END,
   '","SKU_ART":"SKU',CAST(p AS STRING),'","SORTINGCRITERIAID_ART":"',CAST(p%12 AS STRING),'"') AS common,
  {AT_LEDGER} AS created FROM b)
SELECT txn AS local_transaction_id, seq AS sequence,
  CASE WHEN dummy THEN 120 ELSE 101 END AS typ_id, CASE WHEN dummy THEN 614 ELSE 520 END AS tpartnr,
  concat(CASE WHEN p%3=0 THEN '1' ELSE '2' END,lpad(CAST(p AS STRING),8,'0')) AS artnr,
  CASE n%4 WHEN 0 THEN 'IN_SZR_OV' WHEN 1 THEN 'SZR_OV' ELSE concat('OV0',CAST(n AS STRING)) END AS ziel,
  CASE s%5 WHEN 0 THEN 'AKL' WHEN 1 THEN 'SZROV' ELSE 'Overstock' END AS lagbez,
  src AS lhmnr, -q AS menge, concat('user',CAST(s%7 AS STRING)) AS createdby, created,
  concat('{',ref,CASE WHEN p%5=1 THEN concat('"LASTEANGOTFROMMAUS_ZIEL":"2',CAST(p AS STRING),'",') ELSE '' END,'"QUALITYID_SEKTOR":"',CAST(p%5 AS STRING),'",',common,'}') AS cust_data
FROM j
UNION ALL
SELECT txn, seq, 101, CASE WHEN dummy THEN 207 ELSE 520 END,
  concat('2',lpad(CAST(p AS STRING),8,'0')),
  CASE n%4 WHEN 0 THEN 'IN_SZR_OV' WHEN 1 THEN 'SZR_OV' ELSE concat('OV0',CAST(n AS STRING)) END,
  CASE s%5 WHEN 0 THEN 'AKL' WHEN 1 THEN 'SZROV' ELSE 'Overstock' END,
  CASE p%10 WHEN 0 THEN concat('50',lpad(CAST(p AS STRING),6,'0')) WHEN 1 THEN concat('000',CAST(p AS STRING)) WHEN 2 THEN 'SPENDENLHM' WHEN 3 THEN concat('KF_OV',CAST(n AS STRING)) WHEN 4 THEN src ELSE concat('6',lpad(CAST(p AS STRING),7,'0')) END,
  1, concat('user',CAST(s%7 AS STRING)), created,
  concat('{',CASE WHEN dummy AND p%8=0 THEN concat('"QUALITYID_ART":"',CAST(1+p%4 AS STRING),'",') ELSE '' END,common,'}')
FROM j WHERE k%11<>0
"""

VIEWS["transport"] = """
SELECT event_id AS sequence, CASE event_type WHEN 'click' THEN 42 WHEN 'view' THEN 42 WHEN 'purchase' THEN 47 WHEN 'error' THEN 39 ELSE 132 END AS typ_id,
 concat('1',CAST(user_id AS STRING)) AS lhmnr, concat('1',CAST(user_id AS STRING)) AS transportlhmnr,
 concat('ZUG_',{J}(props,'$.k')) AS zug_id, ts AS created,
 CASE event_id%4 WHEN 0 THEN 'WE' WHEN 1 THEN 'FIN_AP01' WHEN 2 THEN 'BGL1' ELSE 'X' END AS transporttaskquelle,
 CASE {DIV4}%3 WHEN 0 THEN 'BGL' WHEN 1 THEN 'FIN_AP02' ELSE 'BGL9' END AS transporttaskziel,
 CASE {DIV4}%3 WHEN 0 THEN 'BSF_OV' WHEN 1 THEN 'BGL' ELSE 'BSFTO' END AS transportrequestziel,
 CASE event_id%7 WHEN 0 THEN NULL WHEN 1 THEN 'AKL' ELSE 'Wareneingang' END AS lagbez,
 concat('TOK_',CAST(user_id AS STRING)) AS zuggruppe_token, CASE WHEN event_id%5=0 THEN 'OTHER' ELSE 'BESTANDFREIGABE' END AS zuggruppe_sender
 FROM events
"""

VIEWS["outlet"] = """
SELECT 103 AS typ_id, 202 AS tpartnr, l_partkey*100000+l_suppkey AS sequence,
 concat(CASE l_suppkey%3 WHEN 0 THEN '4' WHEN 1 THEN '5' ELSE '9' END,lpad(CAST(l_suppkey AS STRING),6,'0')) AS lhmnr, concat('2',lpad(CAST(l_partkey AS STRING),8,'0')) AS artnr,
 concat('OV0',CAST(l_linenumber AS STRING)) AS ziel, CAST(l_quantity AS INT) AS menge, {AT} AS created,
 concat('{"CATEGORYID_ART":"',CAST(l_partkey%6 AS STRING),'","SORTINGCRITERIAID_ART":"',CAST(l_partkey%12 AS STRING),'"',CASE WHEN l_partkey%2=0 THEN concat(',"QUALITYID_SEKTOR":"',CAST(l_partkey%5 AS STRING),'"') ELSE '' END,'}') AS cust_data FROM lineitem
UNION ALL SELECT 102,402,l_partkey*100000+l_suppkey,concat(CASE l_suppkey%3 WHEN 0 THEN '4' WHEN 1 THEN '5' ELSE '9' END,lpad(CAST(l_suppkey AS STRING),6,'0')),concat('2',lpad(CAST(l_partkey AS STRING),8,'0')),concat('OV0',CAST(l_linenumber AS STRING)),CASE WHEN l_orderkey%3=0 THEN -CAST(l_quantity AS INT) ELSE -CAST(floor(l_quantity/3) AS INT) END,{AT},
 concat('{"CATEGORYID_ART":"',CAST(l_partkey%6 AS STRING),'"',CASE WHEN l_partkey%4=0 THEN concat(',"QUALITYID_SEKTOR":"',CAST(l_partkey%5 AS STRING),'"') ELSE '' END,'}') FROM lineitem WHERE l_orderkey%7=0
UNION ALL SELECT 101,520,l_partkey*100000+l_suppkey,concat('KF_OV0',CAST(l_linenumber AS STRING)),concat('2',lpad(CAST(l_partkey AS STRING),8,'0')),'KF',1,{AT},concat('{"QUALITYID_SEKTOR":"',CAST(1+l_partkey%4 AS STRING),'"}') FROM lineitem WHERE l_orderkey%14=0
UNION ALL SELECT 120,614,l_partkey*100000+l_suppkey,concat(CASE l_suppkey%3 WHEN 0 THEN '4' WHEN 1 THEN '5' ELSE '9' END,lpad(CAST(l_suppkey AS STRING),6,'0')),concat('2',lpad(CAST(l_partkey AS STRING),8,'0')),concat('OV0',CAST(l_linenumber AS STRING)),-1,{AT},concat('{"QUALITYID_SEKTOR":"',CAST(1+(l_partkey+l_linenumber)%4 AS STRING),'"}') FROM lineitem WHERE l_orderkey%6=0
"""

VIEWS["stock"] = """
SELECT DISTINCT concat(CASE l_suppkey%3 WHEN 0 THEN '4' WHEN 1 THEN '5' ELSE '9' END,lpad(CAST(l_suppkey AS STRING),6,'0')) AS mainlhm,
 CASE WHEN l_partkey%3=0 THEN NULL ELSE concat('5',lpad(CAST(l_partkey%50 AS STRING),6,'0')) END AS sublhm, concat('2',lpad(CAST(l_partkey AS STRING),8,'0')) AS artnr,
 CASE (l_partkey+l_linenumber)%6 WHEN 0 THEN NULL WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' ELSE 'D' END AS quality FROM lineitem WHERE l_orderkey%5=0
"""

VIEWS["brand_dim"] = """
SELECT concat('2',lpad(CAST(p_partkey AS STRING),8,'0')) AS ean, p_brand AS brand_name FROM part WHERE p_partkey%9<>0
UNION ALL
SELECT concat('2',lpad(CAST(p_partkey AS STRING),8,'0')), concat(p_brand,'-second') FROM part WHERE p_partkey%10=0
"""

VIEWS["inbound"] = """
SELECT 103 AS typ_id, l_partkey*100000+l_suppkey AS sequence, 'WE' AS ziel, {AT} AS created,
 concat('4',lpad(CAST(l_suppkey AS STRING),6,'0')) AS transportlhmnr,
 CASE (l_partkey*100000+l_suppkey)%3 WHEN 1 THEN 'Sorter' ELSE 'Wareneingang' END AS lagbez,
 CASE (l_partkey*100000+l_suppkey)%3 WHEN 0 THEN concat('UN',CAST(l_orderkey AS STRING)) WHEN 1 THEN concat('LCCONTENT',CAST(l_orderkey AS STRING)) ELSE concat('X',CAST(l_orderkey AS STRING)) END AS hostauftrnr,
 CASE WHEN l_linenumber%4<>0 THEN 1 ELSE CAST(l_quantity AS INT) END AS menge,
 concat('{"QUALITYID_ART":"',CAST(l_partkey%6 AS STRING),'"',CASE WHEN l_orderkey%3=0 THEN concat(',"REFERENCENUMBER_LHM":"R',CAST(l_orderkey%9 AS STRING),'"') ELSE '' END,'}') AS cust_data
FROM lineitem
"""

VIEWS["stock_volume"] = """
SELECT concat(CASE l_suppkey%4 WHEN 0 THEN '50' WHEN 1 THEN ' 50' WHEN 2 THEN '4' ELSE 'A' END,lpad(CAST(l_suppkey AS STRING),6,'0')) AS carrier,
 concat(CASE l_partkey%4 WHEN 0 THEN 'H' ELSE '3' END,lpad(CAST(l_partkey AS STRING),7,'0')) AS mainlhm,
 concat('2',lpad(CAST(l_partkey AS STRING),8,'0')) AS artnr,
 CASE l_linenumber WHEN 1 THEN 'OLAP01' WHEN 2 THEN ' fin02' WHEN 3 THEN 'T01' WHEN 4 THEN 'BSF_T01' WHEN 5 THEN 'BSFXT02' ELSE concat('AP0',CAST(l_linenumber AS STRING)) END AS place,
 CASE l_orderkey%4 WHEN 0 THEN 'Outlet' WHEN 1 THEN ' OUTLET ' WHEN 2 THEN 'Overstock' ELSE NULL END AS channel,
 CASE WHEN l_partkey%11=0 THEN 'n/a' WHEN l_partkey%13=0 THEN '' WHEN l_partkey%17=0 THEN 'NaN' WHEN l_partkey%19=0 THEN 'Infinity' WHEN l_partkey%23=0 THEN '1d' WHEN l_extendedprice<1000 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)
  ELSE concat(' ',CAST(CAST(floor(l_extendedprice/1000) AS BIGINT) AS STRING),',',lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT)%1000 AS STRING),3,'0')) END AS volume_text,
 CASE l_partkey%6 WHEN 1 THEN 'Schuhe' WHEN 2 THEN 'Textil' WHEN 3 THEN 'ACC' WHEN 4 THEN 'Home' WHEN 5 THEN 'Beauty' ELSE NULL END AS category,
 l_shipdate AS booked, CASE l_returnflag WHEN 'R' THEN 'out' ELSE 'in' END AS direction
FROM lineitem
"""

VIEWS["handling_unit"] = """
SELECT concat('2',lpad(CAST(p_partkey AS STRING),8,'0')) AS artnr,
 CASE p_partkey%5 WHEN 0 THEN NULL WHEN 1 THEN 'UN1950' WHEN 2 THEN 'UN1266' WHEN 3 THEN 'UN1170' ELSE 'UN9999' END AS un_no
FROM part
"""

VIEWS["audit"] = """
SELECT CASE WHEN l_partkey%37=0 THEN NULL WHEN l_returnflag='A' THEN 'inbound' WHEN l_returnflag='N' THEN 'stock accuracy' ELSE 'outbound' END AS bucket,
 concat(l_returnflag,'_',l_linestatus) AS sub_process, 1 AS items, CASE WHEN l_tax >= 0.07 AND l_partkey%40 < 5 AND l_returnflag <> 'N' OR l_partkey%997=0 THEN 1 ELSE 0 END AS defects
FROM lineitem
"""

VIEWS["order_monitor"] = """
SELECT CAST(l_orderkey AS STRING) AS order_no, CASE l_returnflag WHEN 'R' THEN 'Deleted' ELSE 'Active' END AS state,
 concat(CASE WHEN l_partkey%10=0 THEN '5' ELSE '4' END,lpad(CAST(l_orderkey AS STRING),8,'0'),CAST(l_linenumber AS STRING)) AS carton,
 {RELEASED_TEXT} AS release_text, CASE l_orderkey%3 WHEN 0 THEN 'OVERSTOCK' ELSE 'OUTLET' END AS channel,
 concat('AP',CAST(o_custkey%5 AS STRING)) AS station
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

VIEWS["order_status"] = """
SELECT CAST(o_orderkey AS STRING) AS order_no, CASE o_orderkey%5 WHEN 0 THEN 'Angelegt' ELSE 'Finalisierung gestartet' END AS status,
 CASE o_orderkey%3 WHEN 0 THEN 'OVERSTOCK' ELSE 'OUTLET' END AS channel, CAST(1+o_orderkey%4 AS INT) AS pallets, CAST(o_orderkey%24*2 AS INT) AS colli, {RELEASED} AS changed
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS STRING), 'Finalisierung gestartet', 'OUTLET', 1, 30, o_orderdate FROM orders WHERE o_orderkey%11=0
"""

VIEWS["transport_log"] = """
SELECT concat(CASE WHEN l_partkey%10=0 THEN '5' ELSE '4' END,lpad(CAST(l_orderkey AS STRING),8,'0'),CAST(l_linenumber AS STRING)) AS carrier,
 'Versandkarton' AS carrier_type, CASE WHEN l_partkey%23=0 THEN 'Transportrequest storniert' ELSE 'Transportrequest erstellt' END AS event, 'AKL' AS from_place, 'PALAP01' AS to_place, {RELEASED_TEXT} AS stamp
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
UNION ALL
SELECT concat(CASE WHEN l_partkey%10=0 THEN '5' ELSE '4' END,lpad(CAST(l_orderkey AS STRING),8,'0'),CAST(l_linenumber AS STRING)),
 'Versandkarton', 'Transportrequest erledigt', 'AKL', CASE WHEN l_suppkey%9=0 THEN 'OL' ELSE 'PALAP01' END, {ENDED_TEXT}
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
UNION ALL
SELECT concat('B',CAST(l_partkey%20 AS STRING)), CASE WHEN l_suppkey%6=0 THEN 'Versandkarton' ELSE 'Outletbehälter' END,
 CASE WHEN l_linenumber=7 THEN 'Transportrequest erstellt' ELSE 'Transportrequest gestartet' END,
 CASE l_suppkey%5 WHEN 0 THEN 'AKL_G' WHEN 1 THEN 'PALL' WHEN 2 THEN 'AKL' WHEN 3 THEN 'AKL G' ELSE 'GS' END,
 CASE l_suppkey%5 WHEN 0 THEN 'ZU' WHEN 1 THEN 'VD' WHEN 2 THEN 'PALLPZU' WHEN 3 THEN 'OL' ELSE 'AKL' END, {MOVED_TEXT}
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

VIEWS["intake"] = """
SELECT CASE WHEN doc_id%7=0 THEN concat('X',CAST(doc_id AS STRING)) WHEN doc_id%7=1 THEN concat(CAST(doc_id AS STRING),' b') ELSE CAST(doc_id AS STRING) END AS ticket,
 CASE WHEN doc_id%10=9 THEN '' ELSE text END AS source_text, CASE WHEN doc_id%4=0 THEN '' ELSE lang END AS target_text,
 CASE WHEN doc_id%3=0 THEN '' ELSE 'Sent' END AS status
FROM documents
"""

VIEWS["scoreboard"] = """
SELECT CASE WHEN c_custkey%13=0 THEN '  ' WHEN c_custkey%17=0 THEN NULL ELSE concat(lower(replace(c_name,'#','')),'.x@example.org') END AS mail,
 CASE c_custkey%11 WHEN 0 THEN 'NaN' WHEN 1 THEN concat(CAST(c_custkey AS STRING),'abc') WHEN 2 THEN '' ELSE CAST(c_custkey%7-2 AS STRING) END AS points
FROM customer
"""

def view_sql(name: str, dialect: str) -> str:
    sql = VIEWS[name]
    tokens = dict(TOKENS[dialect])
    stamp = tokens.pop("STAMP")
    for moment in ("RELEASED", "ENDED", "MOVED"):
        sql = sql.replace("{" + moment + "_TEXT}", stamp.replace("{}", tokens[moment]))
    for token, text in tokens.items():
        sql = sql.replace("{" + token + "}", text)
    return sql.strip()


# Raw tables are spread by these keys, so that all cores derive, however few files there are.
SPREAD = {"lineitem": ("l_orderkey",), "orders": ("o_orderkey",), "events": ("event_id",),
          "documents": ("doc_id",), "part": ("p_partkey",), "customer": ("c_custkey",)}
# Views with a time take their rows in order of these instead; the second column only splits days with many rows.
IN_TIME = {"lineitem": ("l_shipdate", "l_orderkey"), "events": ("ts", "event_id")}
RAW_ROWS = 500_000  # in one task, so that tasks do not grow with the tables

_stored: dict[tuple[str, str, str], str] = {}


def _read_raw(spark: SparkSession, sf_dir: str, table: str, in_time: bool) -> DataFrame:
    """A raw table dealt out while it is narrow: columns and rows that a view does not take are left out before the shuffle."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if in_time and table in IN_TIME:
        return df.repartitionByRange(max(spark.sparkContext.defaultParallelism, -(-df.count() // RAW_ROWS)), *IN_TIME[table])
    return df.repartition(*SPREAD[table])


def derive_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view computed from the parquet files in ``sf_dir``."""
    sql = view_sql(name, "spark")
    in_time = bool(re.search(r"\bcreated\b", sql))
    for table in SPREAD:
        if re.search(rf"\b{table}\b", sql):
            _read_raw(spark, sf_dir, table, in_time).createOrReplaceTempView(f"fixture_{table}")
            sql = re.sub(rf"\b{table}\b", f"fixture_{table}", sql)
    return spark.sql(sql)


def stored_view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder with the view as a table, derived and written on first use in an application.

    Queries then read a ledger the way a site has it: typed columns in files that hold few days
    each, with filters and column choice pushed into the scan.  The raw rows are put in order of time
    before they become the much wider rows of a view, which are written where they are made.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}/{name}"
        with brief_shuffles(spark):
            derive_view(spark, sf_dir, name).write.option("compression", "zstd").parquet(path)
        _stored[key] = path
    return _stored[key]


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(stored_view(spark, sf_dir, name))


def stream_view(spark: SparkSession, sf_dir: str, name: str, order: str, deliveries: int = 1, batches: int = 3) -> DataFrame:
    """The view as a stream of ``batches`` batches per delivery, dealt by ``order`` and not by time, so that some rows come late.

    Every task that reads the view writes its rows of a batch as a file, so that a batch is written by as many tasks as
    read the view, and one trigger takes that many files.  Files of a batch that is done are removed, as from a landing folder.
    """
    view = spark_view(spark, sf_dir, name)
    files = max(1, min(len(view.inputFiles()), view.rdd.getNumPartitions()))
    path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    for delivery in range(deliveries):
        for batch in range(batches):
            view.where(f"pmod(hash({order}), {batches}) = {batch}").coalesce(files).write.option("compression", "zstd").parquet(f"{path}/{delivery}-{batch}")
    landed = spark.readStream.schema(view.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true")
    return landed.option("cleanSource", "delete").parquet(path)


def with_views(sql: str, *names: str) -> str:
    """A DuckDB query that defines the named views first."""
    heads = [f"{name} AS MATERIALIZED (\n{view_sql(name, 'duckdb')}\n)" for name in names]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    return "WITH " + ",\n".join(heads) + "\n" + body
