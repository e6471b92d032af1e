"""Registered queries of the operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palletrail.llm import audit, counts, credentials, decontam, fingerprints, language, mixing, pii, quality, simhash, spelling, tokens, urls
from palletrail.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each document and of its edited text, and their likeness."""
    return fingerprints.neighbour_report(table(spark, sf_dir, "documents"))


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document; the cut lies at 0.3."""
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the similarity of the best window."""
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and checksums of each document, read back from the written blocks."""
    return tokens.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with personal numbers and dates replaced, and how many."""
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of each page."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.rule_table(pages))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document."""
    docs = table(spark, sf_dir, "documents")
    return language.told(docs, language.learn(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document."""
    return credentials.secret_report(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words, after one deletion in every 97th occurrence by hash, with near words and forms; a null id hashes as ``null``."""
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"))
    named = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"), "word")
    runs = runs.select("word", F.crc32(named.cast("binary")).alias("h"))
    place = (F.col("h") % F.length("word")).cast("int")
    worn = F.when(F.col("h") % 97 == 0, spelling.without(F.col("word"), place)).otherwise(F.col("word"))
    return spelling.variants(runs.select(worn.alias("word"))).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders: what each step keeps, removes and loses per language, and each filter's Shapley total."""
    return audit.interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document, and whether it is longer than 4,096 tokens."""
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


ORACLE["op2_source_mix"] = r"""
WITH d AS (SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text,''), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS mix FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
r AS (SELECT *, sum(source_size) OVER () AS words, sum(w) OVER () AS all_w,
    coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_size,
    coalesce(sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_w FROM w),
l AS (SELECT *, (words - full_size * 3.0::DOUBLE) / (all_w - full_w) AS level FROM r),
o AS (SELECT *, source_size * 3.0::DOUBLE > level * w AS open FROM l),
t AS (SELECT source, source_size, CASE WHEN open THEN first_value(level) OVER (ORDER BY open DESC, source_size / w, source NULLS LAST) * w ELSE source_size * 3.0::DOUBLE END AS target FROM o),
g AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS give FROM t),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mix, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM d)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CASE WHEN size = 0 THEN 0 ELSE CAST(size * (give // source_size) + greatest(0, least(pos + size, give % source_size) - pos) AS BIGINT) END AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source
"""

ORACLE["op4_decontamination"] = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
ds AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, len(w) - 4 AS n, w FROM dw WHERE len(w) >= 5),
dsh AS (SELECT doc_id, p - 1 AS pos, n, array_to_string(w[p:p+4], ' ') AS h FROM ds),
ish AS (SELECT item_id, len(w) - 4 AS m, array_to_string(w[p:p+4], ' ') AS h FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM iw WHERE len(w) >= 5)),
ic AS (SELECT item_id, m, h, count(*) AS c FROM ish GROUP BY ALL),
hit AS (SELECT doc_id, pos, n, item_id, m, h, c FROM dsh JOIN ic USING (h) WHERE n >= 0.8 * m),
win AS (SELECT doc_id, item_id, m, n, h, c, unnest(range(greatest(0, pos - m + 1), least(pos, greatest(0, n - m)) + 1)) AS start FROM hit),
cw AS (SELECT doc_id, item_id, m, n, start, h, c, count(*) AS k FROM win GROUP BY ALL),
sc AS (SELECT doc_id, item_id, start, sum(least(k, c)) AS same, least(n, m) + m AS total FROM cw GROUP BY doc_id, item_id, start, n, m),
si AS (SELECT doc_id, item_id, start, CAST(same AS DOUBLE) / CAST(total - same AS DOUBLE) AS similarity FROM sc WHERE CAST(same AS DOUBLE) / CAST(total - same AS DOUBLE) >= 0.8)
SELECT doc_id, item_id, similarity, CAST(start AS BIGINT) AS start FROM si
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

ORACLE["op7_url_rules"] = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) AS t(verdict, rhost, rpath)),
m AS (SELECT page_id, host, path, verdict, rhost || rpath AS rule FROM p LEFT JOIN r
    ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""

ORACLE["op12_filter_audit"] = r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), min(doc_id) OVER (PARTITION BY t) IS NOT NULL) THEN 16 ELSE 0 END AS mask FROM d),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT concat(a.name, b.name, c.name, d.name, e.name) AS filter_order, [a.name, b.name, c.name, d.name, e.name] AS names, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM x AS a, x AS b, x AS c, x AS d, x AS e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, names[step] AS filter, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS seen
    FROM o, unnest(range(1, 6)) AS t(step)),
r AS (SELECT part, filter_order, step, filter,
    CAST(sum(CASE WHEN mask & (bit | seen) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & seen <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM s, c GROUP BY part, filter_order, step, filter)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r
"""
