"""URL rules by a sort-merge range join: reversed-host keys turn host rules into nested intervals.

The key of a host is its labels from last to first, each followed by a dot.  A rule covers the
hosts whose key begins with its own, an interval; two such intervals are nested or apart.  Rules
and distinct hosts are sorted together by key and swept: the rules still open at a host form its
stack.  Pages then meet the stack of their host and take its longest rule that their path fits.

Nulls and edges: a null url, or one without ``://``, has empty host and path and no rule; an
empty url likewise; a rule needs a host; the longer rule text wins, then the longer host; of equal
rules a block wins over an allow; repeated pages are all judged; with no rule fitting the verdict is ``default``;
other columns are not looked at and not returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the registered query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SALTS = 64


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def stacks(hosts: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """(host, stack): for each distinct host the rules whose interval holds its key.

    Hosts are dealt by last label and a salt, rules to every salt of their last label, so that a
    large domain is swept in many tasks.  Within a task the rules met so far are carried along
    the sort order and those that do not cover the present key are closed.
    """
    label = F.element_at(F.split("key", r"\."), 1)
    rows = hosts.select("host", host_key(F.col("host")).alias("key")).select(
        "*", label.alias("top"), F.pmod(F.xxhash64("host"), F.lit(salts)).alias("salt"), F.lit(1).alias("kind"),
        F.lit(None).cast(rules.schema["rule"].dataType).alias("rule"))
    opened = rules.select(F.lit(None).cast("string").alias("host"), "key", label.alias("top"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), F.lit(0).alias("kind"), "rule")
    # A rule's enclosing rules are found among the rules alone and travel with it, so that the
    # sweep needs only the last rule opened: whatever still covers the host is in that rule's chain.
    sweep = Window.partitionBy("top", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.unionByName(opened).withColumn("last", F.last("rule", ignorenulls=True).over(sweep))
    covering = F.filter("last", lambda r: F.startswith(F.col("key"), r["key"]))
    return met.where("kind = 1").select("host", covering.alias("stack"))


def rule_chains(rules: DataFrame) -> DataFrame:
    """(key, rule): per rule key the array of rules at that key and at the keys around it."""
    at = rules.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("key", "host", "path", "verdict"))).alias("own"))
    depth = F.size(F.split("key", r"\.")) - 1
    around = at.select("key", F.explode(F.sequence(F.lit(1), depth)).alias("n")).select(
        F.col("key").alias("inner"), F.expr("substring_index(key, '.', n)").alias("outer"))
    around = around.select("inner", F.concat("outer", F.lit(".")).alias("outer"))
    chained = around.join(at, around["outer"] == at["key"]).groupBy("inner").agg(F.flatten(F.collect_list("own")).alias("rule"))
    return chained.select(F.col("inner").alias("key"), "rule")


def rule_table(docs_or_pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """The rules (verdict, host, path) with their keys, as a table of the session of the given one."""
    listed = [F.struct(*[F.lit(part).alias(name) for name, part in zip(("verdict", "host", "path"), rule)]) for rule in rules]
    return docs_or_pages.sparkSession.range(1).select(F.inline(F.array(*listed))).where("host <> ''").select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").withColumn(
        "key", host_key(F.col("host")))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", salts: int = SALTS) -> DataFrame:
    """(id, host, path, rule, verdict) of each page under ``rules`` (verdict, host, path, key)."""
    parsed = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    hosts = parsed.where("host <> ''").select("host").distinct()
    open_rules = stacks(hosts, rule_chains(rules), salts).where(F.size("stack") > 0).withColumnRenamed("host", "_host")
    met = parsed.join(open_rules, parsed["host"] == open_rules["_host"], "left")
    text = lambda r: F.concat(r["host"], r["path"])
    ranked = F.transform(F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"])), lambda r: F.struct(
        F.length(text(r)).alias("n"), F.length(r["host"]).alias("h"), r["verdict"].alias("verdict"), text(r).alias("rule")))
    best = F.array_max(ranked)
    return met.select(F.col("id").alias(id_col), "host", "path", best["rule"].alias("rule"),
                      F.coalesce(best["verdict"], F.lit(default)).alias("verdict"))
