"""Helpers shared by the operators: tables, stored intermediates, folds, running totals, components."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palletrail.session import shared_dir

# Words are runs of anything but these ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the one that all executors share."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: short lineage that outlives executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def python_ready(spark: SparkSession, rows: int = 512, size: int = 16 << 20) -> None:
    """Lets tasks import this package, and hands them texts at most ``rows`` and about ``size`` bytes at a time.

    The package is sent to the executors as a zip file through Spark, once per application.  A
    lower setting of the session for the rows of a batch stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > size:
        spark.conf.set(key, f"{size}b")
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        packed = shutil.make_archive(f"{tempfile.mkdtemp()}/palletrail", "zip", root, "palletrail")
        spark.sparkContext.addPyFile(packed)
        _SHIPPED.add(app)


def join_facts(rows: DataFrame, facts: DataFrame, key: str, count: str = "n") -> DataFrame:
    """``rows`` with the columns of stored ``facts`` (one row per ``key``) but ``count``, the number of rows of the key.

    Keys that hold a thousandth of all rows or more are 1,000 at most, and are broadcast; all
    others are shuffled, none of which can be large.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    hot = facts.where(F.col(count) * 1000 >= total).drop(count).withColumn("_hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), key, "left")
    rest = marked.where(F.col("_hot").isNull()).select(rows.columns).join(
        facts.where(F.col(count) * 1000 < total).drop(count).hint("merge"), key)
    return marked.where(F.col("_hot")).drop("_hot").unionByName(rest)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all documents that no model may learn from; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, keys: Sequence[str], hash_col: str, order: Sequence[Column], value: str,
                  name: str, levels: int = 2) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one, within ``keys``, by ``hash_col``, ``order``.

    ``hash_col`` is lower-case hex text.  Its first ``2 * levels`` digits split a key into up to
    256 ** levels groups; the sums of the groups are totalled level by level, so that no task
    holds a whole key, and rows are put in order only within a group.
    """
    keys = list(keys)
    digits = [F.substring(hash_col, 1, 2 * level).alias(f"_g{level}") for level in range(1, levels + 1)]
    groups = [f"_g{level}" for level in range(1, levels + 1)]
    split = df.select("*", *digits)
    sums = split.groupBy(*keys, *groups).agg(F.sum(value).alias("_sum"))
    before = F.lit(0).cast("long")
    offsets = sums
    for level in range(levels, 0, -1):
        own, outer = groups[:level], groups[: level - 1]
        part = sums.groupBy(*keys, *own).agg(F.sum("_sum").alias("_s"))
        window = Window.partitionBy(*keys, *outer).orderBy(groups[level - 1]).rowsBetween(Window.unboundedPreceding, -1)
        part = part.select(*[F.col(c).alias(f"_r_{c}") for c in (*keys, *own)],
                           F.coalesce(F.sum("_s").over(window), F.lit(0)).alias(f"_b{level}"))
        same = [offsets[c].eqNullSafe(part[f"_r_{c}"]) for c in (*keys, *own)]
        condition = same[0]
        for more in same[1:]:
            condition = condition & more
        offsets = offsets.join(part, condition).drop(*part.columns[:-1])
        before = before + F.col(f"_b{level}")
    offsets = offsets.select(*[F.col(c).alias(f"_r_{c}") for c in (*keys, *groups)], before.alias("_before"))
    condition = split[keys[0]].eqNullSafe(offsets[f"_r_{keys[0]}"])
    for c in (*keys[1:], *groups):
        condition = condition & split[c].eqNullSafe(offsets[f"_r_{c}"])
    window = (Window.partitionBy(*keys, *groups).orderBy(F.col(hash_col), *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = split.join(offsets, condition)
    total = F.col("_before") + F.coalesce(F.sum(value).over(window), F.lit(0))
    return joined.withColumn(name, total).select(*df.columns, name)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (node, root), root being the smallest node.

    Alternates the large-star and small-star steps until the edges stand still; each step is a
    minimum per node, combined before its shuffle, and a join in which only the side of the
    edges can be uneven.  Nodes without an edge to another node are not returned.
    """
    spark = edges.sparkSession
    edges = edges.where("a <> b").select("a", "b")
    edges = stored(edges.distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state is not None and tuple(now) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(now)
    raise RuntimeError(f"components still changed after {max_rounds} rounds")
