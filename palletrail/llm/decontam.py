"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Windows have as many shingles of ``SHINGLE`` words as an item.  Weighted similarity of ``t`` needs
2t / (1 + t) of a window's shingles to be the item's, so only windows with that many shingles of items of
their size get a fingerprint; the others cannot be near.  Fingerprints within ``RADIUS`` bits agree
in at least one of ``RADIUS + 1`` blocks, on which windows and items are joined.  Pairs beyond the radius come from the shared shingles: a window
similar to an item holds one of the item's ``m - ceil(t * m) + 1`` rarest.  All pairs are
compared exactly, as the weighted overlap of shingle counts, so that none is missed.

Nulls and edges: null and empty texts, and items without a word, match nothing; a text or item of
fewer than ``SHINGLE`` words is one shingle; a text shorter than an item is one window; rows that agree in id and text
are one; items that repeat an id are compared each for itself, and the best is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palletrail.llm.common import stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BROADCAST_ROWS = 1_000_000
LANE = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingled(rows: DataFrame, text_col: str, size: int, *keep: Column | str) -> DataFrame:
    """(keep, s): ``s`` has the hashes of all runs of ``size`` words, in order; of the whole sequence if there are fewer.

    The words are a column of their own first: within the lambda they would be split anew for every run.
    """
    return rows.select(*keep, words_of(F.col(text_col)).alias("words")).select(
        *keep, _runs(F.col("words"), size).alias("s"))


def _runs(words: Column, size: int) -> Column:
    several = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(size))))
    nothing = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= size, several).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(nothing)


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a stored table for broadcast if it is counted to have at most ``rows`` narrow rows."""
    return F.broadcast(df) if df.count() <= rows else df


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bits): majority fingerprint of the ``h`` of each group, each counted ``c`` times."""
    lanes = [F.expr(f"sum((shiftrightunsigned(h, {i}) & {LANE}L) * c) AS l{i}") for i in range(32)]
    low = [f"IF(2 * (l{i} & 4294967295L) > n, {1 << i}L, 0L)" for i in range(32)]
    high = [f"IF(2 * shiftrightunsigned(l{i}, 32) > n, shiftleft(1L, {i + 32}), 0L)" for i in range(32)]
    return rows.groupBy(*keys).agg(F.sum("c").alias("n"), *lanes).select(*keys, F.expr(" | ".join(low + high)).alias("bits"))


def blocks(bits: Column, radius: int) -> Column:
    """(block, value) of each of ``radius + 1`` stretches of the 64 bits."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    each = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
            for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return F.explode(F.array(*each))


def telling(item: DataFrame, similarity: float) -> DataFrame:
    """(item, item_hash, m, h): the rarest shingles of each item, so many that a window without any of them is not similar."""
    often = item.groupBy("m", "h").agg(F.count("*").alias("items"))
    before = Window.partitionBy("item", "item_hash", "m").orderBy("items", "h").rowsBetween(Window.unboundedPreceding, -1)
    placed = item.join(often, ["m", "h"]).withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    spare = F.col("m") - F.ceil(F.round(F.lit(similarity) * F.col("m"), 6))
    return placed.where(F.col("before") <= spare).select("item", "item_hash", "m", "h")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", size: int = SHINGLE,
                 similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(id, text_hash, item, similarity, start): per text and item the most similar, then first, window in shingles."""
    key = ["id", "text_hash"]
    item = items.select(F.col(item_col).alias("item"), F.xxhash64(item_text_col).alias("item_hash"), F.col(item_text_col).alias("_text"))
    item = shingled(item, "_text", size, "item", "item_hash").distinct()
    item = item.select("item", "item_hash", F.size("s").alias("m"), F.explode_outer("s").alias("h")).where("h is not null")
    item = stored(item.groupBy("item", "item_hash", "m", "h").agg(F.count("*").alias("c")), "items")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("_text"))
    least = lambda n, m: F.ceil(F.round(F.lit(similarity / (1 + similarity)) * (n + m), 6))

    # Shingles of texts that are shingles of items, and the windows that hold enough of them.
    places = shingled(texts, "_text", size, *key)
    # Not the inner explode: its filter on the size of ``s`` would be pushed below the words and split them for every run.
    places = places.select(*key, F.size("s").alias("n"), F.posexplode_outer("s").alias("at", "h"))
    wanted = if_small(stored(item.select("h", "m").distinct(), "item-shingles"))
    hits = places.join(wanted, "h").where(F.col("n") >= F.lit(similarity) * F.col("m")).distinct()
    starts = hits.select(*key, "n", "m", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("at") - F.col("m") + 1), F.least(F.col("at"), F.greatest(F.lit(0), F.col("n") - F.col("m"))))).alias("start"))
    windows = starts.groupBy(*key, "n", "m", "start").agg(F.count("*").alias("found"))
    windows = stored(windows.where(F.col("found") >= least(F.least("n", "m"), F.col("m"))).drop("found", "n"), "windows")

    # The shingles of those windows, from a second pass over the few texts that have any.
    few = if_small(stored(windows.select("id", F.col("text_hash").alias("_hash")).distinct().select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("_id"), "_hash"), "hit-texts"))
    seen = texts.join(few, (F.coalesce(texts["id"].cast("string"), F.lit("null")) == few["_id"])
                      & (texts["text_hash"] == few["_hash"]), "left_semi")
    seen = shingled(seen.dropDuplicates(key), "_text", size, *key)
    other = windows.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "m", "start")
    parts = seen.join(other, seen["id"].eqNullSafe(other["_id"]) & (seen["text_hash"] == other["_hash"]))
    parts = parts.select(*key, "m", "start", F.explode(F.slice("s", F.col("start") + 1, F.col("m"))).alias("h"))
    window = key + ["m", "start"]
    parts = stored(parts.groupBy(*window, "h").agg(F.count("*").alias("c")), "window-shingles")

    # Candidates by fingerprint, then the exact similarity.
    left = simhash(parts, window).select(*window, F.col("bits").alias("a"), blocks(F.col("bits"), radius).alias("k"))
    right = simhash(item, ["item", "item_hash", "m"]).select("item", "item_hash", "m", F.col("bits").alias("b"), blocks(F.col("bits"), radius).alias("k"))
    left, right = left.select(*window, "a", "k.*"), right.select("item", "item_hash", "m", "b", "k.*")
    near = left.join(right, ["m", "block", "value"]).where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select(*window, "item", "item_hash")
    told = if_small(stored(telling(item, similarity), "telling-shingles"))
    near = near.union(parts.join(told, ["m", "h"]).select(*window, "item", "item_hash")).distinct()
    counts = parts.select(*[F.col(c).alias(f"_{c}") for c in window], "h", F.col("c").alias("cw"))
    met = near.join(counts, near["id"].eqNullSafe(counts["_id"]) & (near["text_hash"] == counts["_text_hash"])
                    & (near["m"] == counts["_m"]) & (near["start"] == counts["_start"]))
    own = item.select(F.col("item").alias("_item"), F.col("item_hash").alias("_item_hash"), F.col("h").alias("_h"), "c")
    met = met.join(own, met["item"].eqNullSafe(own["_item"]) & (met["item_hash"] == own["_item_hash"]) & (met["h"] == own["_h"]), "left")
    scored = met.groupBy(*window, "item", "item_hash").agg(
        F.sum("cw").alias("n"), F.sum(F.least("cw", F.coalesce("c", F.lit(0)))).alias("same"))
    scored = scored.select(*key, "item", "start", (F.col("same") / (F.col("n") + F.col("m") - F.col("same"))).alias("similarity"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    return scored.where(F.col("similarity") >= similarity).groupBy(*key, "item").agg(best).select(
        *key, "item", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"))


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, item, similarity, start) of each contaminated document and item."""
    item_col = options.get("item_col", "item_id")
    found = contaminated(docs, items, id_col, text_col, **options).groupBy("id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col),
                        F.col("best.similarity").alias("similarity"), (-F.col("best.back")).cast("long").alias("start"))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    found = contaminated(docs, items, id_col, text_col, **options).select("id", "text_hash").distinct()
    found = if_small(stored(found.select(F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("_id"),
                                         F.col("text_hash").alias("_hash")), "contaminated"))
    return docs.join(found, (F.coalesce(docs[id_col].cast("string"), F.lit("null")) == found["_id"])
                     & (F.xxhash64(docs[text_col]) == found["_hash"]), "left_anti")
