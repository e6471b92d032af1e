"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents, in shuffled order, form a stream that is cut into blocks of
``block_words`` words.  Slot i of the mix goes to the source whose stretch of cumulated weight
holds frac(i * golden ratio); the k-th slot of a source takes block k of its stream, and starts
over when the stream ends.  The last slot of a source is shortened so that the source gives its
target to the word.

Nulls and edges: null text has no words; documents without words are listed and give none; the
null source is a source of its own, last in order; equal rows share their place in the shuffle in
some order, so that the result as a set is the same; with no words at all every target is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palletrail.llm.common import SPACE, WORD, running_total, stored, word_count

GOLDEN = 0.6180339887498949
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 1024
CHUNK_SLOTS = 1 << 13
CELLS = 1 << 10


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, mix): what the schedule needs of each document; ``mix`` orders the shuffle."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       F.md5(F.concat(F.lit("mix:"), text).cast("binary")).alias("mix")), "sizes")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, give): each source's share of all words, at most ``max_repeats`` times its size.

    With sources in order of size to weight, those before some place are at their limit and the
    others share the rest by weight.  One row per source; the windows over all of them are as
    long as the list of sources.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    total = total.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                               (F.row_number().over(place) - 1) % len(weights) + 1))
    every = Window.partitionBy(F.lit(0))
    ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("source_size") * float(max_repeats)
    counted = total.select(
        "*", F.row_number().over(ratio).alias("place"), F.sum("source_size").over(every).alias("words"), F.sum("w").over(every).alias("all_w"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("full_size"),
        F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("full_w"))
    level = (F.col("words") - F.col("full_size") * float(max_repeats)) / (F.col("all_w") - F.col("full_w"))
    counted = counted.withColumn("open", limit > level * F.col("w")).withColumn("level", level)
    first = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every)
    counted = counted.withColumn("free", first["level"])
    target = F.when(F.col("open"), F.col("free") * F.col("w")).otherwise(limit)
    return counted.select("source", "source_size", target.alias("target"),
                          F.floor(target + 0.5).cast("long").alias("give"))


def quotas(targets: DataFrame, block_words: int) -> DataFrame:
    """Adds the blocks of each source's stream, the slots it needs and its stretch of the unit interval."""
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    epochs = F.floor(F.col("give") / F.col("source_size")).cast("long")
    rest = F.col("give") - epochs * F.col("source_size")
    slots = epochs * blocks + F.ceil(rest / F.lit(block_words)).cast("long")
    used = targets.where("give > 0").select("*", blocks.alias("blocks"), rest.alias("rest"), slots.alias("slots"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(0))
    used = used.select("*", F.sum("slots").over(ordered).alias("upto"), F.sum("slots").over(every).alias("all_slots"))
    return used.select("*", ((F.col("upto") - F.col("slots")) / F.col("all_slots")).alias("lo"),
                       F.when(F.col("upto") == F.col("all_slots"), F.lit(1.0)).otherwise(F.col("upto") / F.col("all_slots")).alias("hi"))


def schedule(quota: DataFrame) -> DataFrame:
    """(slot, source, rank): slot i of the mix and how many slots its source had before.

    Points and stretches meet by cell of the unit interval, and ranks are counted within chunks of
    slots after the totals of the chunks before.  A source that the points gave fewer slots than it needs gets
    the missing ones at the end; slots beyond its need are left out.
    """
    # One row per chunk is made first, so that slots are made in parallel whatever their number.
    chunks = quota.groupBy().agg(F.max("all_slots").alias("n")).where("n > 0").select(
        "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK_SLOTS))).alias("chunk"))
    slots = chunks.repartition("chunk").select("chunk", F.explode(F.sequence(
        F.col("chunk") * CHUNK_SLOTS, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK_SLOTS) - 1)).alias("slot"))
    point = F.col("slot") * F.lit(GOLDEN)
    slots = slots.withColumn("u", point - F.floor(point))
    slots = slots.withColumn("cell", F.floor(F.col("u") * CELLS))
    cells = quota.select("source", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.lit(CELLS - 1), F.floor(F.col("hi") * CELLS)))).alias("cell"))
    drawn = slots.join(cells, "cell").where("u >= lo AND u < hi").select("chunk", "slot", "source")
    sums = drawn.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    before = sums.select(F.col("source").alias("_source"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("n").over(
        Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = drawn.join(before, drawn["source"].eqNullSafe(before["_source"]) & (drawn["chunk"] == before["_chunk"])).select(
        "slot", "source", (F.col("before") + F.row_number().over(within) - 1).alias("rank"))
    needed = quota.select(F.col("source").alias("_source"), "slots", "all_slots")
    got = sums.groupBy("source").agg(F.sum("n").alias("got"))
    late = needed.join(got, needed["_source"].eqNullSafe(got["source"]), "left").select(
        F.col("_source"), "all_slots", "slots", F.coalesce("got", F.lit(0)).cast("long").alias("got")).where("got < slots").select(
        "all_slots", F.col("_source").alias("source"), F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank"))
    kept = ranked.join(needed, ranked["source"].eqNullSafe(needed["_source"])).where("rank < slots")
    return kept.select("slot", "source", "rank").union(
        late.select((F.col("all_slots") + F.col("rank")).alias("slot"), "source", "rank"))


def _met(sizes: DataFrame, quota: DataFrame, block_words: int) -> DataFrame:
    """(slot, source, block, id, size, mix, at, first, words): the slots that take words of each stretch of a document.

    Shuffled streams meet the schedule by source and block: ``words`` words of the document from its
    ``first`` on.  Stretches that no slot takes stay, without a slot.
    """
    last = (F.col("rank") == F.col("slots") - 1) & (F.col("rest") % block_words > 0)
    plan = schedule(quota)  # slots are made and ranked anew from the quotas, never stored
    need = quota.select(F.col("source").alias("_source"), "slots", "blocks", "rest")
    uses = plan.join(need, plan["source"].eqNullSafe(need["_source"])).select(
        "slot", "_source", (F.col("rank") % F.col("blocks")).alias("_block"),
        F.when(last, F.col("rest") % block_words).otherwise(block_words).alias("upto"))
    streams = running_total(sizes.where("size > 0"), ["source"], "mix", [F.col("id"), F.col("size")], "size", "at")
    pieces = streams.select("*", F.explode(F.sequence(
        F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words))).alias("block"))
    start = F.col("block") * block_words
    lo = F.greatest(F.lit(0), F.col("at") - start)
    hi = F.least(F.lit(block_words), F.col("at") + F.col("size") - start)
    pieces = pieces.select("id", "source", "size", "mix", "at", "block", lo.alias("lo"), hi.alias("hi"), (start + lo - F.col("at")).alias("first"))
    met = pieces.join(uses, pieces["source"].eqNullSafe(uses["_source"]) & (pieces["block"] == uses["_block"]), "left")
    words = F.greatest(F.lit(0), F.least("hi", "upto") - F.col("lo"))
    return met.select("slot", "source", "block", "id", "size", "mix", "at", "first", F.when(F.col("slot").isNotNull(), words).alias("words"))


def taken_words(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, source, size, mix, source_size, target, taken): words that the slots take from each document."""
    targets = stored(source_targets(sizes, weights, max_repeats), "targets")
    met = _met(sizes, stored(quotas(targets, block_words), "quotas"), block_words)
    # Rows are told apart by their place in the stream, which differs even for repeated rows.
    taken = met.groupBy("id", "source", "size", "mix", "at").agg(F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"))
    every = taken.drop("at").unionByName(sizes.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    facts = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return every.join(facts, every["source"].eqNullSafe(facts["_source"])).drop("_source")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
             max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, block, id, first, words): the mix itself, in order.

    Every slot takes a block of one source, which is these ``words`` words of its documents, each from its ``first`` word on.
    """
    sizes = sized(docs, id_col, text_col, source_col)
    quota = stored(quotas(source_targets(sizes, weights, max_repeats), block_words), "quotas")
    return _met(sizes, quota, block_words).where("words > 0").orderBy("slot", "at").select(
        "slot", F.col("source").alias(source_col), "block", F.col("id").alias(id_col), "first", "words")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """(id, source, size, source_size, target, taken) of each document."""
    return taken_words(sized(docs, id_col, text_col, source_col), **options).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its given number of words."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?:{SPACE})?{WORD}"), F.lit(0))
    return F.array_join(F.slice(pieces, 1, words.cast("int")), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    chars_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself with the columns of ``docs``: each document as often as it is taken, a rest as its first words.

    Documents of which nothing is taken, and those without words, are not in the mix.  Rows that
    agree in id, source and size share evenly what the mix takes of them.
    """
    sizes = sized(docs, id_col, text_col, source_col)
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    group = ["k", "s", "none", "size"]
    of_source = lambda c: (F.coalesce(F.col(c), F.lit("")).alias("s"), F.col(c).isNull().alias("none"))
    shared = taken_words(sizes, **options).where("taken > 0").groupBy("id", "source", "size").agg(
        F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    shared = shared.select(key("id").alias("k"), *of_source("source"), "size", "taken", "rows")
    text = F.col(f"doc.{text_col}")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), key(id_col).alias("k"), *of_source(source_col),
                        word_count(F.col(text_col)).alias("size"))
    # The first of the rows that share give one word more, if the words do not divide.
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64(text)))
    joined = keyed.join(shared, group).select("doc", "size", (F.floor(F.col("taken") / F.col("rows")) + F.when(
        rank <= F.col("taken") % F.col("rows"), 1).otherwise(0)).alias("own"))
    whole = F.floor(F.col("own") / F.col("size"))
    rest = F.col("own") - whole * F.col("size")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), whole + F.when(rest > 0, 1).otherwise(0)))
    out = joined.where("own > 0").select("doc", whole.alias("whole"), rest.alias("rest"), copies.alias("copy"))
    out = out.withColumn("cut", F.when(F.col("copy") > F.col("whole"), first_words(text, F.col("rest"))))
    made = {text_col: F.coalesce("cut", text)}
    if chars_col:
        made[chars_col] = F.coalesce(F.length("cut").cast(docs.schema[chars_col].dataType), F.col(f"doc.{chars_col}"))
    return out.select([made.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
