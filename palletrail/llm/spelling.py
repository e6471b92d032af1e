"""Spelling variants: words one edit apart, found by asymmetric chunks, and the frequent form each belongs to.

The shorter word of a pair (either, if they are equally long) contributes two disjoint chunks, its halves; the other word
contributes grams of their lengths at its places.  One edit leaves one of the halves whole, and moves
it by one place at most, so a pair meets at a chunk whose gram lies within shift one.  A half of a
short word is a poor key, common to very many words; so a key also takes one of the two quarters
of the other half, of which the edit again leaves one whole.  Words that meet are compared exactly.

Nulls and edges: a null or empty word is no word; repeated rows count each; a word of any length is
handled whole, keys being hashes; words with equal keys that are not one edit apart are dropped; a table without words gives no rows;
other columns of the input are not looked at.

Every join asks for a merge of shuffled sides.  Spark sizes a stored table by its packed files and an exploded one by the
rows before, many times too low, and would send tables through the driver that do not fit there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palletrail.llm.common import stored

RUN = r"[A-Za-z\u00C0-\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): every maximal run of Latin letters of the texts, A to Z in lower case; null texts have none."""
    runs = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(f"({RUN})"), 1)
    held = docs.select(F.col(id_col).alias("id"), runs.alias("runs"))
    return held.select("id", F.explode_outer("runs").alias("word")).where("word is not null")


def without(word: Column, place: Column) -> Column:
    """``word`` without its code point at ``place``, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))


def vocabulary(words: DataFrame, word_col: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the distinct words that are long and frequent enough, and how often each occurs."""
    counts = words.select(F.col(word_col).alias("word")).where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _places(length: Column) -> tuple[Column, Column, Column]:
    """Where the second quarter, the second half and the last quarter of a word begin."""
    half = F.shiftright(length, 1)
    return F.shiftright(half, 1), half, half + F.shiftright(length - half, 1)


def _keys(word: Column, length: Column, shift: int) -> Column:
    """Keys of a word that meet the chunks of words of ``length``, its own parts being ``shift`` longer.

    A key names the part that it leaves out: the edit lies there, so what follows is moved by ``shift``.
    """
    part = lambda start, end: F.substring(word, start + 1, end - start)
    zero, (one, half, last), end = F.lit(0), _places(length), length
    kept = [
        [part(one + shift, half + shift), part(half + shift, end + shift)],  # the second half is the chunk, with the second quarter
        [part(zero, one), part(half + shift, end + shift)],                  # ... with the first
        [part(zero, half), part(last + shift, end + shift)],                 # the first half is the chunk, with the last quarter
        [part(zero, half), part(half, last)],                                # ... with the third
    ]
    return F.array(*[F.xxhash64(F.lit(number), length, *parts) for number, parts in enumerate(kept)])


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, b): the words of ``vocab`` exactly one inserted, deleted or replaced code point apart, each pair once.

    ``a`` is the shorter word, or the first in code-point order.
    """
    sized = vocab.select("word", F.length("word").alias("size"))
    chunks = sized.select(F.col("word").alias("a"), F.explode(_keys(F.col("word"), F.col("size"), 0)).alias("key"))
    grams = F.explode(F.concat(_keys(F.col("word"), F.col("size"), 0), _keys(F.col("word"), F.col("size") - 1, 1)))
    grams = sized.select(F.col("word").alias("b"), grams.alias("key"))
    once = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    near = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    return chunks.join(grams.hint("merge"), "key").where(once & near).select("a", "b").distinct()


def roots_of(forms: DataFrame, max_rounds: int = 7) -> DataFrame:
    """(word, root): where the chain of forms ends that begins at ``word``.

    A form is at least twice as frequent as its word, so a chain has fewer than 64 steps, and every
    round halves what is left of it.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max_rounds):
        further = steps.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        moved = steps.join(further.hint("merge"), steps["root"] == further["_word"], "left")
        steps = stored(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "forms")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")
    raise RuntimeError(f"forms still changed after {max_rounds} rounds: their counts do not double")


def variants(words: DataFrame, word_col: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = RATIO) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of each frequent word of ``words``, a row for each occurrence.

    ``form`` is the most frequent near word (ties: the first in code-point order), if it is ``ratio`` (2 or more)
    times as frequent; ``root`` is where following forms ends, the word itself without a form; ``n_near`` counts near words.
    """
    if ratio < 2:
        raise ValueError("with a ratio below 2, forms could go round")
    vocab = stored(vocabulary(words, word_col, min_length, min_count), "words")
    pairs = stored(near_pairs(vocab), "near-words")
    both = pairs.union(pairs.select("b", "a"))
    other = vocab.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = F.min(F.struct((-F.col("m")).alias("back"), F.col("b").alias("form")))
    found = both.join(other.hint("merge"), "b").groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = vocab.join(found.withColumnRenamed("a", "word").hint("merge"), "word", "left")
    often = -F.col("best.back")
    fits = often >= ratio * F.col("n")
    told = stored(told.select("word", "n", F.when(fits, F.col("best.form")).alias("form"), F.when(fits, often).alias("form_n"),
                              F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near")), "variants")
    roots = roots_of(told.where("form is not null"))
    return told.join(roots.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
