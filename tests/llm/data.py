"""Small documents with the cases every operator must stand: nulls, empty, long, repeated, clashing columns."""

import random

from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"
# Columns named like those the operators make must not get in their way.
CLASHING = ("id", "score", "start", "size", "mix", "fp", "root", "part", "row", "h", "m", "n", "shard", "_taken", "doc", "rows", "cut", "own",
            "id_key", "text_key", "drawn", "told")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(n))


def rows():
    near = words(1, 120)
    texts = [(1, near), (2, near + " tail"), (3, near), (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "two words"),
             (9, words(2, 9000)), (10, "Ünïcode ß İ straße \U0001F600 " + words(3, 40)), (None, words(4, 30)),
             (None, None), (12, words(5, 50)), (12, words(5, 50)), (12, words(6, 20)), (13, "x" * 70000), (14, "to " * 300)]
    sources = ["a", "b", "a", None, "a"]
    return [(i, t, ["en", "de", None][k % 3], sources[k % 5], None if t is None else len(t), *["z"] * len(CLASHING))
            for k, (i, t) in enumerate(texts)]


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def simple(spark, pairs):
    """Documents from (doc_id, text) pairs."""
    return documents(spark, [(i, t, "en", "a", None if t is None else len(t), *["z"] * len(CLASHING)) for i, t in pairs])
