"""Language by nearest centroid: TF-IDF vectors of letter n-grams against clustered centroids.

Runs of one to three characters of the lower-cased text are hashed into ``DIMS`` places; their
damped counts are weighted by how few of the learning documents have them, over all of these.
Each language has up to ``CENTROIDS`` centroids, spherical k-means of at most ``SALTS * PER_SALT``
learning documents picked by hash.  The language of the nearest centroid by cosine is told; a text
farther from it than nearly all its learning documents is marked as rejected.

Nulls and edges: null texts and texts without a letter are ``und``, score 0; rows without
language are not learned from; without any learning document every text is ``und``; rows that
repeat an id are told row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palletrail.llm.common import fresh, held_out, python_ready

DIMS = 1 << 13
CENTROIDS = 3
SALTS, PER_SALT = 64, 12
FAR_QUANTILE = 0.005
LETTER = re.compile(r"[^\W\d_]")
_BLANK = np.array([not chr(c).isalpha() for c in range(128)])


def counts(text: str) -> np.ndarray:
    """Damped counts of hashed n-grams; runs of other ASCII characters count as one blank."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    code[(code < 128) & _BLANK[np.minimum(code, 127)]] = 32
    code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
    if len(code) < 3:
        return np.zeros(DIMS, dtype=np.float32)
    one = code * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (code[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (code[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    grams = np.concatenate((one >> shift, two >> shift, three >> shift))
    return np.log1p(np.bincount(grams, minlength=DIMS)).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest first rows: centroids and each row's centroid."""
    centre = unit(x.mean(axis=0, keepdims=True))
    start = [int(np.argmax(x @ centre[0]))]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin((x @ x[start].T).max(axis=1))))
    centre, own = x[start], None
    for _ in range(rounds):
        now = np.argmax(x @ centre.T, axis=1)
        if own is not None and (now == own).all():
            break
        own = now
        centre = unit(np.stack([x[own == j].mean(axis=0) if (own == j).any() else centre[j] for j in range(len(centre))]))
    return centre.astype(np.float32), np.argmax(x @ centre.T, axis=1)


@dataclass
class Centroids:
    langs: list[str]
    centre: np.ndarray
    limit: np.ndarray
    idf: np.ndarray

    def tell(self, texts: list[str | None]) -> pd.DataFrame:
        known = [t is not None and LETTER.search(t) is not None and len(self.langs) > 0 for t in texts]
        lang, score, far = ["und"] * len(texts), [0.0] * len(texts), [not k for k in known]
        at = [i for i, k in enumerate(known) if k]
        for begin in range(0, len(at), 128):
            some = at[begin:begin + 128]
            near = unit(np.stack([counts(texts[i]) for i in some]) * self.idf) @ self.centre.T
            best = np.argmax(near, axis=1)
            for i, j, s in zip(some, best.tolist(), near[np.arange(len(some)), best].tolist()):
                lang[i], score[i], far[i] = self.langs[j], min(1.0, max(0.0, s)), s < self.limit[j]
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": far})


def learning_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(F.col(lang_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))


def idf_of(rows: DataFrame) -> np.ndarray:
    """Inverse document frequency of each place over all learning rows; one row per place comes to the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(DIMS + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                seen[:DIMS] += counts(text or "") > 0
                n += 1
        seen[DIMS] = n
        yield pd.DataFrame({"place": np.arange(DIMS + 1), "n": seen})

    total = rows.select("text").mapInPandas(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    frequency = np.zeros(DIMS + 1)
    for row in total.collect():
        frequency[row["place"]] = row["n"]
    return np.log((1 + frequency[DIMS]) / (1 + frequency[:DIMS])).astype(np.float32) + np.float32(0.1)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          k: int = CENTROIDS) -> Centroids:
    """Fits centroids per language in parallel; they and their limits come to the driver, ``k`` rows a language."""
    python_ready(docs.sparkSession)
    rows = learning_rows(docs, id_col, text_col, lang_col)
    idf = idf_of(rows)
    order = F.xxhash64("id", F.lit("language"))
    window = Window.partitionBy("lang", "salt").orderBy("order", "id")
    picked = rows.select("id", "lang", order.alias("order"), F.pmod(order, F.lit(SALTS)).alias("salt")).where("id is not null").distinct()
    picked = picked.withColumn("n", F.row_number().over(window)).where(F.col("n") <= PER_SALT).select("id", "lang", "order")
    kind = docs.schema[id_col].dataType.simpleString()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["lang", "order"]].assign(x=[counts(t or "").tobytes() for t in batch["text"]])

    def centres(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", "x"])
        x = np.stack([np.frombuffer(v, dtype=np.float32) for v in frame["x"]])
        x = unit(x[x.any(axis=1)] * idf) if x.any() else x[:0]
        if not len(x):
            return pd.DataFrame({"lang": [], "x": [], "far": []})
        centre, own = clusters(x, k)
        near = (x * centre[own]).sum(axis=1)
        return pd.DataFrame([{"lang": frame["lang"].iloc[0], "x": centre[j].tobytes(), "far": float(np.quantile(near[own == j], FAR_QUANTILE))}
                             for j in range(len(centre)) if (own == j).any()])

    sample = rows.join(F.broadcast(picked.select("id", "lang", "order")), ["id", "lang"])  # bounded per language
    found = sample.select("lang", "order", "text").mapInPandas(vectors, "lang string, order long, x binary").groupBy("lang").applyInPandas(
        centres, "lang string, x binary, far double").collect()
    found = sorted(found, key=lambda r: (r["lang"], bytes(r["x"])))
    centre = np.stack([np.frombuffer(bytes(r["x"]), dtype=np.float32) for r in found]) if found else np.zeros((0, DIMS), dtype=np.float32)
    return Centroids([r["lang"] for r in found], centre, np.array([r["far"] for r in found]), idf)


def told(docs: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; columns of these names are replaced."""
    python_ready(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def tell(texts: pd.Series) -> pd.DataFrame:
        return model.tell([t if isinstance(t, str) else None for t in texts])

    made = fresh(docs, "told")
    rows = docs.withColumn(made, tell(F.col(text_col)))
    return rows.withColumns({name: F.col(made)[name] for name in ("lang_pred", "score", "rejected")}).drop(made)
