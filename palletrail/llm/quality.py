"""Document quality by Bradley-Terry ranking: logistic loss on feature differences of preference pairs.

Features are shares and rates over the whole text.  The pairs set a document marked 1 against
one marked 0; the fit uses at most ``SAMPLE_ROWS`` labelled documents outside the held-out
fifth, picked by hash of their ids, and ``PAIRS_PER_ROW`` partners each.  The cut is the
quantile of the sample's scores at its share of documents marked 0, and scores are moved so
that it lies at ``THRESHOLD``.

Nulls and edges: null and empty texts have all features zero; labels without id or mark are not
used; of contradicting labels of one id the lower mark counts; without any pair every score is 1/2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palletrail.llm.common import fresh, held_out, python_ready

SAMPLE_ROWS = 12_000
PAIRS_PER_ROW = 8
THRESHOLD = 0.3

FEATURES = ("log_words", "mean_word", "upper", "digit", "mark", "odd_mark", "bar", "stop", "lines", "unique",
            "repeat", "top_word", "repeated_line", "short", "long")


def _bytes_in(text: str) -> np.ndarray:
    table = np.zeros(256)
    table[list(text.encode())] = 1
    return table


UPPER = _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = _bytes_in("0123456789")
MARK = _bytes_in(",.;:?-'\"()")
ODD_MARK = _bytes_in("#$%&*!~^_=+<>\\{}[]@/")


def features(text: str | None) -> list[float]:
    text = text or ""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    count = np.bincount(raw, minlength=256)
    size = float(len(raw))
    length = np.fromiter(map(len, words), dtype=np.int64, count=n)
    kinds: dict[str, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    lines = [line for line in text.split("\n") if line]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [np.log1p(n), float(length.mean()), count @ UPPER / size, count @ DIGIT / size, count @ MARK / n,
            np.sqrt(count @ ODD_MARK / n), np.sqrt(count[ord("|")] / n), count[ord(".")] / n,
            len(lines) / n, len(kinds) / n ** 0.7, same / n, max(kinds.values()) / n,
            1 - len(set(lines)) / max(1, len(lines)), float((length <= 3).mean()), float((length >= 10).mean())]


@dataclass
class Ranking:
    """Weights on standardised features; ``cut`` is the quantile at which documents are rejected."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_pairs(x: np.ndarray, mark: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, ridge: float = 1e-3,
              rounds: int = 60, seed: int = 7) -> Ranking:
    """Newton steps on the pairwise logistic loss; the same rows in the same order give the same weights."""
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    good, bad = np.flatnonzero(mark == 1), np.flatnonzero(mark == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), np.log(THRESHOLD / (1 - THRESHOLD)))
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = np.clip((x - mean) / scale, -8, 8)
    random = np.random.default_rng(seed)
    b = np.concatenate((np.repeat(bad, pairs_per_row), random.choice(bad, size=len(good))))
    g = np.concatenate((random.choice(good, size=len(bad) * pairs_per_row), good))
    d = z[g] - z[b]
    w = np.zeros(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # chance that the pair is ranked wrongly
        gradient = -(d * p[:, None]).mean(axis=0) + ridge * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    ranked = np.sort(z @ w)
    at = min(max(len(bad), 1), len(ranked) - 1)
    return Ranking(mean, scale, w, float(ranked[at - 1] + ranked[at]) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, mark_col: str, rows: int) -> DataFrame:
    """(id, mark, text) of at most ``rows`` labelled ids outside the held-out fifth, picked by hash of the id."""
    marks = labels.where(F.col(id_col).isNotNull() & F.col(mark_col).isin(0, 1) & ~held_out(F.col(id_col)))
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.min(mark_col).cast("int").alias("mark"))
    known = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    picked = marks.join(known, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(picked), "id")  # at most ``rows`` narrow rows


def _measured(text_batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in text_batches:
        yield pd.DataFrame({"id": batch["id"], "mark": batch["mark"], "x": [features(t) for t in batch["text"]]})


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          mark_col: str = "quality", rows: int = SAMPLE_ROWS) -> Ranking:
    """Fits the ranking on the bounded sample; only its feature rows come to the driver."""
    python_ready(docs.sparkSession)
    sample = labelled_sample(docs, labels, id_col, text_col, mark_col, rows)
    kind = docs.schema[id_col].dataType.simpleString()
    measured = sample.select("id", "mark", "text").mapInPandas(_measured, f"id {kind}, mark int, x array<double>")
    frame = measured.groupBy("id").agg(F.min("mark").alias("mark"), F.min("x").alias("x")).toPandas().sort_values("id")
    x = np.array(frame["x"].tolist(), dtype=float).reshape(len(frame), len(FEATURES))
    return fit_pairs(x, frame["mark"].to_numpy())


def scored(docs: DataFrame, model: Ranking, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; a column of that name is replaced."""
    python_ready(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.array([features(t) for t in texts])))

    return docs.withColumn(name, score(F.col(text_col)))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches the cut."""
    model = learn(docs, labels, id_col, text_col)
    name = fresh(docs, "score")
    return scored(docs, model, text_col, name).where(F.col(name) >= THRESHOLD).select(docs.columns)
