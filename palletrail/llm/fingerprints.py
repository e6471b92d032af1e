"""Document fingerprints: an improbable-feature digest of chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy level; levels that fewer windows of all
documents have are more improbable and rank first.  A window that is the best of at least
``POPULAR`` of the runs of ``WINDOW`` neighbours it lies in becomes a feature; features go by
hash into Bloom filters of ``FILTER_BITS`` bits, a new one after ``PER_FILTER`` features.
Two digests are compared by the overlap of their bits beyond chance, filter by filter, each of
the shorter chain with its best partner.

Nulls and edges: null text is empty; a text of fewer bytes than a window is one feature, an
empty one has none; two digests without features are alike (1), one without and one with are not (0);
a null id sorts last; rows that repeat an id are neighbours, in order of their texts; a single
document is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palletrail.llm.common import python_ready

WINDOW = 64
LEVELS = 1001
LEAST_LEVEL = 100
POPULAR = 16
FILTER_BITS = 2048
PER_FILTER = 160
HASHES = 5
BUFFER = 1 << 18
UNUSED = 1 << 20
UNIT = 1_000_000
_F = np.array([c * np.log2(c) if c else 0.0 for c in range(WINDOW + 2)])
GAIN = np.round((_F[1:] - _F[:-1]) * UNIT).astype(np.int64)
# Odd multipliers from the golden ratio in 64 bits.
MIX = (np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def entropy_levels(x: np.ndarray) -> np.ndarray:
    """Entropy level 0..1000 of each window of ``x``, from counts that change by one byte at each end."""
    n = len(x)
    back, ahead = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    for d in range(1, WINDOW):
        same = (x[d:] == x[:-d]).view(np.uint8)
        back[d:] += same
        ahead[:-d] += same
    change = GAIN[back]
    change[WINDOW:] -= GAIN[ahead[:-WINDOW]]
    total = np.cumsum(change)[WINDOW - 1:]
    return np.clip(1000 - total * 1000 // (WINDOW * int(np.log2(WINDOW)) * UNIT), 0, 1000).astype(np.int64)


def buffers(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
    """Texts of at least a window laid one after another: bytes, index and start of each text."""
    held, index, start, size = [b"\0" * WINDOW], [], [], WINDOW
    for i, text in enumerate(texts):
        if len(text) >= WINDOW:
            held.append(text)
            index.append(i)
            start.append(size)
            size += len(text)
            if size > BUFFER:
                yield np.frombuffer(b"".join([*held, b"\0" * WINDOW]), dtype=np.uint8), index, start
                held, index, start, size = [b"\0" * WINDOW], [], [], WINDOW
    if index:
        yield np.frombuffer(b"".join([*held, b"\0" * WINDOW]), dtype=np.uint8), index, start


def valid_windows(n: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which windows lie within one text."""
    mark = np.zeros(n + 1, dtype=np.int8)
    mark[start] += 1
    np.add.at(mark, start + size - WINDOW + 1, -1)
    return np.cumsum(mark[:n]).astype(bool)


def level_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(LEVELS, dtype=np.int64)
    for x, index, start in buffers(texts):
        levels = entropy_levels(x)
        size = np.array([len(texts[i]) for i in index])
        counts += np.bincount(levels[valid_windows(len(levels), np.array(start), size)], minlength=LEVELS)
    return counts


def precedence(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the most improbable first; low levels and those never seen are not used for features."""
    order = np.lexsort((np.arange(LEVELS), counts))
    rank = np.empty(LEVELS, dtype=np.int64)
    rank[order] = np.arange(LEVELS)
    rank[:LEAST_LEVEL] = UNUSED
    return rank


def feature_hashes(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Distinct feature hashes of each text, in order of place."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * len(texts)
    for i, text in enumerate(texts):
        if 0 < len(text) < WINDOW:
            out[i] = np.frombuffer(hashlib.sha256(text).digest()[:8], dtype="<u8").astype(np.uint64)
    for x, index, start in buffers(texts):
        levels = entropy_levels(x)
        n, start, size = len(levels), np.array(start), np.array([len(texts[i]) for i in index])
        ranks = np.where(valid_windows(n, start, size), rank[levels], UNUSED)
        best = (ranks << 32) | np.arange(n)
        step = 1
        while step < WINDOW:  # smallest of 2, 4, ... neighbours; of equals the first
            best[:-step] = np.minimum(best[:-step], best[step:])
            step *= 2
        votes = np.bincount(best & 0xFFFFFFFF, minlength=n)
        chosen = np.flatnonzero((votes >= POPULAR) & (ranks < UNUSED))
        words = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[chosen].copy().view("<u8").astype(np.uint64)
        h = ((words ^ (words >> np.uint64(29))) * MIX).sum(axis=1, dtype=np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        cut = np.searchsorted(chosen, np.append(start, len(x)))
        for k, i in enumerate(index):
            own = h[cut[k]:cut[k + 1]]
            _, first = np.unique(own, return_index=True)
            out[i] = own[np.sort(first)]
    return out


def digest(hashes: np.ndarray) -> np.ndarray:
    """Chained filters (n, FILTER_BITS / 64) of the hashes; no filter without hashes."""
    n = -(-len(hashes) // PER_FILTER)
    bits = np.zeros((n, FILTER_BITS), dtype=np.uint8)
    place = np.arange(len(hashes)) // PER_FILTER
    width = FILTER_BITS.bit_length() - 1
    for k in range(HASHES):
        bits[place, ((hashes >> np.uint64(k * width)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Overlap of bits between chance (0) and the smaller filter (1), averaged over the shorter chain."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    best = np.zeros(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(axis=1, dtype=np.int64)
        chance, most = ones_a[i] * ones_b / FILTER_BITS, np.minimum(ones_a[i], ones_b)
        best[i] = np.max(np.where(most > chance, (common - chance) / np.maximum(most - chance, 1e-9), common == most))
    return float(np.clip(best.mean(), 0.0, 1.0))


def raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of each entropy level by the number of windows of all documents that have it."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(LEVELS, dtype=np.int64)
        for batch in batches:
            counts += level_counts([raw(t) for t in batch["text"]])
        yield pd.DataFrame({"level": np.arange(LEVELS), "n": counts})

    levels = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "level long, n long")
    counts = np.zeros(LEVELS, dtype=np.int64)
    for row in levels.groupBy("level").agg(F.sum("n").alias("n")).collect():  # one row per level
        counts[row["level"]] = row["n"]
    return precedence(counts)


def with_digest(docs: DataFrame, ranks: np.ndarray, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of each whole text as base64 text; a column of that name is replaced."""
    python_ready(docs.sparkSession)

    @F.pandas_udf("string")
    def printed(texts: pd.Series) -> pd.Series:
        return pd.Series([as_text(digest(h)) for h in feature_hashes([raw(t) for t in texts], ranks)], dtype=object)

    return docs.withColumn(name, printed(F.col(text_col)))


def as_text(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def in_parts(docs: DataFrame, parts: int) -> DataFrame:
    """(part, guest, id, text): documents in ranges of ids, each with the first document of the next lower range as guest.

    The lowest range has that of the highest.  Only the borders come to the driver, at most one per part.
    """
    ids = docs.select("id")
    border = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    border = np.unique(np.array(border if border is not None else [], dtype=float))

    @F.pandas_udf("int")
    def part_of(values: pd.Series) -> pd.Series:
        places = np.searchsorted(border, values.fillna(-np.inf).to_numpy(dtype=float), side="right")
        return pd.Series(places.astype(np.int32))

    dealt = docs.withColumn("part", part_of(F.col("id").cast("double")))
    tops = sorted((r["part"], r["top"]) for r in ids.withColumn("part", part_of(F.col("id").cast("double")))
                  .groupBy("part").agg(F.max("id").alias("top")).collect())
    order = [part for part, _ in tops]
    guests = [(top, order[(i + 1) % len(order)]) for i, (_, top) in enumerate(tops)]
    if not guests:
        return dealt.select("part", F.lit(0).alias("guest"), "id", "text")
    kind = docs.schema["id"].dataType.simpleString()
    small = F.broadcast(docs.sparkSession.createDataFrame(guests, f"top {kind}, host int"))  # at most ``parts`` rows
    joined = dealt.join(small, dealt["id"].eqNullSafe(small["top"]), "left")
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("host").alias("part"), F.lit(1).alias("guest"))
    return joined.select("id", "text", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, visit))).alias("p")
                         ).select("p.part", "p.guest", "id", "text")


def neighbour_report(docs: DataFrame, ranks: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text",
                     parts: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each document.

    The edited text has the last third of the code points replaced by the first of the next
    document, by descending id.  Ranges of ids are streamed in that order: each text is shuffled once.
    """
    spark = docs.sparkSession
    python_ready(spark)
    ranks = entropy_ranks(docs, text_col) if ranks is None else ranks
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def finished(rows: list[tuple], following: list[str]) -> pd.DataFrame:
        edited = []
        for (_, text), after in zip(rows, following):
            tail = len(text) // 3
            edited.append(text[: len(text) - tail] + after[:tail])
        whole = [raw(text) for _, text in rows]
        changed, then = [raw(text) for text in edited], [raw(following[-1])]
        chains = [digest(h) for h in feature_hashes([*whole, *changed, *then], ranks)]
        n = len(rows)
        own, other, after = chains[:n], chains[n:2 * n], [*chains[1:n], chains[-1]]
        return pd.DataFrame({
            "id": [doc_id for doc_id, _ in rows], "n_chars": [len(text) for _, text in rows],
            "edited_sha256": [hashlib.sha256(text).hexdigest() for text in changed],
            "fingerprint": [as_text(c) for c in own], "edited_fingerprint": [as_text(c) for c in other],
            "near_edited": [likeness(a, b) for a, b in zip(own, other)],
            "near_next": [likeness(a, b) for a, b in zip(own, after)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, open_rows, done = None, [], False
        for batch in batches:
            ids = batch["id"].astype(object).where(batch["id"].notna(), None)
            for at, guest, doc_id, text in zip(batch["part"], batch["guest"], ids, batch["text"]):
                text = text or ""
                if at != part:
                    part, open_rows, done = at, [], False
                if guest:
                    if not done and open_rows:  # the part ends with the first row of the next one
                        yield finished(open_rows, [t for _, t in open_rows[1:]] + [text])
                    open_rows, done = [], True
                    continue
                open_rows.append((doc_id, text))
                if len(open_rows) > 256:
                    yield finished(open_rows[:-1], [t for _, t in open_rows[1:]])
                    open_rows = open_rows[-1:]

    dealt = in_parts(narrow, parts).repartition(F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "guest", F.col("id").desc_nulls_last(), "text")
    return ordered.mapInPandas(run, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                               "edited_fingerprint string, near_edited double, near_next double").withColumnRenamed("id", id_col)
