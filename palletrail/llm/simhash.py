"""SimHash near-duplicates: exact comparison of fingerprint tiles by exclusive-or and bit counts.

Distinct fingerprints are put in order of the bit counts of their halves and quarters and cut into tiles.  A pair of
tiles is compared only if the bit counts of their boxes come within the radius, which two
fingerprints within the radius always do.  A tile first settles its own groups, so that a pair
of tiles reports at most a spanning forest of their groups and never all linked pairs.

Nulls and edges: null text counts as empty; texts without a word have fingerprint zero and are
linked like any other; equal texts, repeated rows and repeated ids share their fingerprint and group.
A row without id takes part; a group without any id has a null ``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palletrail.llm.common import components, fresh, join_facts, python_ready, stored

SEED = 42
LANE = np.uint64(0x0000000100000001)
STRIP = 256


def shingle_hashes(text: str | None, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words, or of the whole sequence if there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), SEED)]
    whole = b" ".join(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    return [digest(whole[a:b], SEED) for a, b in zip(start[: 1 - size].tolist(), end[size - 1:].tolist())]


def fingerprints_of(hashes: list[list[int]]) -> np.ndarray:
    """One 64-bit majority fingerprint per list of hashes; zero for an empty list."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    sizes = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.concatenate([np.array(h, dtype=np.uint64) for h in hashes if h])
    first = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
    half = sizes[full]
    result = np.zeros(len(full), dtype=np.uint64)
    for bit in range(32):  # two 32-bit counters in each sum
        both = np.add.reduceat((flat >> np.uint64(bit)) & LANE, first)
        low, high = (both & np.uint64(0xFFFFFFFF)).astype(np.int64), (both >> np.uint64(32)).astype(np.int64)
        result |= (2 * low > half).astype(np.uint64) << np.uint64(bit)
        result |= (2 * high > half).astype(np.uint64) << np.uint64(bit + 32)
    out[full] = result
    return out


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """(id, text_hash, fp): the 64-bit fingerprint of each whole text, as a signed long."""
    chunk_chars = 4_000_000
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps, held, chars = [], [], 0
            for text in batch["text"]:
                held.append(shingle_hashes(text, size))
                chars += len(text or "")
                if chars > chunk_chars:
                    fps.append(fingerprints_of(held))
                    held, chars = [], 0
            fps.append(fingerprints_of(held))
            yield batch[["id", "text_hash"]].assign(fp=np.concatenate(fps).view(np.int64))

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(run, f"id {kind}, text_hash long, fp long")


def bit_counts(fp) -> list:
    """Bit counts of the two halves and of each half's upper quarter: no two of them move by more than the distance."""
    part = lambda shift, mask: F.bit_count(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(mask)))
    return [part(32, 0xFFFFFFFF), part(0, 0xFFFFFFFF), part(48, 0xFFFF), part(16, 0xFFFF)]


def near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= radius


def tile_groups(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the index of the first one in its group within the tile."""
    label = np.arange(len(fps))
    for at in range(0, len(fps), STRIP):
        close = near(fps[at:at + STRIP], fps, radius)
        for row in np.flatnonzero(close.sum(axis=1) > 1):
            found = np.unique(label[np.flatnonzero(close[row])])
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    return label


def cross_links(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the groups of two tiles, as index pairs."""
    keys: set[int] = set()
    for at in range(0, len(a), STRIP):
        i, j = np.nonzero(near(a[at:at + STRIP], b, radius))
        if len(i):
            keys.update(np.unique((ga[at + i].astype(np.int64) << 32) | gb[j]).tolist())
    parent: dict[tuple[int, int], tuple[int, int]] = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    forest = []
    for key in sorted(keys):
        i, j = key >> 32, key & 0xFFFFFFFF
        x, y = root((0, i)), root((1, j))
        if x != y:
            parent[y] = x
            forest.append((i, j))
    return forest


def _cut(tile_rows: int, radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, rest = TaskContext.get().partitionId(), 0, None

        def tile(frame: pd.DataFrame) -> dict:
            nonlocal number
            fps = frame["fp"].to_numpy().astype(np.int64)
            group = tile_groups(fps.view(np.uint64), radius)
            bounds = frame[["c0", "c1", "c2", "c3"]].to_numpy()
            number += 1
            return {"tile": (part << 32) | number, "fps": fps.tobytes(), "groups": group.astype(np.uint16).tobytes(),
                    "lo": bounds.min(axis=0).tolist(), "hi": bounds.max(axis=0).tolist()}

        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch])
            rows = []
            while len(rest) >= tile_rows:
                rows.append(tile(rest.iloc[:tile_rows]))
                rest = rest.iloc[tile_rows:]
            if rows:
                yield pd.DataFrame(rows)
        if rest is not None and len(rest):
            yield pd.DataFrame([tile(rest)])

    return run


def _inner(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for fps, groups in zip(batch["fps"], batch["groups"]):
            fps, groups = np.frombuffer(fps, dtype=np.int64), np.frombuffer(groups, dtype=np.uint16)
            own = groups != np.arange(len(groups))
            yield pd.DataFrame({"a": fps[own], "b": fps[groups[own]]})


def _outer(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fa, ga, fb, gb in zip(batch["fa"], batch["ga"], batch["fb"], batch["gb"]):
                a, b = np.frombuffer(fa, dtype=np.int64), np.frombuffer(fb, dtype=np.int64)
                links = cross_links(a.view(np.uint64), np.frombuffer(ga, dtype=np.uint16),
                                    b.view(np.uint64), np.frombuffer(gb, dtype=np.uint16), radius)
                if links:
                    i, j = np.array(links).T
                    yield pd.DataFrame({"a": a[i], "b": b[j]})

    return run


def tiles(fps: DataFrame, radius: int = 4, tile_rows: int = 4096) -> DataFrame:
    """Tiles of distinct ``fp``: sorted fingerprints, their groups within the tile, and the box of bit counts."""
    if tile_rows > 65536:
        raise ValueError("groups are stored in 16 bits")
    counted = fps.select("fp", *[c.cast("int").alias(f"c{i}") for i, c in enumerate(bit_counts(F.col("fp")))])
    order = ["c0", "c1", "c2", "c3", "fp"]
    return counted.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _cut(tile_rows, radius), "tile long, fps binary, groups binary, lo array<int>, hi array<int>")


def tile_pairs(boxes: DataFrame, radius: int) -> DataFrame:
    """(ta, tb): pairs of tiles whose boxes of bit counts come within the radius.

    An interval join on the bit counts of the halves: a box is listed under its own counts, its
    partner under its counts widened by the radius, and a pair is kept at the first common cell.
    """
    span = lambda i, more: F.explode(F.sequence(F.col("lo")[i] - more, F.col("hi")[i] + more))
    cells = lambda more: boxes.select("*", span(0, more).alias("x")).select("*", span(1, more).alias("y"))
    a, b = cells(0).alias("a"), cells(radius).alias("b")
    box = lambda i: F.greatest(F.lit(0), F.col("a.lo")[i] - F.col("b.hi")[i], F.col("b.lo")[i] - F.col("a.hi")[i])
    first = (F.col("a.x") == F.greatest(F.col("a.lo")[0], F.col("b.lo")[0] - radius)) & (
        F.col("a.y") == F.greatest(F.col("a.lo")[1], F.col("b.lo")[1] - radius))
    joined = a.join(b, (F.col("a.x") == F.col("b.x")) & (F.col("a.y") == F.col("b.y")) & (F.col("a.tile") < F.col("b.tile")))
    return joined.where(first & (box(0) + box(1) <= radius) & (box(2) + box(3) <= radius)).select(
        F.col("a.tile").alias("ta"), F.col("b.tile").alias("tb"))


def near_groups(fps: DataFrame, radius: int = 4, tile_rows: int = 4096) -> DataFrame:
    """(fp, root): the group of each distinct ``fp`` that is linked to another one; exact for every size of group."""
    cut = stored(tiles(fps.select("fp").distinct(), radius, tile_rows), "tiles")
    pairs = tile_pairs(cut.select("tile", "lo", "hi"), radius)
    side = lambda n: cut.select(F.col("tile").alias(f"t{n}"), F.col("fps").alias(f"f{n}"), F.col("groups").alias(f"g{n}"))
    # Pairs are dealt to a stated number of tasks: by their bytes they would be put together, but each is as much work as megabytes of rows.
    dealt = lambda frame, key: frame.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    met = dealt(pairs, "ta").join(dealt(side("a"), "ta"), "ta")
    met = dealt(met, "tb").join(dealt(side("b"), "tb"), "tb").select("fa", "ga", "fb", "gb")
    links = cut.select("fps", "groups").mapInPandas(_inner, "a long, b long").union(
        met.mapInPandas(_outer(radius), "a long, b long"))
    found = components(links).select(F.col("node").alias("fp"), "root")
    return found.union(found.select("root", "root").distinct())


def grouped(docs: DataFrame, id_col: str, text_col: str, size: int, radius: int, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of each row (id, text_hash, fp), and of each distinct fingerprint (fp, n, best, root).

    ``best`` names its row of the smallest id (null last), then text hash; ``root`` is null without links.
    """
    fps = stored(with_fingerprint(docs, id_col, text_col, size), "fingerprints")
    least = F.min(F.struct(F.col("id").isNull().alias("_0"), F.col("id").alias("_1"), F.col("text_hash").alias("_2")))
    distinct = stored(fps.groupBy("fp").agg(F.count("*").alias("n"), least.alias("best")), "distinct")
    return fps, stored(distinct.join(near_groups(distinct, radius, tile_rows), "fp", "left"), "groups")


def best_of_groups(distinct: DataFrame) -> DataFrame:
    """(root, n, best): per linked group the number of fingerprints and the best row of all."""
    return distinct.where("root is not null").groupBy("root").agg(F.count("*").alias("n"), F.min("best").alias("best"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
                    radius: int = 4, tile_rows: int = 4096) -> DataFrame:
    """(id, fingerprint, component_id) for each row; ``component_id`` is the smallest id that links reach.

    Groups are settled over distinct fingerprints; rows then meet their fingerprint.
    """
    fps, distinct = grouped(docs, id_col, text_col, size, radius, tile_rows)
    groups = stored(best_of_groups(distinct), "best")
    linked = join_facts(distinct.where("root is not null").select("root", "fp", F.col("n").alias("rows")), groups, "root")
    named = linked.select("fp", F.col("rows").alias("n"), F.col("best._1").alias("component_id")).union(
        distinct.where("root is null").select("fp", "n", "best._1"))
    return join_facts(fps.select("id", "fp"), stored(named, "named"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
             radius: int = 4, tile_rows: int = 4096) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id (null last), then the smallest text hash.

    Rows that agree in id and text count as one.
    """
    _, distinct = grouped(docs, id_col, text_col, size, radius, tile_rows)
    best = best_of_groups(distinct).select("best.*").union(distinct.where("root is null").select("best.*"))
    key = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("null"))
    id_key, text_key = fresh(docs, "id_key"), fresh(docs, "text_key")
    best = best.select(key("_1").alias(id_key), F.col("_2").alias(text_key)).distinct()
    keyed = docs.withColumns({id_key: key(id_col), text_key: F.xxhash64(text_col)})
    kept = keyed.join(best, [id_key, text_key], "left_semi").dropDuplicates([id_key, text_key])
    return kept.select(docs.columns)
