import random

import numpy as np
import xxhash

from palletrail.llm import simhash
from palletrail.llm.common import components
from tests.llm.data import documents, rows, simple, words


def fingerprint(text):
    parts = (text or "").encode().lower().split()
    runs = [b" ".join(parts[i:i + 4]) for i in range(len(parts) - 3)] or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(pairs, radius=4):
    fps = [fingerprint(t) for _, t in pairs]
    group = list(range(len(pairs)))
    for i in range(len(pairs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, (i, _) in zip(group, pairs):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(pairs, fps, group)), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_edges(spark):
    pairs = [(r[0], r[1]) for r in rows()]
    assert found(simhash.near_duplicates(documents(spark), tile_rows=4)) == brute(pairs)


def test_chains_of_near_texts_over_many_tiles(spark):
    draw, pairs, base = random.Random(3), [], words(7, 300).split()
    for i in range(60):
        base = list(base)
        base[draw.randrange(300)] = words(1000 + i, 1)
        pairs.append((i * 3 + 1, " ".join(base)))
    pairs += [(1000 + i, words(i, 60)) for i in range(60)]
    assert found(simhash.near_duplicates(simple(spark, pairs), tile_rows=8)) == brute(pairs)


def test_tiles_with_dense_groups():
    draw = np.random.default_rng(5)
    centre = draw.integers(0, 2 ** 63, 6, dtype=np.uint64)
    fps = np.unique(np.array([c ^ (np.uint64(1) << np.uint64(b)) for c in centre for b in range(40)], dtype=np.uint64))
    label = simhash.tile_groups(fps, 4)
    assert len(np.unique(label)) == 6
    links = simhash.cross_links(fps[:120], simhash.tile_groups(fps[:120], 4), fps[120:], simhash.tile_groups(fps[120:], 4), 4)
    assert len(links) <= 12


def test_empty_table(spark):
    assert found(simhash.near_duplicates(simple(spark, []))) == []
    assert simhash.keep_one(simple(spark, [])).count() == 0


def test_keep_one(spark):
    kept = simhash.keep_one(documents(spark), tile_rows=4)
    assert kept.columns == documents(spark).columns
    assert kept.count() == 11  # texts of id 12 make two groups
    assert {r["doc_id"] for r in kept.collect()} >= {1, 4, 9}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000 + i, 1000) for i in range(1, 300)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 401)) and all(got[1000 + i] == 1000 for i in range(1, 300))
