import hashlib
import re

import pytest

from palletrail.llm import mixing
from tests.llm.data import documents, simple, words


def plain(rows, weights=(5, 2, 1), repeats=3):
    """(id, size, taken) by filling each source's stream up to its target."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    docs = [(i, s, size(t), hashlib.md5(f"mix:{'null' if i is None else i}".encode()).hexdigest()) for i, t, s in rows]
    sources = sorted({d[1] for d in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(d[2] for d in docs if d[1] == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    full: set = set()
    while True:
        left = sum(total.values()) - sum(repeats * total[s] for s in full)
        free = [s for s in sources if s not in full]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] >= repeats * total[s] and total[s]]
        if not over:
            break
        full.update(over)
    target |= {s: repeats * total[s] for s in full}
    out = []
    for s in sources:
        give, at = int(target[s] + 0.5), 0
        for i, _, n, mix in sorted((d for d in docs if d[1] == s), key=lambda d: (d[3], d[0] is not None, d[0] or 0, d[2])):
            out.append((i, n, 0 if not n else n * (give // total[s]) + max(0, min(at + n, give % total[s]) - at)))
            at += n
    return sorted(out, key=str), target


def test_edges(spark):
    docs = documents(spark)
    wanted, target = plain([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    got = mixing.mix(docs).collect()
    assert sorted(((r["doc_id"], r["size"], r["taken"]) for r in got), key=str) == wanted
    assert all(abs(r["target"] - target[r["source"]]) < 1e-6 for r in got)


@pytest.mark.parametrize("block", [7, 64])
def test_many_sources_and_small_blocks(spark, block):
    rows = [(i, words(i, i % 90), ["s%d" % (i % 7) if i % 3 else "hot"][0]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted, _ = plain(rows)
    got = mixing.mix(docs, block_words=block).collect()
    assert sorted(((r["doc_id"], r["size"], r["taken"]) for r in got), key=str) == wanted
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def test_schedule_is_even(spark):
    rows = [(i, words(i, 40), "abc"[i % 3]) for i in range(300)]
    sizes = mixing.sized(spark.createDataFrame(rows, "doc_id long, text string, source string"), "doc_id", "text", "source")
    quota = mixing.quotas(mixing.source_targets(sizes), 10)
    slots = sorted((r["slot"], r["source"], r["rank"]) for r in mixing.schedule(quota).collect())
    need = {r["source"]: r["slots"] for r in quota.collect()}
    assert {s: sum(x[1] == s for x in slots) for s in need} == need
    for source in need:  # ranks follow slots, and every stretch of the mix has about its share
        own = [(slot, rank) for slot, s, rank in slots if s == source]
        assert [rank for _, rank in own] == list(range(need[source]))
        share = need[source] / len(slots)
        assert all(abs(rank - slot * share) < 6 for slot, rank in own if slot < len(slots))


def test_plan_is_the_mix_in_order(spark):
    """Slots follow one another, hold a block of one source each, and add up to what is taken of every document."""
    rows = [(i, words(i, 5 + i % 60), ["a", "b", None][i % 3] if i % 2 else "a") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = [tuple(r) for r in mixing.mix_plan(docs, block_words=16).collect()]
    slots = [slot for slot, *_ in plan]
    assert slots == sorted(slots) and set(slots) == set(range(len(set(slots))))
    held, source_of, taken = {}, {}, {}
    for slot, source, block, doc_id, first, n in plan:
        assert source_of.setdefault(slot, (source, block)) == (source, block)
        held[slot] = held.get(slot, 0) + n
        taken[doc_id] = taken.get(doc_id, 0) + n
        assert 0 <= first and first + n <= 5 + doc_id % 60
    assert max(held.values()) == 16 and sum(n < 16 for n in held.values()) <= 2 * 3 * 3
    assert taken == {r["doc_id"]: r["taken"] for r in mixing.mix(docs, block_words=16).collect() if r["taken"]}
    total = {s: sum(n for slot, n in held.items() if source_of[slot][0] == s) for s in ("a", "b", None)}
    for s in total:  # every stretch of the mix has about its share of every source
        seen = 0
        for slot in sorted(held)[: int(len(held) * 0.9)]:
            seen += held[slot] * (source_of[slot][0] == s)
            assert abs(seen - total[s] * (slot + 1) / len(held)) < 8 * 16


def test_mixed_documents(spark):
    docs = documents(spark)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert got == {i: n for i, n in taken.items() if n}


def test_first_words(spark):
    frame = spark.createDataFrame([("a b  c\nd", 3), (" a b", 1), ("a", 1), ("a b ", 2), ("a\u0001b c d", 2), ("\u0001 x", 1)], "t string, n long")
    got = [r[0] for r in frame.select(mixing.first_words(frame["t"], frame["n"])).collect()]
    assert got == ["a b  c", " a", "a", "a b", "a\u0001b c", "\u0001"]


def test_empty_table(spark):
    assert mixing.mix(simple(spark, [])).count() == 0
    assert mixing.mix(simple(spark, [(1, None), (2, "")])).count() == 2
