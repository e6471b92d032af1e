"""The filter audit against applying the filters to every document in every order."""

import re
from collections import defaultdict
from itertools import permutations

import pytest

from palletrail.llm import audit
from palletrail.llm.queries import ORACLE, QUERIES
from tests.llm.data import documents, rows, simple

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in zip("ABCDE", (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        re.search("[#$%&*|]", text), copy)) if bad}


def plain(docs, labels):
    """docs: (doc_id, text, lang); labels: doc_id -> (good, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = defaultdict(list)
    for i, t, lang in docs:
        least = first.get(t or "")
        copy = least is not None and (i is None or i > least)
        parts[lang or ""].append((fails(t or "", copy), *labels.get(i, (0, 0))))
    out = []
    for part, held in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left, gone = held, []
            for step, f in enumerate(order, 1):
                lost, left = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                shapley[f] += len(lost)
                out.append([part, "".join(order), step, len(left), len(lost), sum(f in d[0] for d in gone), sum(d[0] == {f} for d in held),
                            sum(d[1] for d in lost), sum(d[2] for d in lost), f])
                gone += lost
        for row in out:
            if row[0] == part:
                row[-1] = shapley[row[-1]]
    return sorted(map(tuple, out))


def got(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_lattice():
    edges = audit.lattice("ABCDE")
    assert len(edges) == 80 and all(ways == len(orders) == len(set(orders)) for *_, ways, orders in edges)
    for bit in (1 << i for i in range(5)):
        assert sum(ways for _, b, ways, _ in edges if b == bit) == 120
    with pytest.raises(ValueError):
        audit.order_steps(None, "ABCDEFGH")


def test_small_documents(spark):
    many = " ".join(f"word{i}" for i in range(250))
    texts = [many, many, many.upper(), "A b", "a & b", many + " %", ("same " * 300).strip(), many + " X", many.title(), ""]
    docs = [(i, t, ["en", None, "", "de"][i % 4]) for i, t in enumerate(texts * 2)]
    docs += [(None, many, "en"), (None, "only without id", "en"), (None, "only without id", "de"), (7, many + " X", "en"), (7, many + " X", "de")]
    frame = spark.createDataFrame([(*d, "z", "z") for d in docs], "doc_id long, text string, lang string, mask string, n string")
    label = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(0, 20, 1)] + [(4, 0, 1), (99, 1, 1)]
    labels = spark.createDataFrame(label + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    told = {}
    for i, q, t in label:
        told[i] = (max(q, told.get(i, (0, 0))[0]), max(t, told.get(i, (0, 0))[1]))
    assert got(audit.interaction_audit(frame, labels)) == plain(docs, told)


def test_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert got(audit.interaction_audit(documents(spark), labels)) == plain([(r[0], r[1], r[2]) for r in rows()], {})
    assert audit.interaction_audit(simple(spark, []), labels).count() == 0


def test_query_on_given_tables(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    labels = {r["doc_id"]: (int(r["quality"] == 1), int(r["toxic"] == 1)) for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert got(QUERIES["op12_filter_audit"](spark, path)) == plain(docs, labels)
    assert "shapley" in ORACLE["op12_filter_audit"]
