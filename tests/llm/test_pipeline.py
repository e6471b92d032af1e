"""The stages one after another against what plain versions give on each stage's own input."""

import re

import numpy as np

import corpus_pipeline
from palletrail.llm import quality
from palletrail.llm.common import stored, table
from tests.llm.test_mixing import plain as mix_plain
from tests.llm.test_native import similar
from tests.llm.test_simhash import brute
from tests.llm.test_tokens import plain as token_plain

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF_DIR), name))
    assert all(frame.columns == columns for frame in seen[:-1])
    rows = [[r.asDict() for r in frame.collect()] for frame in seen]
    model = quality.learn(docs, table(spark, SF_DIR, "labels"))
    keep = {r["doc_id"] for r in rows[0] if model.scores(np.array([quality.features(r["text"])]))[0] >= 0.3}
    assert {r["doc_id"] for r in rows[1]} == keep and 0.6 < len(keep) / len(rows[0]) < 1
    groups = brute([(r["doc_id"], r["text"]) for r in rows[1]])
    assert sorted(r["doc_id"] for r in rows[2]) == sorted({c for *_, c in groups})
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    clean = [r["doc_id"] for r in rows[2] if not any(similar(r["text"], text) for _, text in items)]
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(clean) and len(clean) < len(rows[2])
    taken, _ = mix_plain([(r["doc_id"], r["text"], r["source"]) for r in rows[3]])
    got = {}
    for r in rows[4]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert got == {i: n for i, _, n in taken if n}
    wanted = token_plain([(r["doc_id"], r["text"]) for r in rows[4]])
    assert sorted(tuple(r.values()) for r in rows[5]) == sorted(wanted)
