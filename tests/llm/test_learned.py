"""Fingerprints, quality and language: brute force, plain versions and held-out accuracy."""

import hashlib
import zlib

import numpy as np
import pytest

from palletrail.llm import fingerprints, language, quality
from palletrail.llm.common import table
from tests.llm.data import documents, rows, simple, words

SF_DIR = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def levels(x):
    out = []
    for i in range(len(x) - 63):
        _, c = np.unique(np.frombuffer(x[i:i + 64], dtype=np.uint8), return_counts=True)
        out.append(1000 * (6 - (c * np.log2(c)).sum() / 64) / 6)
    return np.array(out)


def test_entropy_levels():
    for text in (words(3, 60).encode(), b"a" * 200, bytes(range(256))):
        assert np.abs(fingerprints.entropy_levels(np.frombuffer(text, dtype=np.uint8)) - levels(text)).max() <= 1.01


def test_features_by_votes():
    """Votes of every run of 64 neighbouring windows, text by text, as a plain loop counts them."""
    texts = [words(i, 30 + 20 * i).encode() for i in range(5)] + [b"short", b"", b"z" * 64]
    rank = fingerprints.precedence(fingerprints.level_counts(texts))
    got = fingerprints.feature_hashes(texts, rank)
    for text, hashes in zip(texts, got):
        alone = fingerprints.feature_hashes([text], rank)[0]
        assert hashes.tolist() == alone.tolist()
        if len(text) >= 64:
            r = [int(rank[v]) for v in fingerprints.entropy_levels(np.frombuffer(text, dtype=np.uint8))]
            votes = [0] * len(r)
            for at in range(-63, len(r)):
                run = range(max(0, at), min(len(r), at + 64))
                votes[min(run, key=lambda i: (r[i], i))] += 1
            chosen = [text[i:i + 64] for i in range(len(r)) if votes[i] >= fingerprints.POPULAR and r[i] < fingerprints.UNUSED]
            assert len(set(chosen)) == len(hashes)


def test_neighbour_report(spark):
    docs = documents(spark)
    got = fingerprints.neighbour_report(docs, parts=5).collect()
    order = sorted(((r[0], r[1] or "") for r in rows()), key=lambda p: (p[0] is None, -(p[0] or 0), p[1]))
    wanted = []
    for k, (i, text) in enumerate(order):
        after, tail = order[(k + 1) % len(order)][1], len(text) // 3
        wanted.append((i, len(text), hashlib.sha256((text[:len(text) - tail] + after[:tail]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(wanted, key=str)
    by_text = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_text[1] == by_text[3] and by_text[1] != by_text[9]
    assert fingerprints.neighbour_report(simple(spark, [])).count() == 0
    assert fingerprints.neighbour_report(simple(spark, [(1, "abc" * 50)])).first()["near_next"] == 1.0


def test_likeness_tells_edited_from_other(spark):
    got = fingerprints.neighbour_report(table(spark, SF_DIR, "documents")).where("n_chars > 600").toPandas()
    assert got["near_edited"].median() > 0.45 and got["near_next"].median() < 0.1
    assert (got["near_edited"] > got["near_next"]).mean() > 0.97


@pytest.fixture(scope="module")
def scores(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    model = quality.learn(docs, labels)
    return model, quality.scored(docs, model).join(labels, "doc_id").toPandas()


def test_quality_held_out(scores):
    _, frame = scores
    out = frame[[held(i) for i in frame["doc_id"]]]
    assert ((out["score"] >= 0.3) == (out["quality"] == 1)).mean() > 0.95


def test_quality_learns_from_the_other_folds_only(spark, scores):
    model, _ = scores
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels").toPandas()
    labels.loc[[held(i) for i in labels["doc_id"]], "quality"] = 0
    again = quality.learn(docs, spark.createDataFrame(labels))
    assert np.allclose(again.weights, model.weights) and np.isclose(again.cut, model.cut)


def test_pairs_rank_right():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, 15))
    true = x[:, 0] - 2 * x[:, 3]
    mark = (true > np.quantile(true, 0.2)).astype(int)
    model = quality.fit_pairs(x, mark)
    assert ((model.scores(x) >= quality.THRESHOLD) == (mark == 1)).mean() > 0.97


def test_quality_edges(spark):
    docs = documents(spark)
    none = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, quality int")
    out = quality.scored(docs, quality.learn(docs, none), name="score")
    assert out.count() == docs.count() and all(r["score"] == 0.5 for r in out.collect())
    assert quality.accepted(docs, none).columns == docs.columns
    some = spark.createDataFrame([(i, i % 2, "x") for i in (1, 2, 3, 9, 10, 12, 14, 14)], "doc_id long, quality int, mark string")
    assert all(0 <= r["score"] <= 1 for r in quality.scored(docs, quality.learn(docs, some), name="score").collect())
    assert quality.scored(simple(spark, []), quality.fit_pairs(np.zeros((0, 15)), np.zeros(0))).count() == 0


def test_language_held_out(spark):
    docs = table(spark, SF_DIR, "documents")
    out = language.told(docs, language.learn(docs)).select("doc_id", "lang", "lang_pred", "rejected").toPandas()
    out = out[[held(i) for i in out["doc_id"]]]
    assert (out["lang"] == out["lang_pred"]).mean() > 0.98 and out["rejected"].mean() < 0.1


def test_language_edges(spark):
    docs = documents(spark)
    out = language.told(docs, language.learn(docs)).collect()
    by_id = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (4, 5, 6))
    assert by_id[9]["lang_pred"] in ("en", "de")
    assert [r["lang_pred"] for r in language.told(docs, language.learn(simple(spark, []))).collect()] == ["und"] * len(out)


def test_far_texts_are_rejected(spark):
    docs = table(spark, SF_DIR, "documents")
    model = language.learn(docs)
    assert model.tell(["\u4f60\u597d\u4e16\u754c" * 30, "1234"])["rejected"].all()
