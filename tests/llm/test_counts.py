"""Token counts against the library on whole texts."""

import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from palletrail.llm import counts
from palletrail.llm.queries import QUERIES
from tests.llm.data import documents, rows, simple

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = counts.tokenizer(PATH)
WHOLE = counts.whole_tokens(MODEL)


def library(texts):
    return [len(ids) for ids in MODEL.encode([t or "" for t in texts], num_threads=1)]


def test_proof():
    assert counts.splits_at_blanks(MODEL) and len(WHOLE) > 10_000
    strings = {MODEL.id_to_piece(i) for i in range(MODEL.vocab_size())}
    assert all(counts.BLANK + word in strings and len(MODEL.encode(word)) == 1 for word in WHOLE)


@settings(deadline=None, max_examples=400)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("  ab.\n\t▁é<s>")), st.characters(exclude_categories=["Cs"]))), max_size=8))
def test_any_text(texts):
    counter = counts.Counter(MODEL, WHOLE)
    assert counter.of_texts(pa.array(texts, pa.string())).tolist() == library(texts)


@settings(deadline=None, max_examples=100)
@given(st.text(alphabet=st.sampled_from(list("   ab▁the")), min_size=60, max_size=200))
def test_parts_of_long_texts(text):
    old, counts.BATCH_BYTES = counts.BATCH_BYTES, 16
    try:
        assert counts.Counter(MODEL, WHOLE).of_texts(pa.array([text, "", text])).tolist() == library([text, "", text])
    finally:
        counts.BATCH_BYTES = old


def test_small_cache_and_unsplittable(monkeypatch):
    texts = [r[1] for r in rows()] + ["some words that are not whole-tokens, somewhat repeated words"] * 3
    monkeypatch.setattr(counts, "CACHE_BYTES", 3000)
    counter = counts.Counter(MODEL, WHOLE)
    assert counter.of_texts(pa.array(texts)).tolist() == library(texts) and counter.held <= 3000
    assert counts.Counter(MODEL, None).of_texts(pa.array(texts)).tolist() == library(texts)


def test_documents(spark):
    texts = {r[1] for r in rows()}
    got = sorted((tuple(r) for r in counts.token_counts(documents(spark), PATH, limit=100).collect()), key=str)
    wanted = [(r[0], len((r[1] or "").encode()), n, n > 100) for r, n in zip(rows(), library([r[1] for r in rows()]))]
    assert got == sorted(wanted, key=str) and len(texts) > 10
    assert counts.token_counts(simple(spark, []), PATH).count() == 0


def test_query_on_given_tables(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    wanted = {r["doc_id"]: n for r, n in zip(docs, library([r["text"] for r in docs]))}
    assert {r["doc_id"]: r["n_tokens"] for r in QUERIES["op13_token_counts"](spark, path).collect()} == wanted
