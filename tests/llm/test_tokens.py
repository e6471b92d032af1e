import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from palletrail.llm import tokens
from tests.llm.data import documents, rows, simple

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(deadline=None, max_examples=150)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50000), st.integers(0, 2 ** 64 - 1), st.just(0)), max_size=400),
       st.sampled_from([8, 20, 60]))
def test_round_trip(ids, escape_bits):
    ids = np.array(ids, dtype=np.uint64)
    block = tokens.encode_block(ids, np.array([0], dtype=np.int64)[: len(ids)], escape_bits)
    assert (tokens.decode_block(block["words"], block["escape_at"], block["escape_id"]) == ids).all()


def test_runs_fill_words():
    ids = np.zeros(1000, dtype=np.uint64)
    assert len(tokens.encode_block(ids, np.array([0]))["words"]) == 8 * 6  # 4 * 240, then 30 and 10
    assert len(tokens.pack(np.full(8, 16000, dtype=np.uint64))[0]) == 2


def test_one_document_alone():
    draw = np.random.default_rng(1)
    docs = [draw.integers(0, 2 ** draw.integers(1, 30), draw.integers(1, 300)).astype(np.uint64) for _ in range(40)]
    size = np.array([len(d) for d in docs])
    block = tokens.encode_block(np.concatenate(docs), np.cumsum(size) - size, 16) | {"doc_tokens": size}
    for i, doc in enumerate(docs):
        assert (tokens.decode_document(block, i, len(doc)) == doc).all()


def plain(pairs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [50, 1 << 16])
def test_documents(spark, block_ids):
    pairs = [(r[0], r[1]) for r in rows()] + [(50, "It's don't,b.c. A,. É. <|endoftext|> x́.   y\x1cz, 12,3.")]
    docs = documents(spark).unionByName(simple(spark, pairs[-1:]))
    got = [tuple(r) for r in tokens.token_output(docs, PATH, block_ids=block_ids).collect()]
    assert sorted(got, key=str) == sorted(plain(pairs), key=str)


def test_empty_table(spark):
    assert tokens.token_output(simple(spark, []), PATH).count() == 0


TEXTS = ["a b c d e f g h.", "h, g f\ne d c b a", "Ab, cd. EF, ... x.., _. a_, b'. c's. it's, don't. '", "\u00b2, x\u00b2. 1,000. 3.5, n\u00ba. e\u0301. \u00e9.",
         "STRASSE \u1e9e \u0130x \u03a3\u03a3. \u00a0\u0085, \x1c, a\x1c. \t. \r\n, ", "<|startoftext|>x. <|x, \u4f60\u597d. \U0001f600, a\U0001f600.", ", . ,. .,", " ", ""]


@pytest.mark.parametrize("size, chars", [(3000, 40), (32 << 20, 1 << 20)])
def test_encoder(monkeypatch, size, chars):
    monkeypatch.setattr(tokens, "CACHE_BYTES", size)
    monkeypatch.setattr(tokens, "BATCH_CHARS", chars)
    encoder, tokenizer = tokens.Encoder(PATH), Tokenizer.from_file(PATH)
    for ids, text in zip(encoder.ids(TEXTS * 2), TEXTS * 2):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("aB1',. _\n\t-!\u00e9\u0301\u00a0\u00df\u03a3")), st.characters(max_codepoint=0x60f)), max_size=30))
def test_encoder_on_any_text(text):
    assert tokens.encoder(PATH).ids([text, None])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids


WHOLE = Tokenizer.from_file(PATH)
