"""Token counts of whole texts by a whole-token shortcut.

A pre-token is a run of blanks with what follows up to the next blank.  If no string of the
vocabulary holds a blank after another character, no token reaches from one pre-token into the next, so a text's
count is the sum over its pre-tokens.  Which strings of the vocabulary encode alone as one token is proved
once, by encoding each of them, before any text is read; a pre-token among these counts one without
being encoded.  Only the others are merged by the tokenizer, each distinct one once while it
stays in a cache of bounded bytes.

Nulls and edges: null text is empty and has no tokens; texts of any length are counted whole, in parts cut before
blanks; repeated rows and ids are counted each; an empty table gives no rows; a tokenizer for which texts cannot be split at blanks
counts whole texts itself; columns that are not asked for are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palletrail.llm.common import python_ready

BLANK = "▁"  # how the vocabulary writes a blank
BATCH_BYTES = 1 << 20
CACHE_BYTES = 32 << 20  # of each of two generations
ENTRY_BYTES = 150  # of a cached pre-token besides its text
RUN_START = re.compile("(?<=[^ ]) ")


def tokenizer(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def splits_at_blanks(model) -> bool:
    """Whether no token reaches from a character to a blank after it, and blanks are neither dropped nor moved."""
    reaching = re.compile(f"[^{BLANK}]{BLANK}")
    strings = (model.id_to_piece(i) for i in range(model.vocab_size()))
    return not any(reaching.search(s) for s in strings) and model.normalize("  a  b ") == "   a  b ".replace(" ", BLANK)


def whole_tokens(model) -> set[str]:
    """What follows the blank in the strings of the vocabulary that encode alone as one token: proved by encoding each."""
    strings = [model.id_to_piece(i) for i in range(model.vocab_size())]
    words = [(s[1:], i) for i, s in enumerate(strings) if s.startswith(BLANK) and len(s) > 1]
    return {word for (word, i), ids in zip(words, model.encode([w for w, _ in words], num_threads=1)) if ids == [i]}


def pre_split(text: str) -> str:
    """The text with single blanks between its pre-tokens; further blanks of a run are written ``BLANK``."""
    text = text.replace(BLANK, " ")
    text = re.sub("^ +", lambda run: BLANK * len(run[0]), text)
    return re.sub(" ( +)", lambda run: " " + BLANK * len(run[1]), text)


def parts_of(text: str, limit: int) -> list[str]:
    """A text in parts of about ``limit`` characters; the blank a part would begin with is left out, as every text gets one in front."""
    text, parts, at = text.replace(BLANK, " "), [], 0
    while found := RUN_START.search(text, at + limit):
        parts.append(text[at:found.start()])
        at = found.end()
    return [*parts, text[at:]]


class Counter:
    """Token counts of texts by one tokenizer."""

    def __init__(self, model, whole: set[str] | None):
        self.model, self.whole = model, whole
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.held = 0

    def of_pieces(self, pieces: list[str]) -> list[int]:
        """Counts of distinct pre-tokens, each without its first blank."""
        counts = [1 if piece in self.whole else self.young.get(piece) or self.old.get(piece) for piece in pieces]
        rest = [number for number, count in enumerate(counts) if count is None]
        for number, ids in zip(rest, self.model.encode([pieces[number] for number in rest], num_threads=1)):
            piece, counts[number] = pieces[number], len(ids) or 1  # nothing after the blank: the blank itself
            cost = ENTRY_BYTES + 4 * len(piece)
            if self.held + cost > CACHE_BYTES:
                self.old, self.young, self.held = self.young, {}, 0
            if cost <= CACHE_BYTES // 8:
                self.young[piece] = counts[number]
                self.held += cost
        return counts

    def of_parts(self, texts: pa.Array) -> np.ndarray:
        """Counts of a few texts or parts, taken as not empty."""
        odd = pc.or_(pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "  ")), pc.match_substring(texts, BLANK))
        if pc.any(odd).as_py():
            texts = pc.replace_with_mask(texts, odd, pa.array([pre_split(t) for t in texts.filter(odd).to_pylist()], texts.type))
        lists = pc.split_pattern(texts, " ")
        pieces = lists.flatten().dictionary_encode()
        counts = np.array(self.of_pieces(pieces.dictionary.to_pylist()), dtype=np.int64)
        return np.add.reduceat(counts[pieces.indices.to_numpy()], lists.offsets.to_numpy()[:-1])

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        """Counts of whole texts; about ``BATCH_BYTES`` of them are in work at a time."""
        texts = texts.fill_null("").cast(pa.large_string())
        if self.whole is None:
            return np.array([len(self.model.encode(t)) for t in texts.to_pylist()], dtype=np.int64)
        size = pc.binary_length(texts).to_numpy()
        out, at = np.zeros(len(texts), dtype=np.int64), 0
        upto = np.cumsum(size)
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH_BYTES, side="right")))
            some = texts.slice(at, end - at)
            if size[at] > BATCH_BYTES:
                out[at] = sum(int(self.of_parts(pa.array([part], texts.type))[0]) for part in parts_of(some[0].as_py(), BATCH_BYTES))
            else:
                out[at:end] = self.of_parts(some)
            at = end
        out[size == 0] = 0
        return out


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row by the SentencePiece model at ``path``, which all executors have.

    The proved strings, at most as many as the vocabulary has, are sent to the executors once.
    """
    spark = docs.sparkSession
    python_ready(spark)
    model = tokenizer(path)
    proved = spark.sparkContext.broadcast(whole_tokens(model) if splits_at_blanks(model) else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(tokenizer(path), proved.value)
        for batch in batches:
            counts = pa.array(_COUNTERS[path].of_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), counts], ["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
