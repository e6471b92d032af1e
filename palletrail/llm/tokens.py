"""Token ids in word-aligned blocks: Simple-8b words with escapes and offsets per block.

A block is one row: ``words`` holds little-endian 64-bit words whose top four bits select how
many ids of how many bits the other sixty hold; ``doc_word`` and ``doc_skip`` say in which word
and at which place of it each document begins, so that one document can be read alone; ids of
``ESCAPE_BITS`` bits and more are zero in the words and listed with their places.
The file is the table of blocks that Spark writes, in order of ids; a document is never split.

Nulls and edges: null text is empty and has the end id only; a null id sorts first; repeated ids
are put in order of their texts, and repeated rows are all written; an empty table has no blocks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palletrail.llm.common import python_ready, shared_path

# Simple-8b's ids per word and bits per id, by selector.
SELECTORS = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE_BITS = 60
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
CACHE_BYTES = 64 << 20  # of each of the two generations of coded pieces
BATCH_CHARS = 4 << 20  # of the texts coded in one go; a longer text is coded alone
ENTRY_BYTES = 250  # of a dictionary entry besides its two strings
# Fixed value: the pattern by which the tokenizer splits lower-cased text.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")
# Special tokens; letters whose lower case is not one fixed letter; scripts whose classes change with the Unicode version.
ODD = re.compile("[\u0130\u03a3]|[^\\x00-\u052f]")
GLUED = re.compile(r"[^\w\s][,.]\s|_[,.]\s")
SKETCH = bytes(ord(" ") if c in b" \n" else ord(",") if c in b",." else ord("a") if chr(c).isalnum() else ord("#") for c in range(256))
COUNTS = np.array([count for count, _ in SELECTORS], dtype=np.int64)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of ids below 2**60, and the place of each word's first id."""
    n = len(ids)
    choice = np.full(n, len(SELECTORS) - 1, dtype=np.uint8)
    for number in range(len(SELECTORS) - 2, -1, -1):  # the selector that takes most ids is set last
        count, bits = SELECTORS[number]
        wide = ids >> np.uint64(bits) != 0
        if count > n or n - int(np.count_nonzero(wide)) < count:
            continue
        bad = np.concatenate(([0], np.cumsum(wide)))
        choice[: n - count + 1][bad[count:] == bad[: n - count + 1]] = number
    step, at, starts = COUNTS[choice].tolist(), 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    first = np.array(starts, dtype=np.int64)
    chosen = choice[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for number, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(chosen == number)
        if len(mine) and bits:
            shift = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            words[mine] |= np.bitwise_or.reduce(ids[first[mine][:, None] + np.arange(count)] << shift, axis=1)
    return words, first


def unpack(words: np.ndarray) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    end = np.cumsum(COUNTS[chosen])
    ids = np.zeros(int(end[-1]) if len(end) else 0, dtype=np.uint64)
    first = end - COUNTS[chosen]
    for number, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(chosen == number)
        if len(mine) and bits:
            shift = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            mask = np.uint64((1 << bits) - 1)
            ids[first[mine][:, None] + np.arange(count)] = (words[mine][:, None] >> shift) & mask
    return ids


def encode_block(ids: np.ndarray, doc_start: np.ndarray, escape_bits: int = ESCAPE_BITS) -> dict:
    """The coded columns of a block of ids whose documents begin at ``doc_start``."""
    ids = ids.astype(np.uint64)
    far = np.flatnonzero(ids >> np.uint64(escape_bits) != 0)
    plain = ids.copy()
    plain[far] = 0
    words, first = [], []
    for at in range(0, len(plain), CHUNK_IDS):
        w, f = pack(plain[at:at + CHUNK_IDS])
        words.append(w)
        first.append(f + at)
    first = np.concatenate(first) if first else np.zeros(0, dtype=np.int64)
    word = np.searchsorted(first, doc_start, side="right") - 1
    return {"words": b"".join(w.astype("<u8").tobytes() for w in words), "n_ids": len(ids),
            "doc_word": word.astype(np.int32), "doc_skip": (doc_start - first[word]).astype(np.int16),
            "escape_at": far, "escape_id": ids[far].view(np.int64)}


def decode_block(words: bytes, escape_at, escape_id) -> np.ndarray:
    ids = unpack(np.frombuffer(words, dtype="<u8"))
    ids[np.asarray(escape_at, dtype=np.int64)] = np.asarray(escape_id, dtype=np.int64).view(np.uint64)
    return ids


def decode_document(block, number: int, n_tokens: int) -> np.ndarray:
    """The ids of one document of a block row, from its own words only."""
    words = np.frombuffer(block["words"], dtype="<u8")
    at, skip = int(block["doc_word"][number]), int(block["doc_skip"][number])
    size = np.cumsum(COUNTS[(words[at:] >> np.uint64(60)).astype(np.int64)])
    ids = unpack(words[at:at + int(np.searchsorted(size, skip + n_tokens)) + 1])[skip:skip + n_tokens].copy()
    start = int(np.sum(np.asarray(block["doc_tokens"])[:number]))
    for place, value in zip(block["escape_at"], block["escape_id"]):
        if start <= place < start + n_tokens:
            ids[place - start] = np.int64(value).view(np.uint64)
    return ids


class Encoder:
    """Ids of whole texts, each distinct piece between blanks encoded once while it stays in a bounded cache.

    Made for a tokenizer that lower-cases, drops white space and splits by ``PIECE``: a text's ids
    are those of its pieces one after another.  Texts for which the order of composing and
    lower-casing could matter, or that spell a special token, go to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of the young generation

    def piece(self, piece: str) -> bytes:
        """Ids of text without white space, kept for the next time."""
        ids = self.old.get(piece)
        if ids is None:
            words = (piece,) if piece.isascii() and piece.isalpha() else PIECE.findall(piece)
            ids = array("I", [token.id for word in words for token in self.model.tokenize(
                word if word.isascii() and word.isprintable() else self.to_bytes(word)[0][0])]).tobytes()
        cost = ENTRY_BYTES + 4 * len(piece) + len(ids)
        if cost > CACHE_BYTES // 4:  # too long to be worth its place
            return ids
        if self.held + cost > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[piece] = ids
        self.held += cost
        return ids

    def prepared(self, text: str) -> str | None:
        """Lower-cased text with blanks between its pieces; None if only the tokenizer itself can tell."""
        if "<|" in text:
            return None
        try:
            sketch = text.encode("latin-1").translate(SKETCH)
            glued = b"#, " in sketch or b",, " in sketch
        except UnicodeEncodeError:
            if ODD.search(text) or not is_normalized("NFC", text):
                return None
            glued = GLUED.search(text) is not None
        text = text.lower().replace("\n", " ")
        # Where every comma and full stop before a blank follows a letter or digit, it is a piece of its own.
        return text if glued else text.replace(", ", " , ").replace(". ", " . ")

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; pieces that the texts share are looked up once per ``BATCH_CHARS``."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        ready, owner, chars = [], [], 0

        def settle() -> None:
            nonlocal chars
            for number, ids in zip(owner, self.coded(ready)):
                found[number].append(ids)
            ready.clear()
            owner.clear()
            chars = 0

        for number, raw in enumerate(texts):
            for part in cut(raw or "", BATCH_CHARS):
                text = self.prepared(part)
                if text is None:
                    if ready:
                        settle()
                    found[number].append(np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4"))
                    continue
                ready.append(text)
                owner.append(number)
                chars += len(text)
                if chars >= BATCH_CHARS:
                    settle()
        settle()
        return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in found]

    def coded(self, ready: list[str]) -> list[np.ndarray]:
        """The ids of prepared texts."""
        if not ready:
            return []
        lists = pc.split_pattern(pa.array(ready, pa.large_string()), " ")
        pieces = lists.flatten().dictionary_encode()
        known = [self.young.get(piece) or self.piece(piece) for piece in pieces.dictionary.to_pylist()]
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        first, place = np.cumsum(size) - size, pieces.indices.to_numpy()
        n = size[place]
        end = np.cumsum(n)
        flat = np.frombuffer(b"".join(known), dtype="<u4")[np.repeat(first[place] - (end - n), n) + np.arange(n.sum())]
        bound = np.append(0, end)[lists.offsets.to_numpy()].tolist()
        return [flat[a:b] for a, b in zip(bound, bound[1:])]


def cut(text: str, limit: int) -> list[str]:
    """A long text in parts of about ``limit`` characters, cut before blanks, where no token or special token reaches across."""
    if len(text) <= limit:
        return [text]
    parts, at = [], 0
    while at < len(text):
        end = text.find(" ", at + limit)
        end = len(text) if end < 0 else end
        parts.append(text[at:end])
        at = end
    return parts


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


BLOCK_SCHEMA = ("shard int, block int, start long, n_ids long, doc_ids array<{id}>, doc_tokens array<long>, "
                "words binary, doc_word array<int>, doc_skip array<int>, escape_at array<long>, escape_id array<long>")


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = BLOCK_IDS, escape_bits: int = ESCAPE_BITS) -> DataFrame:
    """Blocks of all documents in order of ids; ``shard`` follows that order, ``start`` counts within the shard."""
    python_ready(docs.sparkSession)
    end = np.array([end_id], dtype="<u4")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, shard, block, start = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        doc_ids, coded, size = [], [], 0

        def close() -> pd.DataFrame:
            nonlocal block, start, size
            tokens = np.array([len(x) for x in coded], dtype=np.int64)
            ids = np.concatenate(coded)
            row = {"shard": shard, "block": block, "start": start, "doc_ids": list(doc_ids), "doc_tokens": tokens}
            row |= encode_block(ids, np.cumsum(tokens) - tokens, escape_bits)
            block, start, size = block + 1, start + len(ids), 0
            doc_ids.clear()
            coded.clear()
            return pd.DataFrame([row])

        for batch in batches:
            ids = batch["id"].astype(object).where(batch["id"].notna(), None)
            for doc_id, own in zip(ids, encode.ids(list(batch["text"]))):
                doc_ids.append(doc_id)
                coded.append(np.concatenate((own, end)))
                size += len(coded[-1])
                if size >= block_ids:
                    yield close()
        if doc_ids:
            yield close()

    ordered = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).repartitionByRange("id")
    return ordered.sortWithinPartitions("id", "text").mapInPandas(run, BLOCK_SCHEMA.format(id=kind))


def write_blocks(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    token_blocks(docs, tokenizer, **options).write.parquet(path)


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, from the ids decoded out of the written blocks."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = decode_block(row.words, row.escape_at, row.escape_id).astype("<u4")
                tokens = np.asarray(row.doc_tokens, dtype=np.int64)
                end = np.cumsum(tokens)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((end - tokens).tolist(), end.tolist())]
                yield pd.DataFrame({"shard": row.shard, "id": list(row.doc_ids), "place": row.start + end - tokens,
                                    "n_tokens": tokens, "ids_crc32": crc})

    columns = ["shard", "start", "doc_ids", "doc_tokens", "words", "escape_at", "escape_id"]
    decoded = blocks.select(columns).mapInPandas(
        run, f"shard int, id {kind}, place long, n_tokens long, ids_crc32 long")
    # One row per shard: the running total over shards is as long as the list of written files.
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = sums.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return decoded.join(before, "shard").select(
        F.col("id").alias(id_col), (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Writes ``docs`` as blocks below ``path`` (default: a new shared folder) and lists what reading them gives."""
    path = path or shared_path(docs.sparkSession, "tokens")
    write_blocks(docs, path, tokenizer, **options)
    return read_documents(docs.sparkSession, path, options.get("id_col", "doc_id"))
