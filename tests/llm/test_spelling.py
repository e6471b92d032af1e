"""Spelling variants against all pairs of words and a plain walk along the forms."""

import random
import re
import zlib
from collections import Counter

from palletrail.llm import spelling
from palletrail.llm.queries import QUERIES
from tests.llm.data import documents, rows, simple


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def plain(counts, min_length=5, min_count=3, ratio=2):
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def worn_words(pairs):
    found = Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return found


def got(frame):
    return {tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_pairs_of_all_edits(spark):
    draw = random.Random(7)
    vocab = set()
    for size in range(1, 13):
        for _ in range(60):
            word = "".join(draw.choice("abé" if size < 8 else "abc") for _ in range(size))
            at = draw.randrange(size)
            vocab |= {word, word[:at] + word[at + 1:], word[:at] + draw.choice("abz") + word[at:], word[:at] + "z" + word[at + 1:]}
    vocab |= {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499}
    vocab.discard("")
    frame = spark.createDataFrame([(w,) for w in sorted(vocab)], "word string")
    found = [tuple(r) for r in spelling.near_pairs(frame).collect()]
    wanted = {(a, b) for a in vocab for b in vocab if one_edit(a, b) and (len(a), a) < (len(b), b)}
    assert len(found) == len(set(found)) and set(found) == wanted


def test_variants(spark):
    draw = random.Random(3)
    counts = Counter({"word" + "".join(draw.choice("ab") for _ in range(draw.randint(0, 6))): draw.choice([1, 2, 3, 6, 12, 25, 50]) for _ in range(150)})
    counts |= Counter({"chain" + "e" * i: 3 * 2 ** i for i in range(9)})  # forms that follow one another
    counts |= Counter({"tiesa": 3, "tiesb": 6, "tiesc": 6, "égalité": 4, "egalité": 9})
    frame = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    assert got(spelling.variants(frame)) == plain(counts)
    assert got(spelling.variants(frame, min_length=4, min_count=1, ratio=3)) == plain(counts, 4, 1, 3)


def test_no_table_of_words_is_sent_through_the_driver(spark, monkeypatch):
    """Words, their keys and forms grow with the texts, however small Spark takes them to be."""
    plan = lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    kept, plans = spelling.stored, {}
    monkeypatch.setattr(spelling, "stored", lambda df, name: plans.setdefault(name, []).append(plan(df)) or kept(df, name))
    counts = {f"word{'abcdefgh'[i % 8]}{'abcdefgh'[i // 8]}": 3 * 2 ** (i % 5) for i in range(64)}
    result = spelling.variants(spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string"))
    joined = [*plans["near-words"], *plans["variants"], *plans["forms"][1:], plan(result)]
    assert len(joined) > 3 and all("SortMergeJoin" in p and "Broadcast" not in p for p in joined)
    assert got(result) == plain(counts)


def test_query_on_given_tables(spark):
    path = "/root/testdata/sf0.001"
    pairs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    result = QUERIES["op11_spelling_variants"](spark, path)
    assert got(result) == plain(worn_words(pairs)) and any(r["form"] for r in result.collect())


def test_edges(spark):
    runs = spelling.letter_runs(documents(spark))
    wanted = Counter(w for _, t in ((r[0], r[1]) for r in rows()) for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    wanted = Counter({"".join(c.lower() if c.isascii() else c for c in w): n for w, n in wanted.items()})
    assert Counter(r["word"] for r in runs.collect()) == wanted
    assert got(spelling.variants(runs)) == plain(wanted)
    assert spelling.variants(spelling.letter_runs(simple(spark, []))).count() == 0
    assert spelling.variants(spelling.letter_runs(simple(spark, [(1, None), (2, ""), (3, "... 123")]))).count() == 0
    blanks = spark.createDataFrame([(None,), ("",), ("aaaaa",), ("aaaaa",), ("aaaaa",)], "word string")
    assert got(spelling.variants(blanks)) == {("aaaaa", None, "aaaaa", 3, 0, None)}
