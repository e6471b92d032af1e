"""Personal numbers in every layout that tells them, counted over whole documents."""

import random
import re
import time

from pyspark.sql import functions as F

from palletrail.llm import pii
from palletrail.llm.common import table
from tests.llm.data import simple
from tests.llm.test_native import luhn


def replaced(spark, texts):
    got = pii.pseudonymised(simple(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    return [r["text"] for r in got], [r["n_replaced"] for r in got]


def test_telephone_numbers_of_any_area_code(spark):
    texts = ["call +1 (017) 555-7713 or (132) 055-1352", "017-555-7713, 017.555.7713", "+10175557713", "lot 100 200 3000"]
    out, n = replaced(spark, texts)
    assert n == [2, 2, 1, 0] and out[3] == texts[3]
    assert [re.sub("[0-9]", "9", t) for t in out] == [re.sub("[0-9]", "9", t) for t in texts]
    own = [re.sub("[^0-9]", "", x)[-10:] for x in (out[0][5:22], out[1][:12], out[1][14:], out[2])]
    assert set(own) == {own[0]} != {"0175557713"}


def test_telephone_permutation_is_one_to_one(spark):
    numbers = spark.range(0, 60000).select(F.format_string("+1 (%03d) %03d-%04d", F.col("id") % 1000, F.floor(F.col("id") / 60), F.col("id") % 7).alias("v"))
    numbers = numbers.distinct()
    assert numbers.select(pii.phone(F.col("v"), "k")).distinct().count() == numbers.count()


def test_no_telephone_number_of_the_layout_is_left(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").where("text rlike '[+]1 [(][0-9]{3}[)]'").select("doc_id", "text")
    numbers = lambda t: re.findall(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", t)
    before = {r["doc_id"]: numbers(r["text"]) for r in docs.collect()}
    after = {r["doc_id"]: numbers(r["text"]) for r in pii.pseudonymised(docs).collect()}
    both = [(a, b) for i in before for a, b in zip(before[i], after[i])]
    assert len(both) == 159 and sum(a == b for a, b in both) == 0


def test_cards_next_to_other_digits(spark):
    card = "4111 1111 1111 1111"
    texts = [f"{card} 12/25", "4111111111111111 123", f"2024 {card}", f"a {card} 5500-0000-0000-0004 b", "7 3782 822463 10005 5", f"{card} 5x",
             "12 1984-02-29 543-555-9258", "10 20 30 40 50 60 70 80", f"on 2024-01-05 {card}-1"]
    out, n = replaced(spark, texts)
    assert n == [1, 1, 1, 2, 1, 1, 2, 0, 2]
    assert not any("1111 1111" in t or "11111111" in t or "5500" in t or "822463" in t for t in out)
    assert [re.sub("[0-9]", "9", t) for t in out] == [re.sub("[0-9]", "9", t) for t in texts]
    assert out[0].endswith(" 12/25") and out[1].endswith(" 123") and out[2].startswith("2024 ") and out[5].endswith(" 5x")
    assert out[0][:19].replace(" ", "") == out[1][:16] == out[2][5:].replace(" ", "")


def long_table(cards):
    return " ".join(f"4111 1111 1111 {i:04d} row {i}, 4349-0004-9098-6231;" for i in range(cards // 2))


def test_a_text_full_of_cards(spark):
    run = " ".join(["4111 1111 1111 1111"] * 2000)
    texts = [run, run + " 7", long_table(2000), "12 " * 20_000, "4111111111111111," * 1000]
    begin = time.monotonic()
    out, n = replaced(spark, texts)
    assert time.monotonic() - begin < 60
    assert n == [2000, 2000, sum(luhn(f"411111111111{i:04d}") for i in range(1000)) + 1000, 0, 1000]
    assert len(set(out[0].split(" ")[::4])) == 1 and "1111 1111" not in out[0] and out[1] == out[0] + " 7" and out[3] == texts[3]
    assert [re.sub("[0-9]", "9", t) for t in out] == [re.sub("[0-9]", "9", t) for t in texts]


def test_spans_of_long_runs(spark):
    draw = random.Random(5)
    runs = []
    for _ in range(8):
        groups = []
        while len(groups) < 700:
            kind = draw.randrange(4)
            groups += [["4111", "1111", "1111", "1111"], ["3782", "822463", "10005"], ["4111111111111111"], [str(draw.randrange(10 ** draw.randint(1, 6)))]][kind]
        runs.append(" ".join(groups))
    frame = spark.createDataFrame([(r,) for r in runs], "v string").repartition(2)
    sizes = pii.card_sizes(F.regexp_extract_all("v", F.lit("[0-9]+[ -]?"), F.lit(0)))
    for row in frame.select(sizes.alias("sizes")).select("sizes", pii.card_spans(F.col("sizes")).alias("spans")).collect():
        wanted, after = [], 0
        for at, size in row["sizes"]:
            if at >= after and size:
                wanted.append((at, size))
                after = at + size
        assert [tuple(s) for s in row["spans"]] == wanted and len(wanted) > 100
