"""Items edited to a similarity of 0.8 and about it, in texts of every length: none is missed."""

import random

from palletrail.llm import decontam
from tests.llm.data import simple, words
from tests.llm.test_native import similar


def test_every_window_at_the_threshold(spark):
    draw, texts, items = random.Random(4), [], []
    for i in range(300):
        size = draw.choice([9, 16, 19, 31, 50])
        item = words(i, size).split()
        text = list(item)
        shift = draw.choice([0, 1])
        if size > 19:  # an edit amid the item takes up to five shingles
            text[draw.randrange(1, size // 8)] = f"edit{i}"
        texts.append(" ".join(text[shift:] if size < 19 else text))
        items.append((i, " ".join(item)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contamination_report(simple(spark, list(enumerate(texts))), bench).collect()}
    wanted = {(i, i) for i in range(300) if similar(texts[i], items[i][1])}
    assert got == wanted and any(abs(similar(texts[i], items[i][1])[0] - 0.8) < 1e-9 for i, _ in wanted)
