"""Pseudonyms against a plain Feistel network of the same key."""

import datetime
import hashlib
import random

from pyspark.sql import functions as F

from palletrail.llm import pii
from tests.llm.data import documents, simple
from tests.llm.test_native import luhn

K = "plain-key"


def drawn(kind, r, half):
    return int(hashlib.sha256(f"{K}|{kind}|{r}|{half}".encode()).hexdigest()[:12], 16)


def feistel(a, b, size_a, size_b, kind):
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = (a + drawn(kind, r, b)) % size_a
        else:
            b = (b + drawn(kind, r, a)) % size_b
    return a, b


def card(number):
    body = number[:-1]
    left = len(body) // 2
    right = len(body) - left
    a, b = feistel(int(body[:left]), int(body[left:]), 10 ** left, 10 ** right, "card")
    body = f"{a:0{left}d}{b:0{right}d}"
    return next(body + d for d in "0123456789" if luhn(body + d))


def phone(number):
    area, rest = int(number[:3]), int(number[3:])
    low, short = area < 200, rest < 2_000_000
    from_a, size_a = (0, 200) if low else (200, 800)
    from_b = 0 if low or short else 2_000_000
    size_b = 10_000_000 if low else 2_000_000 if short else 8_000_000
    a, b = feistel(area - from_a, rest - from_b, size_a, size_b, "phone")
    return f"{a + from_a:03d}{b + from_b:07d}"


def social(text):
    area, group, serial = (int(x) for x in text.split("-"))
    a, b = feistel(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "social")
    area = a + 1 + (a + 1 >= 666)
    return f"{area:03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def address(text):
    p = [int(x) for x in text.split(".")]
    a, b = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536, "address")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def day(text):
    first, (size_a, size_b) = datetime.date(1900, 1, 1), pii.DAY_PARTS
    n = (datetime.date.fromisoformat(text) - first).days
    a, b = feistel(n // size_b, n % size_b, size_a, size_b, "date")
    return (first + datetime.timedelta(a * size_b + b)).isoformat()


def test_values_equal_those_of_the_plain_network(spark):
    draw = random.Random(11)
    texts, wanted = [], []
    for _ in range(60):
        body = "".join(draw.choice("0123456789") for _ in range(draw.randint(12, 18)))
        number = next(body + d for d in "0123456789" if luhn(body + d))
        tel = "".join(draw.choice("0123456789") for _ in range(10))
        sec = f"{draw.choice([1, 665, 667, 899, draw.randrange(1, 666)]):03d}-{draw.randrange(1, 100):02d}-{draw.randrange(1, 10000):04d}"
        ip = ".".join(str(draw.randrange(256)) for _ in range(4))
        date = (datetime.date(1900, 1, 1) + datetime.timedelta(draw.randrange(73049))).isoformat()
        shown = lambda t: f"+1 ({t[:3]}) {t[3:6]}-{t[6:]}"
        form = "card {} tel {} ssn {} ip {} on {}."
        texts.append(form.format(number, shown(tel), sec, ip, date))
        wanted.append(form.format(card(number), shown(phone(tel)), social(sec), address(ip), day(date)))
    got = pii.pseudonymised(simple(spark, list(enumerate(texts))), key=K).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == wanted and {r["n_replaced"] for r in got} == {5}


def test_edges(spark):
    assert pii.pseudonymised(simple(spark, [])).count() == 0
    docs = documents(spark).withColumns({"n_replaced": F.lit("own"), "gaps": F.lit("own")})
    out = pii.pseudonymised(docs)
    assert out.columns == docs.columns and {r["gaps"] for r in out.collect()} == {"own"} and out.schema["n_replaced"].dataType.simpleString() == "bigint"
