"""Format-preserving pseudonyms for personal numbers and dates by keyed Feistel permutations.

A value is replaced only if it is valid: card numbers by their check digit, telephone numbers by
their layout, social security numbers and addresses by the ranges of their parts, dates by the calendar.  Each kind is permuted
within its valid values and written in the layout found, so that equal values get equal
pseudonyms in every document and different ones stay different.  The round function is SHA-256
of key, kind, round and the other half.  Mail addresses are no numbers: the letters and
digits of their names are redrawn from the keyed hash of the name, layout kept, domain kept.

Nulls and edges: null text stays null; texts without a valid value stay as they are; repeated
rows and ids are replaced row by row; a value may be its own pseudonym, as in any permutation.
Other columns pass through, but one named like ``count_col`` is replaced; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palletrail.llm.common import fresh

KEY = "change-me"
ROUNDS = 8
# Days 1900-01-01 to 2099-12-31: 73,049 = 17 * 4,297.
FIRST_DAY, DAY_PARTS = "1900-01-01", (17, 4297)

MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DOT_DATE = r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])"
SLASH_DATE = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# A country code, brackets or even separators tell a telephone number; with blanks alone its codes must be valid.
PHONE = (r"(?<![0-9A-Za-z])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
         r"|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}|[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4})(?![0-9])")
# A run of groups of digits that may hold cards, and the layouts of a card within it: of the loose form are only groups of three or more.
RUN = (r"(?<![0-9A-Za-z])(?=(?:[ -]?[0-9]){13})[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+")
CARD = (r"\A(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})\z")
LOOSE = r"\A[0-9]{3,}(?:[ -][0-9]{3,})+\z"
MOST_GROUPS = 19
FORMS = {"mail": MAIL, "address": ADDRESS, "iso_date": ISO_DATE, "dot_date": DOT_DATE, "slash_date": SLASH_DATE,
         "social": SOCIAL, "phone": PHONE}
ANY = "|".join(FORMS.values())


SCANNED = 256  # groups of digits scanned with one list of spans


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda would compute an expression anew at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def draw(key: str, kind: str, number: Column, half: Column) -> Column:
    """Round function: 48 bits of the hash of key, kind, round and half, as a long."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: str) -> Column:
    """Permutes the pairs (a, b) of residues: rounds add a keyed function of one half to the other."""
    def step(s: Column, r: Column) -> Column:
        return F.when(r % 2 == 0, F.struct(((s["a"] + draw(key, kind, r, s["b"])) % size_a).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), ((s["b"] + draw(key, kind, r, s["a"])) % size_b).alias("b")))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), start, step)


def power10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def pad(number: Column, size) -> Column:
    return F.lpad(number.cast("string"), size, "0")


def into_layout(value: Column, drawn: Column, skip: int = 0) -> Column:
    """``value`` with its digits after the first ``skip`` replaced in turn by those of ``drawn``."""
    def filled(new: Column) -> Column:
        def char(c: Column, i: Column) -> Column:
            place = F.length(digits(F.substring(value, F.lit(1), i + 1))) - skip
            return F.when(c.rlike("[0-9]"), F.when(place > 0, F.substring(new, place, F.lit(1))).otherwise(c)).otherwise(c)

        return F.array_join(F.transform(F.split(value, ""), char), "")

    return let(drawn, filled)


def luhn_sum(number: Column, doubled: int) -> Column:
    """Sum of the digits, from the last, those of places of parity ``doubled`` doubled and cast out."""
    chars = F.split(F.reverse(number), "")
    each = F.transform(chars, lambda c, i: F.when(i % 2 == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
                       .otherwise(F.coalesce(c.cast("int"), F.lit(0))))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def card(value: Column, key: str) -> Column:
    def new(number: Column) -> Column:
        body = F.substring(number, F.lit(1), F.length(number) - 1)
        left = F.floor((F.length(number) - 1) / 2).cast("int")
        right = (F.length(number) - 1 - left).cast("int")
        out = feistel(F.substring(body, F.lit(1), left), F.substring(body, left + 1, right), power10(left), power10(right), key, "card")
        drawn = let(out, lambda o: F.concat(pad(o["a"], left), pad(o["b"], right)))
        return let(drawn, lambda n: F.concat(n, ((10 - luhn_sum(n, 0) % 10) % 10).cast("string")))

    return let(value, lambda v: let(digits(v), lambda number: F.when(luhn_sum(number, 1) % 10 == 0, into_layout(v, new(number)))))


def card_sizes(tokens: Column) -> Column:
    """(at, size): of how many groups of digits the card is that begins at each, 0 for none; a known layout goes first, then the longest."""
    count = F.size(tokens)

    def best(at: Column) -> Column:
        def fits(size: Column) -> Column:
            def formed(value: Column) -> Column:
                form = F.when(value.rlike(CARD), 2).when(value.rlike(LOOSE) | ((at == 0) & (size == count)), 1)
                return F.when(let(digits(value), lambda n: F.length(n).between(13, 19) & (luhn_sum(n, 1) % 10 == 0)), form)

            def sized(form: Column) -> Column:
                return F.when(form.isNotNull(), F.struct(form.alias("formed"), size.alias("size")))

            # 19 digits with a separator after each are the most; most stretches are left at their length.
            found = lambda w: F.when(F.length(w).between(13, 38), let(F.rtrim(F.regexp_replace(w, "[ -]$", "")), formed))
            return let(let(F.array_join(F.slice(tokens, at + 1, size), ""), found), sized)

        sizes = F.sequence(F.lit(1), F.least(F.lit(MOST_GROUPS), count - at))
        return F.coalesce(F.array_max(F.transform(sizes, fits))["size"], F.lit(0))

    return F.transform(tokens, lambda t, at: F.struct(at.alias("at"), best(at).alias("size")))


def card_spans(sizes: Column) -> Column:
    """(at, size) of the cards, from the first on, none reaching into another.

    The groups are scanned in stretches, each with a list of its own, so that the work grows with their number.
    """
    none = F.array().cast("array<struct<at:int,size:int>>")

    def step(s: Column, x: Column) -> Column:
        return F.when((x["at"] >= s["next"]) & (x["size"] > 0), F.struct(
            (x["at"] + x["size"]).alias("next"), F.array_append(s["spans"], x).alias("spans"))).otherwise(s)

    def stretch(s: Column, first: Column) -> Column:
        inner = F.aggregate(F.slice(sizes, first + 1, SCANNED), F.struct(s["next"].alias("next"), none.alias("spans")), step)
        return let(inner, lambda i: F.struct(i["next"].alias("next"), F.array_append(s["lists"], i["spans"]).alias("lists")))

    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<array<struct<at:int,size:int>>>").alias("lists"))
    firsts = F.when(F.size(sizes) > 0, F.sequence(F.lit(0), F.size(sizes) - 1, F.lit(SCANNED))).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.aggregate(firsts, start, stretch)["lists"])


def cards(run: Column, key: str) -> Column:
    """(text, n): a run of groups of digits with its cards replaced, and how many."""
    def written(tokens: Column) -> Column:
        part = lambda first, size: F.array_join(F.slice(tokens, first + 1, size), "")

        def made(spans: Column) -> Column:
            def piece(span: Column, i: Column) -> Column:
                before = F.coalesce(F.get(spans, i - 1)["at"] + F.get(spans, i - 1)["size"], F.lit(0))
                return F.concat(part(before, span["at"] - before), card(part(span["at"], span["size"]), key))

            last = F.get(spans, F.size(spans) - 1)
            rest = F.coalesce(last["at"] + last["size"], F.lit(0))
            return F.struct(F.concat(F.array_join(F.transform(spans, piece), ""), part(rest, F.size(tokens))).alias("text"),
                            F.size(spans).alias("n"))

        return let(card_sizes(tokens), lambda sizes: let(card_spans(sizes), made))

    return let(F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), F.lit(0)), written)


def with_cards(gap: Column, key: str) -> Column:
    """(text, n): a stretch of text without other values, with its cards replaced, and how many."""
    def made(runs: Column) -> Column:
        texts = F.zip_with(F.split(gap, RUN, -1), runs, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b["text"], F.lit(""))))
        return F.struct(F.array_join(texts, "").alias("text"), F.aggregate(runs, F.lit(0), lambda n, r: n + r["n"]).alias("n"))

    found = F.transform(F.regexp_extract_all(gap, F.lit(RUN), F.lit(0)), lambda r: cards(r, key))
    plain = F.struct(gap.alias("text"), F.lit(0).alias("n"))
    return F.when(gap.rlike(RUN), let(found, made)).otherwise(plain)


def phone(value: Column, key: str) -> Column:
    number, prefix = digits(value), F.length(digits(value)) - 10
    last = F.substring(number, prefix + 1, F.lit(10))
    area, rest = F.substring(last, 1, 3).cast("long"), F.substring(last, 4, 7).cast("long")
    # Valid numbers, those of other area codes and those of other exchanges are each permuted among themselves.
    low, short = area < 200, rest < 2_000_000
    from_a, size_a = F.when(low, 0).otherwise(200), F.when(low, 200).otherwise(800)
    from_b = F.when(low | short, 0).otherwise(2_000_000)
    size_b = F.when(low, 10_000_000).when(short, 2_000_000).otherwise(8_000_000)
    out = feistel(area - from_a, rest - from_b, size_a, size_b, key, "phone")
    new = let(out, lambda o: F.concat(pad(o["a"] + from_a, 3), pad(o["b"] + from_b, 7)))
    return F.when(prefix == 1, into_layout(value, new, 1)).otherwise(into_layout(value, new))


def social(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(digits(value), at, n).cast("long") for at, n in ((1, 3), (4, 2), (6, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    out = feistel(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "social")
    new_area = lambda a: a + 1 + F.when(a + 1 >= 666, 1).otherwise(0)
    new = let(out, lambda o: F.concat(pad(new_area(o["a"]), 3), pad(F.floor(o["b"] / 9999) + 1, 2), pad(o["b"] % 9999 + 1, 4)))
    return F.when(valid, into_layout(value, new))


def address(value: Column, key: str) -> Column:
    parts = F.split(value, r"\.")
    valid = F.forall(parts, lambda p: (p.cast("int") <= 255) & (p == p.cast("int").cast("string")))
    part = lambda i: parts[i].cast("long")
    out = feistel(part(0) * 256 + part(1), part(2) * 256 + part(3), F.lit(65536), F.lit(65536), key, "address")
    byte = lambda x: F.concat_ws(".", F.floor(x / 256).cast("string"), (x % 256).cast("string"))
    return F.when(valid, let(out, lambda o: F.concat_ws(".", byte(o["a"]), byte(o["b"]))))


def day(value: Column, layout: str, key: str) -> Column:
    number = F.datediff(F.try_to_date(value, layout), F.lit(FIRST_DAY).cast("date")).cast("long")
    a, b = DAY_PARTS
    out = feistel(F.floor(number / b), number % b, F.lit(a), F.lit(b), key, "date")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), (out["a"] * b + out["b"]).cast("int"))
    return F.when((number >= 0) & (number < a * b), F.date_format(new, layout))


def mail(value: Column, key: str) -> Column:
    name = F.lower(F.substring_index(value, "@", 1))

    def char(c: Column, i: Column) -> Column:
        drawn = draw(key, "mail", i, name)
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (drawn % 26 + 1).cast("int"), F.lit(1))
        return F.when(c.rlike("[a-z]"), letter).when(c.rlike("[0-9]"), (drawn % 10).cast("string")).otherwise(c)

    return F.concat(F.array_join(F.transform(F.split(name, ""), char), ""), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(value: Column, key: str) -> Column:
    """(kind, text): the replacement of a found value, null text if the value is not valid."""
    whole = lambda form: value.rlike(rf"\A(?:{form})\z")
    made = {"mail": mail(value, key), "address": address(value, key), "iso_date": day(value, "yyyy-MM-dd", key),
            "dot_date": day(value, "dd.MM.yyyy", key), "slash_date": day(value, "MM/dd/yyyy", key),
            "social": social(value, key), "phone": phone(value, key)}
    choice = F.lit(None).cast("string")
    kind = F.lit(None).cast("string")
    for name, form in reversed(FORMS.items()):
        choice = F.when(whole(form), made[name]).otherwise(choice)
        kind = F.when(whole(form), F.lit(name)).otherwise(kind)
    return F.struct(kind.alias("kind"), choice.alias("text"))


def pseudonymised(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str = "n_replaced") -> DataFrame:
    """``docs`` with all valid values replaced in its text, and the number of replacements."""
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    drawn = F.transform(found, lambda v: F.coalesce(pseudonym(v, key)["text"], F.concat(F.lit("\u0000"), v)))
    made, gaps = fresh(docs, "drawn"), fresh(docs, "gaps")
    some = text.rlike("[0-9@]") & (text.rlike(ANY) | text.rlike(RUN))
    # Cards are looked for between the other values, so that a run of digits cannot take those in.
    rows = docs.withColumn(made, F.when(some, drawn)).withColumn(
        gaps, F.when(some, F.transform(F.split(text, ANY, -1), lambda g: with_cards(g, key))))
    plain = lambda p: F.when(F.startswith(p, F.lit("\u0000")), F.substring(p, F.lit(2), F.length(p))).otherwise(p)
    joined = F.array_join(F.zip_with(gaps, made, lambda gap, p: F.concat(gap["text"], F.coalesce(plain(p), F.lit("")))), "")
    replaced = F.size(F.filter(made, lambda p: ~F.startswith(p, F.lit("\u0000")))) + F.aggregate(gaps, F.lit(0), lambda n, g: n + g["n"])
    return rows.withColumns({count_col: F.when(F.col(made).isNotNull(), replaced).otherwise(0).cast("long"),
                             text_col: F.when(F.col(made).isNotNull(), joined).otherwise(text)}).drop(made, gaps)
