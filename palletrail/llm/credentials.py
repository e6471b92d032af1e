"""Secret scans with multipart credential linking.

Strong findings are reported as they stand: assignments to secret names, access key identifiers
and long hexadecimal runs.  Weak candidates (other identifiers, other keys, endpoints) are
reported only where complementary parts lie within ``SCOPE`` code points of them: an identifier next to a
secret, a key next to an identifier, an endpoint next to both.  The interval join runs as range
frames over the spans of a row, sorted by start, so that its work grows with the spans.

Nulls and edges: null text is empty; repeated rows and ids are judged row by row; positions are
code points, ends exclusive; a weak candidate that begins within a strong finding is left out; the spans of one
row are one window, as a document is the unit of a scan; other columns are not looked at and not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds in order of report; pattern, the group that is measured, its least length.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12)
ACCESS = (r"AKIA[A-Z0-9]+", 0, 18)
HEX = (r"[0-9a-f]{16,}", 0, 16)
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
WEAK = {
    "identifier": (r"(?<![A-Za-z0-9])(?!AKIA)(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,32}(?![A-Za-z0-9])", 0, 16),
    "key": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{32,88}(?![A-Za-z0-9+/_-])", 0, 32),
    "endpoint": (r"""https?://[^\x20\x09-\x0D"'<>]+""", 0, 8),
}
KINDS = (*BASE, *WEAK)
SCOPE = 256


def pieces(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Array of (kind, gap, size, measured) of all matches in turn; ``gap`` is the text since the match before."""
    place = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    part = F.zip_with(F.arrays_zip(found.alias("m"), measured.alias("g")), F.slice(F.split(text, pattern, -1), 1, F.size(found)),
                      lambda x, gap: F.struct(F.lit(place).alias("kind"), F.length(gap).alias("gap"),
                                              F.length(x["m"]).alias("size"), F.length(x["g"]).alias("measured")))
    part = F.transform(part, lambda x, i: F.struct(x["kind"].alias("kind"), i.alias("i"), x["gap"].alias("gap"),
                                                   x["size"].alias("size"), x["measured"].alias("measured")))
    nothing = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,measured:int>>")
    return F.when(text.rlike(pattern), part).otherwise(nothing)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, spans) per row: array of (kind, start, end), strong and linked weak ones, by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.concat(
        *[pieces(text, kind, p, g) for kind, (p, g, _) in (BASE | WEAK).items()]).alias("pieces"))
    flat = rows.select("id", "row", F.explode_outer("pieces").alias("p")).select("id", "row", "p.*")
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("id", "row", "kind").orderBy("i"))
    least = F.element_at(F.array(*[F.lit(n) for *_, n in (BASE | WEAK).values()]), F.col("kind") + 1)
    spans = flat.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size"))
    spans = spans.withColumn("ok", F.col("measured") >= least)
    strong = F.col("ok") & (F.col("kind") < len(BASE))
    near = Window.partitionBy("id", "row").orderBy("start").rangeBetween(-scope, scope)
    before = Window.partitionBy("id", "row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    of = lambda *names: F.max(F.col("ok") & F.col("kind").isin([KINDS.index(n) for n in names])).over(near)
    covered = F.coalesce(F.max(F.when(strong, F.col("end"))).over(before) > F.col("start"), F.lit(False))
    spans = spans.select("id", "row", "kind", "start", "end", "ok", covered.alias("covered"),
                         of("access", "identifier").alias("by_access"), of("assign", "hex", "key").alias("by_secret"))
    linked = (F.when(F.col("kind") < len(BASE), True)
              .when(F.col("covered"), False)
              .when(F.col("kind") == KINDS.index("identifier"), F.col("by_secret"))
              .when(F.col("kind") == KINDS.index("key"), F.col("by_access"))
              .otherwise(F.col("by_access") & F.col("by_secret")))
    kept = F.when(F.col("ok") & linked, F.struct("start", "kind", "end"))
    return spans.groupBy("id", "row").agg(F.array_sort(F.collect_list(kept)).alias("spans")).select("id", "spans")


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of each row."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return find_secrets(docs, id_col, text_col, scope).select(
        F.col("id").alias(id_col), *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
