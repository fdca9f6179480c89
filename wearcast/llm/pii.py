"""Personal data: patterns propose spans, checksums confirm them, context scores them.

DataFrame functions only.  For each kind, the text is split at the pattern's
matches: the lengths of the pieces and matches give every span's position in
code points, and the pieces' ends are the context next to it.  Possessive
quantifiers and a look-behind (or the end of the previous match, ``\\G``) keep
the scan linear on long runs without changing what matches.

Base kinds (email, ip, card, phone) are kept whenever their rule holds; their
score only reports confidence.  Added kinds are kept if the score, raised by
a context word within ``WINDOW`` characters, reaches the threshold:

* ``iban``: country code, check digits, as many more characters as the country
  has, mod-97 = 1; for other codes or lengths, the shortest run of whole groups
  with 11 to 30 more characters and mod-97 = 1;
* ``ssn``: 3-2-4 digits with a valid area, group and serial;
* ``local_phone``: 3-3-4 digits without a plus sign.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import table

WINDOW = 40
THRESHOLD = 0.5
BLOCK = 256

#: Characters of an account number by country, check digits included.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_KNOWN = "(?:" + "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in _IBAN_LENGTHS.items()
) + ")(?![A-Za-z0-9])"
#: A number of its country's length; else groups, up to where such a number
#: begins.  A start that is followed by one too early is passed over.
_IBAN = (rf"(?<![A-Za-z0-9])(?![A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{0,10}}\x20{_IBAN_KNOWN})"
         rf"(?:{_IBAN_KNOWN}|[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{_IBAN_KNOWN})\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))")

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """``order`` breaks ties of equal starts; ``score`` holds without context,
    and ``context`` (words in the neighbourhood) adds ``boost``."""

    name: str
    order: int
    pattern: str
    guard: str
    score: float
    boost: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", 0, r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, 0.1, "mail|contact|write|address"),
    Kind("ip", 1, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, 0.3,
         "ip|host|server|address"),
    Kind("card", 2, r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", 0.7, 0.3,
         "card|credit|debit|visa|payment"),
    Kind("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, 0.3, "phone|tel|call|mobile|fax"),
    Kind("iban", 4, _IBAN, r"[A-Z]{2}[0-9]{2}", 0.8, 0.2, "iban|account|bank|konto", base=False),
    Kind("ssn", 5, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"-[0-9]{2}-", 0.3, 0.4,
         "ssn|social|security", base=False),
    Kind("local_phone", 6, r"(?<![0-9+.(-])(?<!\+[0-9]{1,3}[\x20-]{1,2})\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
         r"[0-9]{3}[\x20.-][0-9]{4}", 0.3, 0.4, "phone|tel|call|mobile|fax", base=False),
)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _mod97(x: Column) -> Column:
    """Remainder of the rearranged account number (letters count 10 to 35)."""
    plain = F.replace(x, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    step = lambda acc, c: F.when(c.between("A", "Z"), (acc * 100 + F.ascii(c) - 55) % 97).otherwise(
        (acc * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _account(hit: Column) -> Column:
    """The account number that a match of ``_IBAN`` begins with, or null."""
    ends = F.filter(F.sequence(F.lit(15), F.length(hit)),
                    lambda i: (F.substring(hit, i + 1, F.lit(1)).isin("", " ")) & (F.substring(hit, i, F.lit(1)) != " "))
    ends = F.when(hit.rlike(f"^{_IBAN_KNOWN}$"), F.array(F.length(hit))).otherwise(ends)
    return F.get(F.filter(F.transform(ends, lambda i: F.left(hit, i)),
                          lambda x: (F.length(F.replace(x, F.lit(" "), F.lit(""))) >= 15) & (_mod97(x) == 1)), F.lit(0))


def _confirmed(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return n.between(12, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return hit.isNotNull()
    if kind == "ssn":
        return ~hit.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _located(text: Column, pattern: str) -> Column:
    """Array of (start, end, left, hit, right) of the matches, in code points."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.filter(F.arrays_zip(pieces.alias("piece"), hits.alias("hit"),
                                  F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))).alias("next")),
                     lambda p: p["hit"].isNotNull())
    return F.transform(F.array(parts), _in_blocks)[0]


def _in_blocks(parts: Column) -> Column:
    """Running positions, block by block: appending to one long array would
    cost the square of the number of matches."""
    longs, item = "array<bigint>", "struct<start:bigint,end:bigint,left:string,hit:string,right:string>"
    zero = F.lit(0).cast("long")
    width = lambda p: (F.length(p["piece"]) + F.length(p["hit"])).cast("long")
    n_blocks = F.ceil(F.size(parts) / BLOCK).cast("int")
    numbers = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(numbers, lambda b: F.slice(parts, b * BLOCK + 1, F.lit(BLOCK)))

    def locate(pair: Column) -> Column:
        def step(acc: Column, p: Column) -> Column:
            start = acc["at"] + F.length(p["piece"])
            end = start + F.length(p["hit"])
            one = F.struct(start.alias("start"), end.alias("end"), F.right(p["piece"], F.lit(WINDOW)).alias("left"),
                           p["hit"].alias("hit"), F.left(p["next"], F.lit(WINDOW)).alias("right"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        begin = F.struct(pair["at"].alias("at"), F.array().cast(f"array<{item}>").alias("out"))
        return F.aggregate(pair["block"], begin, step, lambda acc: acc["out"])

    def placed(cut: Column) -> Column:
        sums = F.transform(cut, lambda blk: F.aggregate(blk, zero, lambda acc, p: acc + width(p)))
        begin = F.struct(zero.alias("at"), F.array().cast(longs).alias("out"))
        starts = F.aggregate(sums, begin, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])
        return F.flatten(F.transform(F.arrays_zip(cut.alias("block"), starts.alias("at")), locate))

    return F.transform(F.array(blocks), placed)[0]


def _without_tail(s: Column) -> Column:
    """The match cut to its account number; what it had behind is context."""
    number = _account(s["hit"])
    tail = F.substring(s["hit"], F.length(number) + 1, F.lit(100))
    return F.struct(s["start"].alias("start"), (s["start"] + F.length(number)).alias("end"), s["left"].alias("left"),
                    number.alias("hit"), F.left(F.concat(tail, s["right"]), F.lit(WINDOW)).alias("right"))


def _spans(text: Column, kind: Kind) -> Column:
    found = _located(text, kind.pattern)
    if kind.name == "iban":
        found = F.transform(found, _without_tail)
    found = F.filter(found, lambda s: _confirmed(kind.name, s["hit"]))

    def scored(s: Column) -> Column:
        near = F.lower(F.concat_ws(" ", s["left"], s["right"])).rlike(rf"\b(?:{kind.context})\b")
        return F.struct(s["start"].alias("start"), F.lit(kind.order).alias("order"), s["end"].alias("end"),
                        F.lit(kind.name).alias("kind"),
                        F.round(F.when(near, kind.score + kind.boost).otherwise(kind.score), 3).alias("score"))

    spans = F.transform(found, scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    kind_type = "array<struct<start:bigint,order:int,end:bigint,kind:string,score:double>>"
    guard = text.contains("@") if kind.guard == "@" else text.rlike(kind.guard)
    return F.when(guard, spans).otherwise(F.array().cast(kind_type)).cast(kind_type)


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii_spans") -> DataFrame:
    """``docs`` plus ``out``: all spans (start, order, end, kind, score), by
    start, then kind order, then end.

    Null and empty texts have an empty array.  A column already named ``out``
    is replaced; other columns pass through.  Spans of different kinds may
    overlap.  Repeated rows are handled one by one; empty tables stay empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(out, F.array_sort(F.concat(*[_spans(text, k) for k in KINDS])))


def _joined(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _of_order(order: int):
    return lambda s: s["order"] == order


BASE = tuple(k.name for k in KINDS if k.base)


def span_digest(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans."""
    found = with_spans(docs.select("doc_id", "text")).drop("text")
    base = F.filter("pii_spans", lambda s: s["order"] < len(BASE))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.size(F.filter("pii_spans", _of_order(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("pii_spans")).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """Text with every span replaced by ``<KIND>``; of overlapping spans the
    one that starts first (then the kind order) names the whole stretch."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"].cast("int") + 1, F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        marker = F.when(s["start"] >= acc["at"], F.concat(before, F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.array_append(acc["out"], F.coalesce(marker, F.lit(""))).alias("out"))

    return F.aggregate(spans, zero, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"].cast("int") + 1, 2147483647)))


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced by kind markers, same
    columns; ``n_chars``, if there, is set to the new length.  Null texts stay
    null, texts without spans are unchanged."""
    names = docs.columns
    hidden = "_pii_spans"
    while hidden in names:
        hidden += "_"
    found = with_spans(docs, text_col, hidden)
    out = found.withColumn(text_col, F.when(F.size(hidden) > 0, masked(F.col(text_col), F.col(hidden))).otherwise(
        F.col(text_col)))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(hidden) > 0, F.length(text_col)).otherwise(
            F.col("n_chars")).cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in names])


# The base spans and their digest in DuckDB (Luhn summed digit by digit).  The
# generated tables hold none of the added kinds, so ``spans`` equals the base.
def _oracle() -> str:
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    }
    rules = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(hit, '.'), lambda x: try_cast(x AS hugeint) <= 255))",
        "card": "length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: "
                "CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(d), i, 1) AS int) "
                "ELSE (CAST(substr(reverse(d), i, 1) AS int) * 2) // 10 "
                "+ (CAST(substr(reverse(d), i, 1) AS int) * 2) % 10 END)) % 10 = 0",
        "phone": "length(d) BETWEEN 9 AND 15",
    }
    parts = []
    for o, (k, p) in enumerate(patterns.items()):
        parts.append(f"""SELECT doc_id, rid, {o} AS ord, '{k}' AS kind, st, st + length(hit) AS en FROM (
  SELECT doc_id, rid, hit, regexp_replace(hit, '[^0-9]', '', 'g') AS d,
         list_sum(list_transform(pieces[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS st
  FROM (SELECT doc_id, rid, hits, pieces, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT doc_id, rid, regexp_extract_all(text, '{p}') AS hits,
                     string_split_regex(text, '{p}') AS pieces FROM t))) WHERE {rules[k]}""")
    return f"""WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
s AS ({' UNION ALL '.join(parts)}),
g AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
        string_agg(kind || ':' || CAST(st AS bigint) || ':' || CAST(en AS bigint), ',' ORDER BY st, ord) AS j
      FROM s GROUP BY rid)
SELECT t.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)},
       sha256(coalesce(j, '')) AS base_sha256, coalesce(j, '') AS spans
FROM t LEFT JOIN g USING (rid)"""


@query("op5_pii_spans", _oracle())
def op5(spark, sf_dir):
    """Spans of personal data in every document."""
    return span_digest(table(spark, sf_dir, "documents"))
