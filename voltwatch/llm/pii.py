"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only. Positions come from the texts between the matches: ``split`` by a pattern gives the gaps,
``regexp_extract_all`` the matches, and their running lengths the places (code points from 0, end exclusive). Running
sums are taken in blocks, and pieces of a text are cut from chunks of it, so a text with very many matches costs its
length, the matches times a constant, and (matches / ``BLOCK``) squared steps of addition, which stays small.

Patterns are written so that the regular expression engine never goes back over a run that it has read: possessive
quantifiers, and a start that is either the end of the last match or no place inside a run. They match the same spans
as the plain forms in ``BASE`` (given for reference and used by the tests).

Cases: a null text counts as empty; an empty text has no spans; repeated rows each give a row; an empty table gives no
rows; other columns are ignored by ``find_pii`` and kept by ``redact``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: An IBAN in groups of four; what follows in capitals may look like more groups, so the longest part that a check confirms counts.
GROUPED = r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?(?![A-Za-z0-9_])"
IBAN_CHARS = (15, 34)
#: A text that has none of this has no span of the kind.
GUARD = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11}| [A-Z0-9]{4} [A-Z0-9]{4})"),
    "ssn": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
#: Words that make a kind likelier when they stand shortly before the span.
CONTEXT = {
    "email": r"mail|contact|write|reach",
    "ip": r"\bip\b|host|server|address",
    "card": r"card|visa|credit|payment|mastercard",
    "phone": r"phone|call|tel|mobile|fax",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social security|tax id",
}
#: Score of a confirmed span without and with a context word; added kinds below ``LEAST`` are dropped.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
LIFT, LEAST, CONTEXT_CHARS = 0.4, 0.5, 40
#: Entries of an array that one running sum takes at a time, and code points of a chunk.
BLOCK, CHUNK = 64, 512
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _mod97(x: Column) -> Column:
    moved = F.concat(F.substring(x, 5, 64), F.substring(x, 1, 4))
    step = lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + (F.ascii(c) - 48)) % 97
    ).otherwise((acc * 100 + (F.ascii(c) - 55)) % 97)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _confirmed(kind: str, x: Column) -> Column:
    digits = F.regexp_replace(x, "[^0-9]", "")
    if kind == "ip":
        return x.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return _mod97(x) == 1
    if kind == "ssn":
        return ~x.rlike(r"^(?:000|666|9[0-9]{2})|-00-|-0000$")
    return F.lit(True)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use).getItem(0)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` (a sum, a maximum) makes of 0 and all entries before each place of an array of non-negative bigints;
    the last of the n + 1 entries is that of the whole array."""
    fold = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), join)

    def blocks(v: Column) -> Column:
        n = F.size(v)
        at = F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int"))
        inside = lambda b, before: F.transform(
            F.sequence(F.lit(0), F.least(F.lit(BLOCK - 1), n - b * BLOCK)), lambda i: join(before, fold(F.slice(v, b * BLOCK + 1, i)))
        )
        totals = F.transform(at, lambda b: fold(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        return _let(totals, lambda t: F.flatten(F.transform(at, lambda b: _let(fold(F.slice(t, F.lit(1), b)), lambda before: inside(b, before)))))

    return _let(values, blocks)


def chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(pieces: Column, first: Column, past: Column) -> Column:
    """Code points from ``first`` to before ``past`` of a text given as ``chunks``, at the cost of what is cut."""
    block = F.floor(first / CHUNK).cast("int")
    near = F.array_join(F.slice(pieces, block + 1, F.floor(past / CHUNK).cast("int") - block + 1), "")
    return F.substring(near, (first - block * CHUNK + 1).cast("int"), (past - first).cast("int"))


def place(text: Column, pattern: str) -> Column:
    """Matches of a pattern, in order: array of (start, end, x)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(F.zip_with(gaps, found, lambda g, x: F.struct(F.length(g).alias("gap"), x.alias("x"))), lambda p: p.x.isNotNull())
    spread = lambda held, ends: F.transform(
        held, lambda p, i: F.struct((F.get(ends, i) + p.gap).alias("start"), F.get(ends, i + 1).alias("end"), p.x.alias("x"))
    )
    lengths = lambda held: F.transform(held, lambda p: (p.gap + F.length(p.x)).cast("bigint"))
    return _let(pairs, lambda held: _let(_running(lengths(held), lambda a, b: a + b), lambda ends: spread(held, ends)))


def _grouped_ibans(text: Column) -> Column:
    """IBANs in groups: array of (start, end, x), each the longest run of whole groups that a check confirms."""

    def longest(x: Column) -> Column:
        groups = F.split(x, " ")
        parts = F.transform(F.sequence(F.size(groups), F.lit(3), F.lit(-1)), lambda k: F.array_join(F.slice(groups, F.lit(1), k), " "))
        plain = lambda p: F.replace(p, F.lit(" "), F.lit(""))
        return F.get(F.filter(parts, lambda p: F.length(plain(p)).between(*IBAN_CHARS) & (_mod97(plain(p)) == 1)), F.lit(0))

    held = F.transform(place(text, GROUPED), lambda s: F.struct(s.start.alias("start"), longest(s.x).alias("x")))
    kept = F.filter(held, lambda s: s.x.isNotNull())
    return F.transform(kept, lambda s: F.struct(s.start.alias("start"), (s.start + F.length(s.x)).alias("end"), s.x.alias("x")))


def _spans(text: Column, kind: str) -> Column:
    """Confirmed spans of a kind, in order: array of (kind, start, end, score)."""
    kept = F.filter(place(text, LINEAR[kind]), lambda s: _confirmed(kind, s.x))
    if kind == "iban":
        kept = F.array_sort(F.concat(kept, _grouped_ibans(text)))

    def scored(pieces: Column, s: Column) -> Column:
        near = F.lower(cut(pieces, F.greatest(s.start - CONTEXT_CHARS, F.lit(0)), s.start))
        score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), F.lit(LIFT)).otherwise(F.lit(0.0)))
        return F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"), F.round(score, 2).alias("score"))

    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    whole = lambda spans: _let(chunks(text), lambda pieces: F.transform(spans, lambda s: scored(pieces, s)))
    out = _let(kept, lambda spans: F.when(F.size(spans) > 0, whole(spans)).otherwise(none))
    if kind not in BASE:
        out = F.filter(out, lambda s: s.score >= LEAST)
    return F.when(GUARD[kind](text), out).otherwise(none)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the text (null: empty) as ``text``, and a column of confirmed spans for each kind of ``KINDS``."""
    base = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.select("*", *(_spans(F.col("text"), k).alias(k) for k in KINDS))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def pii_digest(df: DataFrame) -> DataFrame:
    """One row per document: counts and joined spans of the base kinds, all spans, and their scores."""
    found = find_pii(df)
    every = F.concat(*(F.col(k) for k in KINDS))
    return found.select(
        F.col("doc_id"),
        *(F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE),
        F.sha2(F.encode(_joined(F.concat(*(F.col(k) for k in BASE))), "UTF-8"), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        F.array_join(F.transform(every, lambda s: F.format_string("%.2f", s.score)), ",").alias("scores"),
    )


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same columns with every span replaced by ``<KIND>``; overlapping spans become one, named by the first.

    A null text stays null. ``length_col``, where given, gets the new length in code points.
    """
    names, text = df.columns, F.coalesce(F.col(text_col), F.lit(""))
    spans = F.concat(*(_spans(text, k) for k in KINDS))
    held = df.select("*", F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")))).alias("__spans"))
    body = F.col(text_col)

    def filled(sorted_spans: Column, reach: Column, pieces: Column) -> Column:
        """``reach``: how far the spans before each one go. A span that starts before that is part of an earlier one."""
        placed = F.transform(sorted_spans, lambda s, i: F.struct(F.get(reach, i).alias("at"), s.start.alias("start"), s.kind.alias("kind")))
        named = F.transform(
            F.filter(placed, lambda s: s.start >= s["at"]),
            lambda s: F.concat(cut(pieces, s["at"], s.start), F.lit("<"), F.upper(s.kind), F.lit(">")),
        )
        return F.concat(F.array_join(named, ""), cut(pieces, F.get(reach, F.size(sorted_spans)), F.length(body)))

    reached = lambda found: _running(F.transform(found, lambda s: s.end), lambda a, b: F.greatest(a, b))
    replaced = _let(F.col("__spans"), lambda found: _let(reached(found), lambda reach: _let(chunks(body), lambda pieces: filled(found, reach, pieces))))
    new = held.withColumn(text_col, F.when(F.size("__spans") > 0, replaced).otherwise(body)).drop("__spans")
    if length_col and length_col in names:
        new = new.withColumn(length_col, F.length(F.coalesce(F.col(text_col), F.lit(""))).cast(dict(df.dtypes)[length_col]))
    return new.select(*names)
