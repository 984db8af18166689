"""Personal data: regular expressions propose spans, checksums confirm them, nearby
context words adjust the score.  DataFrame functions only, no Python on the executors.

Positions.  SQL functions return matches but not their places, so each kind is
found twice with the same expression: ``regexp_extract_all`` gives the matches and
``split`` the text between them; a running sum of both lengths (code points) gives
start and end.  The sum runs in blocks of BLOCK matches, so a text with a million
matches costs about n * BLOCK / 2 element copies, not n**2.

Expressions are written for linear time on any text: runs are possessive (``++``),
and a run may only start where the class before it ends or where the previous
match ended (``\\G``), which finds the same leftmost matches as the plain pattern.
A cheap test per text (``contains`` or one ``rlike``) skips both passes where a kind
cannot occur.

Score of a span: the kind's base value, plus the value of its checksum or format
check (a failed check drops the span), plus the value of a context word among the
CONTEXT characters of the text before it.  Base kinds start at or above the threshold, so they
are kept whatever the context; the added kinds need a checksum, a context word or
both.  An added span that overlaps a base span is dropped.

Scale: one narrow pass without a shuffle.  Defined results: a null text counts as
empty (no spans); repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.frames import carried, quoted

BLOCK = 256
CONTEXT = 40
THRESHOLD = 0.6

_SPAN = "array<struct<s:int,e:int,t:string,b:string,f:string,c:string>>"


@dataclass(frozen=True)
class Kind:
    name: str
    regex: str
    check: str  # SQL condition on the match x.t (gap's last character: x.b, character after: x.f)
    base: float
    checked: float  # added when the check holds
    near: str  # context words
    nearby: float  # added when one stands before the match
    may: str  # cheap SQL condition on the text t; others cannot match


_DIGITS = "regexp_replace(x.t, '[^0-9]', '')"

_LUHN = ("aggregate(sequence(1, length({d})), 0, (a, i) -> a + CASE "
         "WHEN (length({d}) - i) % 2 = 0 THEN cast(substring({d}, i, 1) AS int) "
         "WHEN cast(substring({d}, i, 1) AS int) > 4 "
         "THEN 2 * cast(substring({d}, i, 1) AS int) - 9 "
         "ELSE 2 * cast(substring({d}, i, 1) AS int) END) % 10 = 0")

_CARD_REGEX = r"[0-9](?:[ \-]?+[0-9])++"


def _card(low: int, high: int) -> str:
    luhn = _LUHN.format(d=_DIGITS)
    return f"CASE WHEN length({_DIGITS}) BETWEEN {low} AND {high} THEN {luhn} ELSE false END"


_OCTET = "0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
_IBAN = "replace(x.t, ' ', '')"
# ISO 7064 mod 97-10: the first four characters go to the end, letters count 10 to 35.
_MOD97 = ("aggregate(split(concat(substring({v}, 5), substring({v}, 1, 4)), ''), 0, (a, c) -> "
          "CASE WHEN c = '' THEN a WHEN c BETWEEN '0' AND '9' THEN (a * 10 + cast(c AS int)) % 97 "
          "ELSE (a * 100 + ascii(c) - 55) % 97 END) = 1")

# Lengths of the countries' IBANs: the registry, then the codes in use beside it.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST AO CV GW MZ", 26: "IS TR DZ IR",
    27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban(blank: str) -> str:
    """An IBAN of its country's length that ends with a word."""
    return "(?:" + "|".join(
        f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:{blank}[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
        + (f"{blank}[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, codes in _IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])"


# The country's length decides where a match ends; other lengths and codes end with the
# last word that fits.  No match runs over a blank into the next IBAN.
_BLANK = f"(?: (?!{_iban(' ?')}))?"
_IBAN_REGEX = (f"(?<![A-Za-z0-9])(?:{_iban(_BLANK)}|[A-Z]{{2}}[0-9]{{2}}(?:{_BLANK}[A-Z0-9]{{4}}){{2,7}}"
               f"(?:{_BLANK}[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))")

# The characters next to the match are of other classes.
_APART = "NOT x.b RLIKE '[{left}]' AND NOT x.f RLIKE '[{right}]'"

# The four base kinds, in the contract's order.
BASE_KINDS = [
    Kind("email",
         r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
         "true", 0.8, 0.0, "mail|contact|write", 0.1, "contains(t, '@')"),
    Kind("ip",
         r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         f"x.t RLIKE '^{_OCTET}([.]{_OCTET}){{3}}$'", 0.6, 0.1,
         r"\bip\b|address|host|server", 0.2, "t RLIKE '[0-9][.][0-9]'"),
    Kind("card", _CARD_REGEX, _card(16, 19), 0.6, 0.2, "card|visa|credit|payment", 0.2,
         "t RLIKE '([0-9][ \\\\-]?+){15}[0-9]'"),
    Kind("phone", r"\+[0-9][ ().0-9\-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15", 0.6, 0.1,
         "tel|phone|call|mobile|fax", 0.2, "contains(t, '+')"),
]

# What the method adds: kinds that need a checksum, a context word or both.
ADDED_KINDS = [
    Kind("iban", _IBAN_REGEX,
         f"length({_IBAN}) BETWEEN 15 AND 34 AND {_MOD97.format(v=_IBAN)} AND "
         + _APART.format(left="A-Za-z0-9", right="A-Za-z0-9"), 0.2, 0.5,
         "iban|account|bank|konto|compte|cuenta", 0.2,
         "t RLIKE '[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}'"),
    Kind("short_card", _CARD_REGEX, _card(13, 15), 0.1, 0.2,
         "card|visa|amex|credit|karte|carte|tarjeta", 0.4,
         "t RLIKE '([0-9][ \\\\-]?+){12}[0-9]'"),
    Kind("national_id", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "NOT x.t RLIKE '^(000|666|9)|-00-|-0000$' AND "
         + _APART.format(left="0-9\\\\-", right="0-9\\\\-"), 0.2, 0.1, "ssn|social security", 0.4,
         "t RLIKE '[0-9]-[0-9]{2}-[0-9]{4}'"),
    Kind("local_phone", r"\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}",
         _APART.format(left="0-9+().\\\\-", right="0-9"), 0.2, 0.0, "tel|phone|call|mobile|fax", 0.5,
         "t RLIKE '[0-9]{3}[ .\\\\-][0-9]{4}'"),
]


def _beside(gaps: str, hits: str) -> str:
    """SQL: each match with its length, the end of the gap before it, and what stands next to it."""
    n = f"size({hits})"
    return (f"zip_with(zip_with(slice({gaps}, 1, {n}), slice({gaps}, 2, {n}), (y, w) -> "
            f"named_struct('y', y, 'w', w)), {hits}, (p, z) -> named_struct('g', length(p.y), "
            f"'h', length(z), 't', z, 'b', right(p.y, 1), 'f', left(p.w, 1), "
            f"'y', right(p.y, {CONTEXT})))")


def _spans(df: DataFrame, kinds: list[Kind]) -> DataFrame:
    """Adds {kind}_x: kept spans (s, e, t, score) of every kind; ``t`` is the text."""
    keep = df.columns
    hits = [F.when(F.expr(k.may), F.regexp_extract_all("t", F.lit(k.regex), F.lit(0)))
            .otherwise(F.array().cast("array<string>")).alias(f"{k.name}_h") for k in kinds]
    df = df.select(*keep, *hits)
    names = [f"{k.name}_h" for k in kinds]
    df = df.select(*keep, *names, *[
        F.when(F.size(f"{k.name}_h") > 0, F.split("t", k.regex, -1))
        .otherwise(F.array().cast("array<string>")).alias(f"{k.name}_g") for k in kinds])
    df = df.select(*keep, *[F.expr(
        _beside(f"`{k.name}_g`", f"`{k.name}_h`")).alias(f"{k.name}_p") for k in kinds])
    df = df.select(*keep, *[F.expr(
        f"CASE WHEN size(`{k.name}_p`) = 0 THEN array(`{k.name}_p`) ELSE transform(sequence("
        f"0, cast((size(`{k.name}_p`) - 1) div {BLOCK} AS int)), "
        f"i -> slice(`{k.name}_p`, i * {BLOCK} + 1, {BLOCK})) END").alias(f"{k.name}_b")
        for k in kinds])
    # First place of every block and the text before it, then the same within each block.
    step = (f"'p', {{a}}.p + y.g + y.h, 'c', right(concat({{a}}.c, y.y, y.t), {CONTEXT})")
    df = df.select(*df.columns, *[F.expr(
        f"aggregate(`{k.name}_b`, named_struct('v', named_struct('p', 0, 'c', ''), "
        "'o', cast(array() AS array<struct<p:int,c:string>>)), (a, b) -> named_struct("
        f"'v', aggregate(b, a.v, (n, y) -> named_struct({step.format(a='n')})), "
        f"'o', concat(a.o, array(a.v))), a -> a.o)").alias(f"{k.name}_o") for k in kinds])
    df = df.select(*keep, *[F.expr(
        f"flatten(zip_with(`{k.name}_b`, `{k.name}_o`, (b, o) -> aggregate(b, named_struct("
        f"'p', o.p, 'c', o.c, 'r', cast(array() AS {_SPAN})), (a, y) -> named_struct("
        f"{step.format(a='a')}, 'r', concat(a.r, array(named_struct('s', a.p + y.g, "
        "'e', a.p + y.g + y.h, 't', y.t, 'b', y.b, 'f', y.f, "
        f"'c', right(concat(a.c, y.y), {CONTEXT}))))), a -> a.r)))").alias(f"{k.name}_l")
        for k in kinds])
    return df.select(*keep, *[F.expr(
        f"filter(transform(filter(`{k.name}_l`, x -> {k.check}), x -> named_struct("
        f"'s', x.s, 'e', x.e, 't', x.t, 'score', {k.base + k.checked:.1f}D + "
        f"CASE WHEN lower(x.c) RLIKE {_quoted(k.near)} THEN {k.nearby:.1f}D ELSE 0D END)), "
        f"x -> x.score >= {THRESHOLD}D)").alias(f"{k.name}_x") for k in kinds])


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(df: DataFrame, kinds: list[Kind]) -> DataFrame:
    """Adds findings, (kind, start, end, value, score) by kind, then start; ``t`` is the text."""
    keep = df.columns
    df = _spans(df, kinds)
    base = [F.col(f"{k.name}_x") for k in kinds if k in BASE_KINDS]
    if base:
        df = df.withColumn("base", F.concat(*base))
    free = "filter(`{n}_x`, x -> NOT exists(base, b -> b.s < x.e AND x.s < b.e))"
    parts = []
    for k in kinds:
        src = f"`{k.name}_x`" if k in BASE_KINDS or not base else free.format(n=k.name)
        parts.append(F.expr(f"transform({src}, x -> named_struct('kind', '{k.name}', "
                            "'start', x.s, 'end', x.e, 'value', x.t, 'score', x.score))"))
    return df.select(*keep, F.concat(*parts).alias("findings"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, findings): array of (kind, start, end, value, score), by kind, then start.

    Positions count code points; ``end`` is exclusive.  Base kinds come first.
    """
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return _found(df, BASE_KINDS + ADDED_KINDS).select(F.col("id").alias(id_col), "findings")


def _listed(condition: str) -> Column:
    return F.expr(f"array_join(transform(filter(findings, x -> {condition}), "
                  "x -> concat(x.kind, ':', x.start, ':', x.`end`)), ',')")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    names = [k.name for k in BASE_KINDS]
    is_base = "x.kind IN ({})".format(", ".join(f"'{n}'" for n in names))
    found = find_pii(docs, id_col, text_col)
    return found.select(
        id_col,
        *[F.expr(f"cast(size(filter(findings, x -> x.kind = '{n}')) AS bigint)").alias(f"n_{n}")
          for n in names],
        F.sha2(_listed(is_base), 256).alias("base_sha256"), _listed("true").alias("spans"),
        F.expr(f"cast(size(filter(findings, x -> NOT {is_base})) AS bigint)").alias("n_added"))


def _masked(df: DataFrame, kinds: list[Kind]) -> DataFrame:
    """(row, t) with the union of the spans masked: spans that overlap become one mask,
    which names the kind of the first.

    Sorted by start, a span opens a mask if the largest end before it (``m``) is not
    beyond its start; ``m`` is then also where the previous mask ended.  The largest
    end and the cuts run in blocks like the positions of ``_spans``.
    """
    df = _found(df.select("row", "t"), kinds).select("row", "t", F.expr(
        "sort_array(transform(findings, (x, i) -> named_struct("
        "'s', x.start, 'i', i, 'e', x.`end`, 'k', x.kind)))").alias("l"))
    blocks = (f"CASE WHEN size({{0}}) = 0 THEN array({{0}}) ELSE transform(sequence("
              f"0, cast((size({{0}}) - 1) div {BLOCK} AS int)), "
              f"i -> slice({{0}}, i * {BLOCK} + 1, {BLOCK})) END")
    df = df.select("row", "t", "l", F.expr(blocks.format("l")).alias("b"))
    df = df.select("row", "t", "l", "b", F.expr(
        "aggregate(b, named_struct('p', 0, 'o', cast(array() AS array<int>)), (a, x) -> named_struct("
        "'p', greatest(a.p, aggregate(x, 0, (n, y) -> greatest(n, y.e))), "
        "'o', concat(a.o, array(a.p))), a -> a.o)").alias("o"))
    df = df.select("row", "t", "l", F.expr(
        "filter(flatten(zip_with(b, o, (x, o) -> aggregate(x, named_struct('p', o, "
        "'r', cast(array() AS array<struct<m:int,s:int,k:string>>)), (a, y) -> named_struct("
        "'p', greatest(a.p, y.e), 'r', concat(a.r, array(named_struct("
        "'m', a.p, 's', y.s, 'k', y.k)))), a -> a.r))), x -> x.s >= x.m)").alias("u"))
    df = df.select("row", "t", "l", F.expr(blocks.format("u")).alias("b"))
    df = df.select("row", "t", "l", F.expr(
        "CASE WHEN size(l) > 0 THEN transform(b, x -> named_struct('b', x, 'm', x[0].m, 'x', "
        "substring(t, x[0].m + 1, element_at(x, -1).s - x[0].m))) END").alias("b"))
    return df.select("row", F.expr(
        "CASE WHEN size(l) = 0 THEN t ELSE concat(array_join(flatten(transform(b, p -> transform("
        "p.b, y -> concat(substring(p.x, y.m - p.m + 1, y.s - y.m), '<', upper(y.k), '>')))), ''), "
        "substring(t, array_max(transform(l, x -> x.e)) + 1)) END").alias("t"))


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with every span of ``find_pii`` replaced by ``<KIND>``.

    No character of a span stays: overlapping spans become one mask.  A mask can cut a
    longer match that failed its check, and what is left of that may pass, so the kinds
    are then searched once more in the masked text, one after another.  Null texts stay
    null; all other columns are unchanged.
    """
    columns = docs.columns
    out = carried(docs, t=F.coalesce(F.col(quoted(text_col)), F.lit("")))
    out = _masked(out, BASE_KINDS + ADDED_KINDS)
    for k in BASE_KINDS + ADDED_KINDS:
        out = _masked(out, [k])
    return out.select(*[
        F.when(F.col(f"row.{quoted(c)}").isNull(), F.lit(None)).otherwise(F.col("t")).alias(c)
        if c == text_col else F.col(f"row.{quoted(c)}").alias(c) for c in columns])
