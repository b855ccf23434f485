"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a built-in expression on the row: nothing is shuffled. Positions come from
the lengths of what lies between the matches (``split``) and of the matches themselves
(``regexp_extract_all``), added up in chunks so that a text of very many matches stays
cheap. Patterns are written so that no text makes them backtrack far: runs are possessive
and start where no run is under way.

Defined results: a null text is the empty text and has no span; repeated rows get a row
each; an empty table gives no rows; columns beyond id and text are ignored by
:func:`report` and kept by :func:`redact`. Spans of one start are ordered by kind as
listed in ``KINDS``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Matches per inner fold.
CHUNK = 256
#: Characters before a span in which context words count.
NEAR = 40
#: What a context word adds to a kind that is told by its form.
CONTEXT_SCORE = 0.1
#: What it adds to a kind whose form says little: without one such a span isn't reported.
DECIDING = 0.4

# Characters of an account number by country, from the public registry.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FO FI GL NL SD FK",
    19: "MK SI",
    20: "AT BA EE KZ XK LT LU MN",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ MD PK RO SA SE SK ES TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban_pattern() -> str:
    """Compact, or in groups of four set apart by single spaces; a match ends where its country's number ends."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        n = length - 4
        grouped = f"(?: [A-Z0-9]{{4}}){{{n // 4}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        forms.append(f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?:[A-Z0-9]{{{n}}}|{grouped})")
    return f"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``has`` is a cheap test of the text ``t`` that must hold if there are matches; ``check``
    confirms the match ``s.m``. Kinds of the base come first.
    """

    name: str
    pattern: str
    has: str
    check: str
    score: float
    context: str
    base: bool = True
    boost: float = CONTEXT_SCORE


LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + element_at(if(i % 2 = 0, array(0,2,4,6,8,1,3,5,7,9),"
    " array(0,1,2,3,4,5,6,7,8,9)), cast(substring(reverse({d}), i, 1) as int) + 1)) % 10 = 0"
).format(d="translate(s.m, ' -', '')")
#: Letters count 10 to 35; the first four characters go last.
MOD97 = (
    "aggregate(split(concat(substring({d}, 5), substring({d}, 1, 4)), ''), 0, (a, c) ->"
    " if(c = '', a, if(c >= 'A', (a * 100 + ascii(c) - 55) % 97, (a * 10 + ascii(c) - 48) % 97))) = 1"
).format(d="translate(s.m, ' ', '')")
PHONE_DIGITS = "length(regexp_replace(s.m, '[^0-9]', '')) between 10 and 15"
OCTETS = r"s.m rlike '^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$'"

KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "instr(t, '@') > 0",
        "true",
        0.9,
        "(?i)(e-?mail|contact|kontakt|correo|courriel)",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "instr(t, '.') > 0",
        OCTETS,
        0.6,
        r"(?i)(\bip\b|address|host|server)",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])(?=(?:[ -]?[0-9]){14,19}(?![ -]?[0-9]))[0-9](?:[ -]?[0-9])++",
        "t rlike '[0-9]'",
        LUHN,
        0.8,
        r"(?i)(card|visa|karte|tarjeta|carte|credit)",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        "instr(t, '+') > 0",
        PHONE_DIGITS,
        0.7,
        r"(?i)(phone|tel|call|mobil|fax)",
    ),
    Kind(
        "iban",
        _iban_pattern(),
        "t rlike '[A-Z][A-Z][0-9][0-9]'",
        MOD97,
        0.9,
        r"(?i)(iban|account|konto|bank|cuenta|compte)",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "instr(t, '-') > 0",
        "not s.m rlike '^(000|666|9)|-00-|-0000$'",
        0.5,
        r"(?i)((?<![a-z])ssn(?![a-z])|social security)",
        base=False,
        boost=DECIDING,
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{32,}+",
        "t rlike '[A-Za-z0-9_-]{32}'",
        "s.m rlike '[0-9]' and s.m rlike '[A-Za-z]'",
        0.5,
        r"(?i)(token|secret|passw|api.?key|credential)",
        base=False,
        boost=DECIDING,
    ),
]
SPAN = "struct<start: int, place: int, end: int, kind: string, score: double>"


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind_spans(kind: Kind, place: int) -> str:
    """SQL for the confirmed spans of a kind in the text ``t``."""
    pattern = _sql_text(kind.pattern)
    one = (
        "named_struct('at', b.at + g.gap + length(g.m), 'out', concat(b.out, array(named_struct("
        "'start', b.at + g.gap, 'end', b.at + g.gap + length(g.m), 'm', g.m))))"
    )
    empty = "cast(array() as array<struct<start: int, end: int, m: string>>)"
    inner = (
        f"aggregate(slice(x, c * {CHUNK} + 1, {CHUNK}), named_struct('at', a.at, 'out', {empty}), (b, g) -> {one})"
    )
    joined = f"transform(array({inner}), r -> named_struct('at', r.at, 'out', concat(a.out, r.out)))[0]"
    placed = (
        f"transform(array(zip_with(regexp_extract_all(t, {pattern}, 0), transform(split(t, {pattern}, -1), s -> length(s)),"
        " (m, gap) -> named_struct('m', m, 'gap', gap))), y -> filter(y, g -> g.m is not null))[0]"
    )
    all_spans = (
        f"transform(array({placed}), x -> if(size(x) = 0, {empty}, aggregate(sequence(0, (size(x) - 1) div {CHUNK}),"
        f" named_struct('at', 0, 'out', {empty}), (a, c) -> {joined}, a -> a.out)))[0]"
    )
    near = f"substring(t, greatest(s.start - {NEAR - 1}, 1), least(s.start, {NEAR}))"
    scored = (
        f"transform(filter({all_spans}, s -> {kind.check}), s -> named_struct('start', s.start, 'place', {place}, 'end', s.end,"
        f" 'kind', '{kind.name}', 'score', {kind.score}D + if({near} rlike {_sql_text(kind.context)}, {kind.boost}D, 0D)))"
    )
    return f"if({kind.has}, {scored}, cast(array() as array<{SPAN}>))"


def with_spans(docs: DataFrame, min_score: float = 0.8, text: str = "text") -> DataFrame:
    """``docs`` and ``__spans``: structs of start, place, end (exclusive, code points), kind and score.

    Kinds of the base stay at any score; others need ``min_score``, which account numbers reach
    by their checksum and the forms that say little (``ssn``, ``secret``) by a context word.
    """
    found = docs.withColumn("t", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    kept = [
        kind_spans(k, i) if k.base else f"filter({kind_spans(k, i)}, s -> s.score >= {min_score}D)"
        for i, k in enumerate(KINDS)
    ]
    return found.withColumn("__spans", F.expr(f"array_sort(concat({', '.join(kept)}))"))


def _listed(condition: str) -> Column:
    chosen = f"transform(filter(__spans, s -> {condition}), s -> concat_ws(':', s.kind, s.start, s.end))"
    return F.array_join(F.expr(chosen), ",")


def report(docs: DataFrame, min_score: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: spans of each base kind counted, the digest of the base list, all spans, their scores and number."""
    found = with_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), min_score)
    base = [i for i, k in enumerate(KINDS) if k.base]
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(__spans, s -> s.place = {i})) as bigint)").alias(f"n_{KINDS[i].name}") for i in base],
        F.sha2(_listed(f"s.place <= {base[-1]}").cast("binary"), 256).alias("base_sha256"),
        _listed("true").alias("spans"),
        F.expr("array_join(transform(__spans, s -> format_number(s.score, 1)), ',')").alias("scores"),
        F.size("__spans").cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, min_score: float = 0.8, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first counts."""
    found = with_spans(docs, min_score, text)
    start = "named_struct('at', 0, 'out', cast(array() as array<string>))"
    step = (
        "if(s.start < a.at, a, named_struct('at', s.end, 'out', concat(a.out,"
        " array(substring(t, a.at + 1, s.start - a.at), concat('[', upper(s.kind), ']')))))"
    )
    rest = "concat(array_join(a.out, ''), substring(t, a.at + 1, length(t)))"
    redacted = F.expr(f"aggregate(__spans, {start}, (a, s) -> {step}, a -> {rest})")
    replaced = F.when(F.size("__spans") > 0, redacted).otherwise(F.col(f"`{text}`"))
    return found.withColumn(text, replaced).select(*[F.col(f"`{c}`") for c in docs.columns])
