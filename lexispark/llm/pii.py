"""Personal data in SQL functions alone: patterns propose spans, checksums confirm them, words nearby move the score.

Positions come from ``split``: the lengths of the pieces between matches and of the matches themselves, added up, are
the code point offsets.  A pattern runs only on texts that hold a character it needs.  Every pattern is written so
that its time is linear in the text: quantifiers are possessive, and a match begins where a run of its first class
begins (or where the last match ended), since from inside a run it could only fail again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, a cheap test that must hold, what confirms it, and context words."""

    name: str
    pattern: str
    needs: str
    confirms: str  # SQL over x.m, the matched text
    context: str  # words nearby that raise the score
    score: float  # without them
    least: float = 0.0  # spans with a lower score are dropped


DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
#: Luhn: from the right every second digit counts double, with 9 taken off above 9.
LUHN = (
    "aggregate(sequence(1, length(d)), 0, (s, i) -> s + "
    "case when i % 2 = 1 then int(substr(d, length(d) - i + 1, 1)) "
    "when int(substr(d, length(d) - i + 1, 1)) > 4 then 2 * int(substr(d, length(d) - i + 1, 1)) - 9 "
    "else 2 * int(substr(d, length(d) - i + 1, 1)) end) % 10 = 0"
)
#: Mod 97: the first four characters go to the end, letters count from 10; the remainder must be 1.
MOD97 = (
    "aggregate(split(substr(d, 5) || substr(d, 1, 4), ''), 0, (s, c) -> case when c = '' then s "
    "when c between '0' and '9' then (s * 10 + int(c)) % 97 else (s * 100 + ascii(c) - 55) % 97 end) = 1"
)


def _over(expression: str, digits: str) -> str:
    """``expression`` with ``d`` bound to ``digits``."""
    return f"exists(array({digits}), d -> {expression})"


# The first four are fixed by contract; the method adds the others.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "true", "mail|contact|write|schreib|correo|courriel", 0.9),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", "forall(split(x.m, '[.]'), p -> length(ltrim('0', p)) < 3 or (length(ltrim('0', p)) = 3 and ltrim('0', p) <= '255'))", "ip|host|server|address|login", 0.6),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "", f"length({DIGITS}) between 13 and 19 and " + _over(LUHN, DIGITS), "card|visa|credit|amex|karte|tarjeta|carte", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", f"length({DIGITS}) between 9 and 15", "phone|tel|call|mobile|fax|anruf|llame", 0.7),
)
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "", "length(replace(x.m, ' ', '')) between 15 and 34 and " + _over(MOD97, "replace(x.m, ' ', '')"), "iban|account|bank|konto|cuenta|compte", 0.9),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "-", "true", "ssn|social|security", 0.4, 0.4),
    Kind("localphone", r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "", "true", "phone|tel|call|mobile|fax|anruf|llame", 0.3, 0.5),
)
KINDS = BASE + ADDED
NEARBY = 40
CONTEXT_ADDS = 0.25


def _expressions(kind: Kind) -> str:
    """Array of spans from the columns ``_found`` (matches) and ``_gaps`` (lengths between them) of a kind.

    One pass adds up the position and keeps what is confirmed; a match that fails is passed over, not retried.
    """
    kept = "cast(array() as array<struct<kind:string,start:int,stop:int,text:string,score:double>>)"
    near = "lower(substr(_text, greatest(y.start - {n} + 1, 1), least(y.start, {n})))".format(n=NEARBY)
    spoken = f"case when rlike({near}, '(^|[^a-z])({kind.context})') then {CONTEXT_ADDS}D else 0D end"
    span = f"struct('{kind.name}' as kind, s.at + x.g as start, s.at + x.g + length(x.m) as stop, x.m as text, {kind.score}D as score)"
    step = f"struct(s.at + x.g + length(x.m) as at, case when {kind.confirms} then concat(s.kept, array({span})) else s.kept end as kept)"
    walk = (
        f"aggregate(zip_with(_found_{kind.name}, slice(_gaps_{kind.name}, 1, size(_found_{kind.name})), (m, g) -> struct(m as m, g as g)), "
        f"struct(0 as at, {kept} as kept), (s, x) -> {step}, s -> s.kept)"
    )
    scored = f"transform({walk}, y -> struct(y.kind as kind, y.start as start, y.stop as stop, y.text as text, least(y.score + {spoken}, 1D) as score))"
    return f"filter({scored}, y -> y.score >= {kind.least}D)" if kind.least else scored


def find_spans(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with a column ``spans``: array of (kind, start, stop, text, score), by kind as listed, then start.

    Offsets are code points from 0, the end exclusive.  Null text counts as empty and has no spans.  All other columns
    stay; those named ``spans`` or beginning with an underscore and a name used here are replaced.
    """
    kept = [c for c in docs.columns if c != "spans"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(*(F.col(f"`{c}`") for c in kept), text.alias("_text")).withColumn("_digits", F.col("_text").rlike("[0-9]"))
    matches, gaps = {}, {}
    for k in kinds:
        needed = F.lit(True) if k.name == "email" else F.col("_digits")
        if k.needs:
            needed = needed & F.contains("_text", F.lit(k.needs))
        matches[f"_found_{k.name}"] = F.when(needed, F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        some = F.size(f"_found_{k.name}") > 0
        gaps[f"_gaps_{k.name}"] = F.when(some, F.transform(F.split("_text", k.pattern, -1), F.length)).otherwise(F.array().cast("array<int>"))
    found = found.withColumns(matches).withColumns(gaps)
    found = found.withColumns({f"_spans_{k.name}": F.expr(_expressions(k)) for k in kinds})
    return found.select(*(F.col(f"`{c}`") for c in kept), F.concat(*(F.col(f"_spans_{k.name}") for k in kinds)).alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> s.kind || ':' || s.start || ':' || s.stop), ',')")


def redact(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with each span of personal data in ``text_col`` replaced by its kind in brackets.

    Spans that overlap are replaced together, under the name of the first.  Texts without spans, null ones too, stay
    as they are.
    """
    marked = find_spans(docs, text_col, kinds)
    name = f"`{text_col}`"
    order = "array_sort(spans, (x, y) -> case when x.start <> y.start then x.start - y.start else y.stop - x.stop end)"
    step = (
        f"case when y.start >= s.at then struct(y.stop as at, concat(s.parts, array(substr({name}, s.at + 1, y.start - s.at), "
        "'[' || upper(y.kind) || ']')) as parts) else struct(greatest(s.at, y.stop) as at, s.parts as parts) end"
    )
    built = (
        f"aggregate({order}, struct(0 as at, cast(array() as array<string>) as parts), (s, y) -> {step}, "
        f"s -> array_join(s.parts, '') || substr({name}, s.at + 1))"
    )
    text = F.expr(f"case when size(spans) > 0 then {built} else {name} end")
    return marked.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "spans"))
