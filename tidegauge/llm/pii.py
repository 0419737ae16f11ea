"""Personal data in text: patterns propose spans, checks confirm them, nearby words adjust the score.

All of it is column expressions on one row, so it needs no shuffle and no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import text_or_empty
from tidegauge.llm.marks import let, matches, part, pieces, running, unmarked

CONTEXT = 48  # code points before a span in which a context word counts
LEAST_SCORE = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octets(value: Column) -> Column:
    def fits(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+", "")
        return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, "\\."), fits)


def luhn(digits: Column) -> Column:
    """Whether the last digit is the Luhn check digit of the others."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _card(value: Column) -> Column:
    return luhn(_digits(value))


def _phone(value: Column) -> Column:
    return F.length(_digits(value)).between(10, 15)


def mod97(value: Column) -> Column:
    """Whether an account number, country first, leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _ssn(value: Column) -> Column:
    return ~value.rlike("^(?:000|666|9)|-00-|0000$")


# Length of an account number by country: the registry's, then those in use without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST AO CV GW MZ", 26: "IS TR DZ IR", 27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """An account number of exactly its country's length, so that no word after it is taken in."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(forms)})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``gate`` is a literal that every match holds; None asks the pattern alone."""

    name: str
    pattern: str
    check: object
    words: str
    score: float = LEAST_SCORE
    gate: str | None = None


# The base kinds' patterns accept what the given ones accept. Possessive loops and the
# look-behinds only forbid starts inside a run at which the given patterns fail as well, so that
# long runs of letters or digits take linear time.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None,
         r"(?i)\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b", 0.8, "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets,
         r"(?i)\b(?:ip|host|server|address|login|adresse|direcci.n)\b", 0.6),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", _card,
         r"(?i)\b(?:card|visa|credit|debit|payment|karte|carte|tarjeta)\b", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone,
         r"(?i)\b(?:phone|call|tel|mobile|fax|telefon|t.l.phone|tel.fono)\b", 0.6, "+"),
    Kind("iban", _iban(), mod97,
         r"(?i)\b(?:iban|bank|account|konto|compte|cuenta)\b", 0.7),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", _ssn,
         r"(?i)\b(?:ssn|social|security|insurance)\b", 0.3),
)
BASE = ("email", "ip", "card", "phone")
_FOUND = "array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>"


def _found(text: Column, rank: int, kind: Kind) -> Column:
    """Confirmed spans of one kind with a score of at least ``LEAST_SCORE``; no other kind can lower it."""
    confirmed = matches(text, F.lit(kind.pattern))
    if kind.check is not None:
        confirmed = F.filter(confirmed, lambda m: kind.check(m.value))

    def scored(cut: Column, m: Column) -> Column:
        near = part(cut, F.greatest(m.start - CONTEXT, F.lit(0)), m.start)
        score = F.least(F.lit(1.0), kind.score + F.when(near.rlike(kind.words), 0.2).otherwise(0.0))
        return F.struct(
            m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end"), F.lit(kind.name).alias("kind"),
            m.value.alias("value"), score.alias("score"),
        )

    spans = let(pieces(text), lambda cut: F.transform(confirmed, lambda m: scored(cut, m)))
    if kind.score < LEAST_SCORE:
        spans = F.filter(spans, lambda s: s.score >= LEAST_SCORE)
    may = text.rlike(kind.pattern) if kind.gate is None else F.contains(text, F.lit(kind.gate)) & text.rlike(kind.pattern)
    return F.when(may, spans).otherwise(F.array()).cast(_FOUND)


def spans(text: Column) -> Column:
    """All spans of a text by start, then kind: array of (start, rank, end, kind, value, score).

    Positions count code points from 0, the end is exclusive. A null text is empty.
    """
    clean = unmarked(text)
    return F.array_sort(F.concat(*[_found(clean, rank, kind) for rank, kind in enumerate(KINDS)]))


def find(docs: DataFrame) -> DataFrame:
    """One row (doc_id, found) per document row, ``found`` as ``spans`` gives it; null and empty texts have none.

    Repeated rows give repeated rows, an empty table none; other columns are not read.
    """
    return docs.select("doc_id", spans(text_or_empty()).alias("found"))


def of_kind(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda s: s.kind.isin(*kinds))


def as_text(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans give the first one's.

    Null texts stay null; all rows, repeated ones too, and columns stay, whatever their names; an empty table gives no rows.
    """
    text, found = F.col("__row.text"), F.col("__found")

    def whole(found: Column, cut: Column, done: Column) -> Column:
        # ``done`` is the furthest end up to each span; a span that starts before the one so far is overlapped
        before = lambda i: F.when(i > 0, F.get(done, i - 1)).otherwise(0)
        fresh = F.transform(found, lambda s, i: F.when(
            s.start >= before(i), F.concat(part(cut, before(i), s.start), F.lit("["), F.upper(s.kind), F.lit("]"))
        ).otherwise(""))
        return F.concat(F.array_join(fresh, ""), part(cut, F.element_at(done, -1), F.length(text)))

    ends = running(F.transform(found, lambda s: s.end), F.greatest)
    replaced = let(F.struct(found.alias("found"), pieces(text).alias("cut"), ends.alias("done")), lambda v: whole(v.found, v.cut, v.done))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), spans(text_or_empty()).alias("__found"))
    return rows.select(*[
        F.when(F.size(found) > 0, replaced).otherwise(text).alias(c) if c == "text" else F.col(f"__row.`{c}`")
        for c in docs.columns
    ])
