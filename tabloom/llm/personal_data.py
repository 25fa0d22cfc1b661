"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

The base kinds (email, ip, card, phone) are fixed patterns with a check each; a match that fails
its check is dropped and the search goes on behind it. They always stand. The further kinds need
a score of at least ``ACCEPT``: a pattern gives some of it, a valid checksum or structure more, a
fitting word close by the rest, and a word that explains the digits otherwise takes some away. A
further span never overlaps a base span or one found before it.

All of it happens row by row in Arrow batches; texts without digits or @ are not looked at.

Defined results: a null or empty text has no spans and masks to itself. Texts are searched whole,
whatever their length: the patterns start at the first character of a run and never go back into
one, and a span is looked up among those taken by halving, so that time grows in proportion, however many
spans a text has and however long its runs of digits are. An account number is as long as its country's are,
whatever stands behind it. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ship

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "short_card", "local_phone")
ACCEPT = 0.6

_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)
_DDL = "array<struct<kind:string,start:int,end:int,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?=\x20?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")

# How long an IBAN is in each country that has registered one.
_IBAN_LENGTHS = {
    entry[:2]: int(entry[2:])
    for entry in """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18
    FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20
    LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18
    SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20
    """.split()
}
_IBAN_SHORTEST, _IBAN_LONGEST = 15, 34

# Words that make a kind likelier, and words that say a number is something else.
_FOR = {
    "iban": "iban bic account bank konto compte cuenta banque banco",
    "ssn": "ssn social security tax id",
    "short_card": "card credit debit visa karte carte tarjeta",
    "local_phone": "phone tel telephone call mobile fax cell telefon telefono téléphone teléfono",
}
_AGAINST = "version isbn issn order invoice page figure table section serial"
_BEFORE, _AFTER = 48, 24
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run of characters before it and a domain behind it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _matches(pattern: re.Pattern, check: Callable[[str], bool]) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text) if check(m.group()))


def _byte(digits: str) -> bool:
    """At most 255, however many zeros come first."""
    value = digits.lstrip("0") or "0"
    return len(value) <= 3 and int(value) <= 255


_BASE: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails,
    "ip": _matches(_IP, lambda s: all(_byte(p) for p in s.split("."))),
    "card": _matches(_CARD, lambda s: 14 <= len(d := _digits(s)) <= 19 and luhn(d)),
    "phone": _matches(_PHONE, lambda s: 10 <= len(_digits(s)) <= 15),
}


def _structure(parts: tuple[str, ...]) -> bool:
    area, group, serial = parts
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@cache
def _iban_rest(length: int) -> re.Pattern:
    """What follows the first four characters, up to the end of a word."""
    return re.compile(rf"(?:\x20?[A-Z0-9]){{{length - 4}}}(?![A-Za-z0-9])")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers of their country's length, or of any length where a country has none registered."""
    for m in _IBAN.finditer(text):
        known = _IBAN_LENGTHS.get(m[1])
        for length in (known,) if known else range(_IBAN_LONGEST, _IBAN_SHORTEST - 1, -1):
            rest = _iban_rest(length).match(text, m.end())
            if rest and mod97(text[m.start() : rest.end()].replace(" ", "")):
                yield m.start(), rest.end()
                break


class _Taken:
    """Places that are taken: lists of spans that do not overlap, each in order."""

    def __init__(self, spans: list[tuple[int, int]]):
        merged: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if merged and start < merged[-1][1]:
                start, last = merged.pop()
                end = max(end, last)
            merged.append((start, end))
        self.lists = {"": merged}

    def free(self, start: int, end: int) -> bool:
        for spans in self.lists.values():
            before = bisect_left(spans, (end, -1)) - 1  # the last to start before the end
            if before >= 0 and spans[before][1] > start:
                return False
        return True

    def add(self, kind: str, start: int, end: int) -> None:
        """Spans of a kind come in order."""
        self.lists.setdefault(kind, []).append((start, end))


def _proposals(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Spans of the further kinds with what pattern and checksum alone are worth."""
    for span in _ibans(text):
        yield "iban", *span, 0.8
    for m in _SSN.finditer(text):
        if _structure(m.groups()):
            yield "ssn", *m.span(), 0.4
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m.group())) <= 13 and luhn(d):
            yield "short_card", *m.span(), 0.4
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m.group())) <= 12:
            yield "local_phone", *m.span(), 0.3


def _context(text: str, kind: str, start: int, end: int) -> float:
    near = set(_WORD.findall(f"{text[max(0, start - _BEFORE) : start]} {text[end : end + _AFTER]}".lower()))
    return 0.4 * (not near.isdisjoint(_FOR[kind].split())) - 0.3 * (not near.isdisjoint(_AGAINST.split()))


def find(text: str) -> list[Span]:
    """All spans of a text, by start and then in the order of KINDS."""
    found = [Span(kind, *span, 1.0) for kind, search in _BASE.items() for span in search(text)]
    taken = _Taken([(s.start, s.end) for s in found])
    for kind, start, end, score in _proposals(text):
        score = min(1.0, score + _context(text, kind, start, end))
        if score >= ACCEPT and taken.free(start, end):
            found.append(Span(kind, start, end, score))
            taken.add(kind, start, end)
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of spans that overlap, replaced by the name of its first kind."""
    parts, end = [], 0
    for s in spans:
        if s.start >= end:
            parts += [text[end : s.start], f"[{s.kind.upper()}]"]
        end = max(end, s.end)
    return "".join([*parts, text[end:]])


def _suspects(texts: pa.Array) -> Iterator[tuple[int, str]]:
    """The place and text of the rows that can hold anything."""
    rows = pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False))
    return ((i, texts[i].as_py()) for i in rows.to_pylist())


def _find_batch(texts: pa.Array) -> pa.Array:
    found: list[list] = [[] for _ in range(len(texts))]
    for i, text in _suspects(texts):
        found[i] = [s._asdict() for s in find(text)]
    return pa.array(found, _TYPE)


def _mask_batch(texts: pa.Array) -> pa.Array:
    changed = {i: mask(text, spans) for i, text in _suspects(texts) if (spans := find(text))}
    if not changed:
        return texts
    return pa.array([changed.get(i, t) for i, t in enumerate(texts.to_pylist())], pa.string())


def spans_of(text: Column | str) -> Column:
    """The spans of a text as an array of (kind, start, end, score)."""
    return F.arrow_udf(_find_batch, _DDL)(text)


def find_personal_data(documents: DataFrame, out: str = "spans", text: str = "text") -> DataFrame:
    """Add the spans found in each document's text."""
    ship(documents.sparkSession)
    return documents.withColumn(out, spans_of(text))


def masked(documents: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by the name of its kind; ``length`` follows the text."""
    ship(documents.sparkSession)
    df = documents.withColumn(text, F.arrow_udf(_mask_batch, "string")(text))
    if length is None or length not in documents.columns:
        return df
    kind = documents.schema[length].dataType
    return df.withColumn(length, F.coalesce(F.length(text).cast(kind), F.col(length)))
