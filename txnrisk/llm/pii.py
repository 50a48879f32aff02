"""Personal data: patterns propose spans, checks confirm them, nearby words adjust the score.

Each kind has a pattern, a validator and context words.  A proposal that fails its validator is
dropped, and the search goes on behind it.  Offsets count code points, the end is exclusive.
Per kind, spans are leftmost and do not overlap; spans of different kinds may.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are kept whenever their validator passes, whatever
their score.  Further kinds (``iban`` with its mod-97 check, ``ssn``, ``secret``) are kept from ``MIN_SCORE`` on, so that
a bare number pattern needs a word such as "social security" close by.

A null text counts as empty: no spans.  Other columns are untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.5
CONTEXT_CHARS = 48
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
SPAN = "struct<kind:string,start:int,end:int,base:boolean,checked:string,score:double>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_END = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match starts at the start of a run of digits or nowhere in that run, hence the look-behind;
# possessive repeats keep the scan linear on very long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?i:\b(?:api[_-]?key|access[_-]?key|secret|token|password|passwd))\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_-]{16,}+)")
_DIGIT = re.compile("[0-9]")

# IBAN lengths by country, all of the registry.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22,
    "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30,
    "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20,
    "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
# Score of a checked proposal without context, and the words that raise it.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.6, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "secret": 0.7}
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|kontakt|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|login|client)\b", re.I),
    "card": re.compile(r"\b(?:card|credit|debit|visa|mastercard|amex|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|t[ée]l[ée]phone|tel[ée]fono)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security)\b", re.I),
    "secret": re.compile(r"\b(?:auth|bearer|credential|key|login)\b", re.I),
}
# Words that speak against a number being personal.
AGAINST = re.compile(r"\b(?:version|isbn|issn|order|invoice|serial)\b", re.I)


def luhn(digits: str) -> bool:
    """Luhn checksum: every second digit from the right counts double, its two digits summed."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an IBAN without spaces: moved to the front and read in base 36, it leaves 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int, str]]:
    behind, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL_END.match(text, at) if start < at else None
        behind = found.end() if found else at + 1
        if found:
            yield start, behind, "pattern"
        at = text.find("@", behind)


def _ips(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.start(), m.end(), "range"


def _cards(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), "luhn"


def _phones(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.start(), m.end(), "length"


def _ibans(text: str) -> Iterator[tuple[int, int, str]]:
    behind = 0
    for m in _IBAN_HEAD.finditer(text):
        need = IBAN_LENGTH.get(m[0][:2])
        if need is None or m.start() < behind:
            continue
        taken, at = [], m.start()
        while at < len(text) and len(taken) < need:
            c = text[at]
            if c.isascii() and (c.isdigit() or "A" <= c <= "Z"):
                taken.append(c)
            elif not (c == " " and text[at - 1] != " "):
                break
            at += 1
        if len(taken) == need and not (at < len(text) and text[at].isalnum()) and mod97("".join(taken)):
            behind = at
            yield m.start(), at, "mod97"


def _ssns(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.start(), m.end(), "range"


def _secrets(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SECRET.finditer(text):
        if _DIGIT.search(m[1]):
            yield m.start(1), m.end(1), "pattern"


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, raised by a context word and lowered by a contrary one within ``CONTEXT_CHARS``."""
    near = f"{text[max(0, start - CONTEXT_CHARS):start]} | {text[end:end + CONTEXT_CHARS]}"
    value = PRIOR[kind] + (0.3 if CONTEXT[kind].search(near) else 0.0) - (0.2 if AGAINST.search(near) else 0.0)
    return round(min(1.0, max(0.0, value)), 3)


def find_spans(text: str | None, min_score: float = MIN_SCORE) -> list[dict]:
    """All kept spans of one text, by start and then kind as listed in ``KINDS``."""
    text, found = text or "", []
    sources = [("email", _emails)] if "@" in text else []
    if _DIGIT.search(text):
        sources += [("ip", _ips), ("card", _cards), ("iban", _ibans), ("ssn", _ssns), ("secret", _secrets)]
        sources += [("phone", _phones)] if "+" in text else []
    for kind, propose in sources:
        for start, end, check in propose(text):
            points = score(text, kind, start, end)
            if kind in BASE_KINDS or points >= min_score:
                found.append({"kind": kind, "start": start, "end": end, "base": kind in BASE_KINDS, "checked": check, "score": points})
    return sorted(found, key=lambda s: (s["start"], KINDS.index(s["kind"])))


_SPAN_TYPE = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("checked", pa.string()), ("score", pa.float64()),
]))


def spans(text: Column, min_score: float = MIN_SCORE) -> Column:
    """Array of spans of a text column, one Arrow batch at a time."""
    @F.arrow_udf(f"array<{SPAN}>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([find_spans(t.as_py(), min_score) for t in texts], type=_SPAN_TYPE)

    return run(text)


def redact(text: str | None, found: list[dict] | None) -> str | None:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    if not text or not found:
        return text
    out, behind = [], 0
    for s in found:
        if s["start"] >= behind:
            out += [text[behind:s["start"]], f"[{s['kind'].upper()}]"]
        behind = max(behind, s["end"])
    return "".join([*out, text[behind:]])


def redacted(text: Column, min_score: float = MIN_SCORE) -> Column:
    """The text column with its spans replaced; null stays null."""
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([redact(t.as_py(), find_spans(t.as_py(), min_score)) for t in texts], type=pa.string())

    return run(text)


def detect(df: DataFrame, text: str = "text", into: str = "pii_spans", min_score: float = MIN_SCORE) -> DataFrame:
    """``df`` with the array of spans of ``text`` as column ``into`` (an existing column of that name is replaced)."""
    return df.withColumn(into, spans(F.col(text), min_score))


def digest(found: Column) -> dict[str, Column]:
    """Counts per base kind and the joined spans of a span array."""
    def joined(x: Column) -> Column:
        return F.concat_ws(",", F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{k}": count(k) for k in BASE_KINDS}
    base = joined(F.filter(found, lambda s: s["base"]))
    return {**counts, "base_sha256": F.sha2(base.cast("binary"), 256), "spans": joined(found)}
