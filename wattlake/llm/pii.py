"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Offsets are code points, end exclusive. Spans of one kind never overlap; spans of different kinds may.

- Base kinds (email, ip, card, phone) are reported whenever their pattern and checks hold.
- Further kinds (iban by mod-97, ssn) are reported when their score, after the words nearby, reaches ``THRESHOLD``.
- A null or empty text has no spans. Ids, repeated rows and other columns play no part. Scans are linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wattlake.llm.common import batches_of, id_and_text, rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
THRESHOLD = 0.6
#: Characters on either side that are searched for words that speak for or against a kind.
NEAR = 48
FOR = {
    "email": {"mail", "email", "e-mail", "contact", "kontakt", "correo", "courriel"},
    "ip": {"ip", "host", "address", "server", "login", "adresse"},
    "card": {"card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte", "payment"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"},
    "iban": {"iban", "bank", "account", "konto", "cuenta", "compte"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
}
AGAINST = {"order", "invoice", "isbn", "version", "serial", "sku", "part", "ticket"}

#: A domain; the local part is read backwards from the @, so no start is tried twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
#: No start inside a run of digits: it would meet the same end as the run's first digit.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country; where a country is not named here, any length from 15 to 34 may be meant.
_IBAN_LENGTH = {
    country: n for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items() for country in countries.split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_][\w-]*")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Of every start the longest end before a space, or the match's own, that has the country's length and checks."""
    at = 0
    while m := _IBAN.search(text, at):
        start, end = m.span()
        at = start + 1
        while end > start:
            plain = text[start:end].replace(" ", "")
            if 15 <= len(plain) <= 34 and _IBAN_LENGTH.get(plain[:2], len(plain)) == len(plain) and mod97(plain):
                yield start, end
                at = end
                break
            end = text.rfind(" ", start, end)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _proposed(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Spans whose checks hold, with the score before the words nearby."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end, 0.9
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_octet, m.group().split("."))):
                yield "ip", m.start(), m.end(), 0.7
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start():
                digits = _NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    yield "card", m.start(), m.end(), 0.8
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                yield "phone", m.start(), m.end(), 0.7
        for start, end in _ibans(text):
            yield "iban", start, end, 0.8
        for m in _SSN.finditer(text):
            area, group, serial = m.group().split("-")
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                yield "ssn", m.start(), m.end(), 0.4


def find(text: str) -> list[Span]:
    """(kind, start, end, score) by start, then kind."""
    found = []
    for kind, start, end, score in _proposed(text):
        near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()
        words = set(_WORD.findall(near))
        score += 0.25 * bool(words & FOR[kind]) - 0.25 * bool(words & AGAINST)
        if kind in BASE or score >= THRESHOLD:
            found.append((kind, start, end, round(min(1.0, max(0.0, score)), 2)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each stretch of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans array<struct<kind, start, end, score>>, masked_text."""
    schema = pa.schema([("doc_id", pa.int64()), ("spans", _SPANS), ("masked_text", pa.string())])

    def run(batches):
        def made():
            for doc_id, text in rows(batches, "doc_id", "text"):
                spans = find(text)
                yield doc_id, [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans], masked(text, spans)

        return batches_of(made(), schema, 256)

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>, masked_text string")


def digest(docs: DataFrame) -> DataFrame:
    """Counts and joined spans of every document."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches):
        def made():
            for doc_id, spans in rows(batches, "doc_id", "spans"):
                spans = [(s["kind"], s["start"], s["end"], s["score"]) for s in spans]
                base = [s for s in spans if s[0] in BASE]
                counts = [sum(s[0] == k for s in base) for k in BASE]
                yield doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)

        return batches_of(made(), schema)

    return detect(docs).select("doc_id", "spans").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with masked texts; null texts stay null, other columns stay as they are."""
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [t if t is None else masked(t, find(t)) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(texts, type=part.schema.field(at).type))

    return docs.mapInArrow(run, schema)
