"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Kinds, in the order of the result: ``email``, ``ip`` (parts at most 255), ``card``
(13 to 19 digits, Luhn), ``phone`` (9 to 15 digits) - the base kinds, whose spans
always stay - and ``iban`` (ISO 13616, mod 97) and ``ssn`` (three-two-four digits),
which stay when their score reaches ``LEAST``.  The score of a span starts from
its kind, rises when a checksum confirms it and when one of the kind's words
stands in the ``CONTEXT`` characters before it.

Matches are leftmost and non-overlapping for each kind; a match that fails its
check is dropped and the search goes on behind it (``iban``: behind its first four
characters).  Every pattern is written so
that a run of characters is read a bounded number of times, whole texts of any
length included.

Defined cases: a NULL or empty text has no spans; offsets are code points, end
exclusive; repeated rows and ids give equal rows; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col, map_arrow, text_or_empty

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
#: Start of the score, and words that raise it.
KINDS = {
    "email": (0.8, ("mail", "contact", "write")),
    "ip": (0.5, ("ip", "address", "host", "server")),
    "card": (0.4, ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta")),
    "phone": (0.6, ("phone", "tel", "call", "mobile", "fax")),
    "iban": (0.3, ("iban", "bank", "account", "konto", "compte", "cuenta")),
    "ssn": (0.3, ("ssn", "social", "security")),
}
CHECKSUM_SCORE, CONTEXT_SCORE, LEAST, CONTEXT = 0.4, 0.3, 0.6, 40

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Lengths of ISO 13616 by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_OF = {c: re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){%d}%s(?![A-Za-z0-9])" % (
    (n - 4) // 4, r" ?[A-Z0-9]{%d}" % (n % 4) if n % 4 else ""))
    for n, codes in IBAN_LENGTHS.items() for c in codes.split()}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(
        str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the run of its characters before an ``@``, from the end of
    the match before; so the text around an ``@`` is all that is read."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done:  # blocks, so that a long run costs its length once
            block = text[max(done, start - 64):start]
            run = LOCAL.search(block)
            size = len(run[0]) if run else 0
            start -= size
            if size < len(block):
                break
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1  # no later local part can reach over this "@"
        at = text.find("@", done)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Each head is read to the length of its country (of no known one: as far as
    groups go), so that words behind it do not count as groups of it."""
    done = 0
    for head in IBAN_HEAD.finditer(text):
        if head.start() >= done:
            m = IBAN_OF.get(head[0][:2], IBAN).match(text, head.start())
            if m and mod97(m[0]):
                yield m.start(), m.end()
                done = m.end()


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a checksum)."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, False
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", m.start(), m.end(), False
    for start, end in ibans(text):
        yield "iban", start, end, True
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end(), False


def spans(text: str) -> list[dict]:
    """kind, start, end, score of the spans of one text, in the order of the result."""
    out = []
    for kind, start, end, confirmed in proposals(text):
        score, words = KINDS[kind]
        score += CHECKSUM_SCORE * confirmed
        before = text[max(0, start - CONTEXT):start].lower()
        score += CONTEXT_SCORE * any(re.search(rf"\b{w}", before) for w in words)
        if kind in BASE or score >= LEAST:
            out.append({"kind": kind, "start": start, "end": end, "score": round(min(score, 1.0), 3)})
    return out


def _slim(docs: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def find_pii(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, spans array<struct<kind, start, end, score>>."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [spans(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)],
                                             names=["doc_id", "spans"])

    rows, id_type = _slim(docs, text_col, id_col)
    return map_arrow(rows, run, f"doc_id {id_type}, spans array<struct<kind:string,start:int,end:int,"
                                "score:double>>")


def pii_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256,
    spans (``kind:start:end``, comma-joined)."""
    def run(batches):
        for b in batches:
            counts, digests, joined = {k: [] for k in BASE}, [], []
            for text in b.column("text").to_pylist():
                found = spans(text)
                written = [f"{s['kind']}:{s['start']}:{s['end']}" for s in found]
                base = ",".join(w for w, s in zip(written, found, strict=True) if s["kind"] in BASE)
                for k in BASE:
                    counts[k].append(sum(s["kind"] == k for s in found))
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                joined.append(",".join(written))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(counts[k], pa.int64()) for k in BASE],
                 pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])

    rows, id_type = _slim(docs, text_col, id_col)
    return map_arrow(rows, run, f"doc_id {id_type}, " + ", ".join(f"n_{k} long" for k in BASE)
                           + ", base_sha256 string, spans string")
