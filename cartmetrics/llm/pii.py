"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

All scans are linear in the length of the text, however long its runs of digits or letters are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import chunks

#: The kinds of the contract, in order, then the kinds that the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "local_phone")
SPAN_SCHEMA = "array<struct<kind: string, start: int, end: int, score: double>>"
#: A span counts from this score on.
THRESHOLD = 0.6

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_GROUPS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    c: n
    for n, names in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in names.split()
}
#: Context words by kind, looked for within CONTEXT characters before a span and half as many after it.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": re.compile(r"\b(?:e-?mail|contact|write|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|login)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|credit|payment|tarjeta|carte|karte)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|teléfono|téléphone)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)\b", re.I),
    "national_id": re.compile(r"\b(?:ssn|social security|tax id|national id)\b", re.I),
    "local_phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|teléfono|téléphone)\b", re.I),
}
#: Score of a proposed span; confirmed by a validator; added by a context word.
PROPOSED = {"email": 0.8, "ip": 0.7, "card": 0.3, "phone": 0.7, "iban": 0.3, "national_id": 0.4, "local_phone": 0.4}
CONFIRMED, NEARBY = 0.4, 0.2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        groups = list(_GROUPS.finditer(text, run.start(), run.end()))
        for i in range(0, len(groups) - 3, 4):
            four = groups[i : i + 4]
            if all(len(g := x.group().lstrip("0")) < 4 and int(g or "0") <= 255 for x in four):
                yield four[0].start(), four[3].end()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def _iban_ends(run: str) -> list[int]:
    """Where an IBAN at the start of run can end: by its country's length, then with the run. Countries
    without a known length: after every word from 15 characters on, longest first."""
    ends = [i for i in range(len(run), 14, -1) if i == len(run) or run[i] == " "]
    if length := IBAN_LENGTHS.get(run[:2]):
        return [*(i for i in ends if len(run[:i].replace(" ", "")) == length), len(run)]
    return [i for i in ends if len(run[:i].replace(" ", "")) >= 15]


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _IBAN.search(text, at):
        end = next((i for i in _iban_ends(m.group()) if mod97(m.group()[:i])), 0)
        if end:
            yield m.start(), m.start() + end
        at = m.start() + max(end, 1)


def _national_ids(text: str) -> Iterator[tuple[int, int]]:
    for m in _NATIONAL.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    yield from (m.span() for m in _LOCAL_PHONE.finditer(text))


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = dict(
    zip(KINDS, (_emails, _ips, _cards, _phones, _ibans, _national_ids, _local_phones), strict=True)
)
VALIDATED = {"ip", "card", "iban"}
_DIGIT = re.compile(r"[0-9]")


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start. Spans of the base kinds always count; the others
    count from THRESHOLD on and where no base span is."""
    if not text:
        return []
    found: list[tuple[str, int, int, float]] = []
    digits = _DIGIT.search(text)
    for kind, finder in FINDERS.items():
        if not digits and kind != "email":
            continue
        for start, end in finder(text):
            score = PROPOSED[kind] + CONFIRMED * (kind in VALIDATED)
            near = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT // 2]
            score = min(1.0, score + NEARBY * bool(CONTEXT_WORDS[kind].search(near)))
            if kind in BASE_KINDS or score >= THRESHOLD and all(end <= s or e <= start for _, s, e, _ in found):
                found.append((kind, start, end, round(score, 3)))
    return found


def redact(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """text with every span replaced by its kind in angle brackets; overlapping spans by the first one's."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _digest(spans: list[tuple[str, int, int, float]]) -> tuple[list[int], str, str]:
    names = [f"{k}:{s}:{e}" for k, s, e, _ in spans]
    base = ",".join(n for n in names if n.split(":")[0] in BASE_KINDS)
    return [sum(s[0] == k for s in spans) for k in BASE_KINDS], hashlib.sha256(base.encode()).hexdigest(), ",".join(names)


def pii_spans(docs: DataFrame, redacted: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): counts by base kind, digest of the base spans, all spans
    as text and as structs with scores; with `redacted` also the text without them.

    Null and empty texts: no spans (the digest is that of the empty string). Offsets count code points.
    Rows are independent, so repeated rows and doc_ids are returned repeatedly. Other columns are ignored.
    """
    text_type = ", redacted string" if redacted else ""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, found {SPAN_SCHEMA}{text_type}"
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            texts = part.column("text").to_pylist()
            spans = [find_spans(t) for t in texts]
            digests = [_digest(s) for s in spans]
            columns = {"doc_id": part.column("doc_id").combine_chunks()}
            columns |= {f"n_{k}": pa.array([d[0][i] for d in digests], pa.int64()) for i, k in enumerate(BASE_KINDS)}
            columns |= {"base_sha256": pa.array([d[1] for d in digests], pa.string()), "spans": pa.array([d[2] for d in digests], pa.string())}
            columns["found"] = pa.array([[{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in row] for row in spans], struct)
            if redacted:
                columns["redacted"] = pa.array([redact(t, s) for t, s in zip(texts, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def redact_text(text: Column) -> Column:
    """The text with its personal data replaced, as an expression beside other columns (null stays null)."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, find_spans(t)), na_action="ignore")

    return replace(text)
