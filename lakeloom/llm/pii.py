"""Operator 10: personal data as spans.

Regular expressions propose spans, validators confirm them, and words near a
span move its score. Base kinds (email, ip, card, phone) are kept whenever
their validator holds. The method's own kinds are kept when the score reaches
``threshold``: an IBAN is confirmed by its mod-97 check digits, a social
security number by its number ranges; context words such as "account" add to
a proposal's score, words such as "order" or "version" take from it.

Defined cases: a null text counts as empty; repeated rows each get their own
result; input columns other than those carried are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match cannot begin inside a run of digits whose start has failed, so the look-behind only saves time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NON_DIGIT = re.compile(r"[^0-9]")

CONTEXT_CHARS = 48
#: kind: score once the validator holds, words that raise it, words that lower it
SCORES = {
    "email": (0.9, ("mail", "contact", "write"), ()),
    "ip": (0.6, ("ip", "host", "address", "server"), ("version", "section", "release")),
    "card": (0.7, ("card", "visa", "credit", "payment"), ("order", "isbn", "serial")),
    "phone": (0.7, ("phone", "call", "tel", "mobile", "fax"), ("order", "serial")),
    "iban": (0.8, ("iban", "account", "bank", "konto", "compte", "cuenta"), ("serial",)),
    "ssn": (0.3, ("ssn", "social", "security", "taxpayer"), ("order", "part", "serial")),
}
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d)
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check digits of an IBAN without spaces: letters count 10 to 35, the first four move to the end."""
    if not 15 <= len(iban) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: each ``@`` with the run of local characters before it."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        floor = m.end() if m else at + 1
        if m:
            yield start, floor
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the four base kinds, in order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NON_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NON_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def score(text: str, kind: str, start: int, end: int) -> float:
    base, up, down = SCORES[kind]
    near = set(_WORD.findall((text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]).lower()))
    return max(0.0, min(1.0, base + 0.3 * any(w in near for w in up) - 0.3 * any(w in near for w in down)))


def find_spans(text: str, threshold: float = 0.5) -> list[tuple[int, int, int, float]]:
    """(start, kind index, end, score), by start and kind; base spans whatever their score."""
    base = base_spans(text)
    more = []
    m = _IBAN.search(text)
    while m:
        # The pattern's last groups may be words or a number that follow: keep the longest valid cut at a space, go on after it.
        s, e = m.start(), m.end()
        while e > s and not mod97(text[s:e].replace(" ", "")):
            e = text.rfind(" ", s, e)
        if e > s:
            more.append((s, 4, e))
        m = _IBAN.search(text, e if e > s else s + 1)
    for m in _SSN.finditer(text):
        a, b, c = m.group().split("-")
        if a not in ("000", "666") and a < "900" and b != "00" and c != "0000":
            more.append((m.start(), 5, m.end()))
    out = [(s, k, e, score(text, KINDS[k], s, e)) for s, k, e in sorted(base + more)]
    return [x for x in out if x[1] < len(BASE_KINDS) or x[3] >= threshold]


def _joined(spans: Iterable[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


def redact(text: str, spans: list[tuple]) -> str:
    """Each span's characters replaced by ``[KIND]``; overlapping spans become one, under the first one's kind."""
    out, at = [], 0
    for s, k, e, *_ in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


SPAN_COLUMNS = [
    T.StructField("n_email", T.LongType()), T.StructField("n_ip", T.LongType()), T.StructField("n_card", T.LongType()),
    T.StructField("n_phone", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("redacted", T.StringType()),
]


def find_pii(docs: DataFrame, carry: Iterable[str] = ("doc_id",), text: str = "text", threshold: float = 0.5,
             redacted: bool = True) -> DataFrame:
    """Spans of every row's whole text, with the carried columns before them.

    One pass, no shuffle; a task holds one Arrow batch. ``redacted`` adds the
    text with its spans masked (else null). A carried column keeps its name and
    wins over a result column of the same name.
    """
    carry = list(carry)
    new = [f for f in SPAN_COLUMNS if f.name not in carry]
    schema = T.StructType([docs.schema[c] for c in carry] + new)
    names = [f.name for f in new]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for value in part.column("_text").to_pylist():
                    value = value or ""
                    spans = find_spans(value, threshold)
                    base = [x for x in spans if x[1] < len(BASE_KINDS)]
                    counts = [sum(x[1] == k for x in base) for k in range(len(BASE_KINDS))]
                    rows.append([*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans),
                                 [x[3] for x in spans], redact(value, spans) if redacted else None])
                cols = dict(zip([f.name for f in SPAN_COLUMNS], zip(*rows)))
                types = dict(zip([f.name for f in SPAN_COLUMNS], [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.float64()), pa.string()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(f"_c{k}") for k in range(len(carry))] + [pa.array(cols[n], types[n]) for n in names], names=[*carry, *names])

    src = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)], F.col(text).alias("_text"))
    return src.mapInArrow(task, schema)
