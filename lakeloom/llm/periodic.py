"""Operator 13: periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period q, of at least ``MIN_RUN`` words
and two periods, that no neighbouring word extends with that period.

1. Splitting. A run repeats each of its words at least twice, so a word that
   occurs once in its segment is in no run there and splits the segment. Pieces
   of fewer than ``MIN_RUN`` words go; the others are split again by their own
   counts until nothing changes. This is done for all texts of a slice at once;
   prose is gone after a few rounds. (A run's length bounds the occurrences of
   its words only from below by two: a run may have few, long periods.)
2. Lag scan of the segments that are left. A run of period q matches itself at
   lag q over at least max(q, MIN_RUN - q) words. For lags up to ``SCAN`` the
   whole segment is compared with itself. For each larger lag q that long a match
   covers a stretch of about q / 2 words that starts at a multiple of about
   q / 2, so only those stretches are compared, by rolling hash: some 2 S / q
   for each lag, S log S for a segment of S words in all. Stretches that agree are
   extended word by word. Lags that are multiples of a found run's period skip
   that run.

Everything happens inside a text, so Spark only deals the rows out; memory
follows a slice of texts (``words.SLICE_BYTES``) or the longest single text.

Defined cases: a null or empty text has no words and no run; a null doc_id
leaves the text as it is; each row gets its own result, whatever repeats; an
empty table gives an empty result; other columns are ignored. Words are equal
if their 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeloom.llm.words import find_words, hash_words, runs, slices

MIN_RUN = 12
SCAN = 16  # lags that are compared whole
PAIRS = 1 << 20  # stretches compared at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

Run = tuple[int, int, int]  # start, length, period


def segments(word: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the stable segments: every word at least twice in its segment, MIN_RUN words or more.

    ``word`` has a number for each word, ``text`` the number of its text, ascending.
    """
    at = np.arange(len(word))
    of = text
    while len(at):
        order = np.lexsort((word[at], of))
        w, s = word[at][order], of[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (w[1:] != w[:-1]) | (s[1:] != s[:-1])
        alone = new.copy()
        alone[:-1] &= new[1:]
        once = np.zeros(len(at), dtype=bool)
        once[order] = alone
        # What is left falls into stretches of neighbours within a segment.
        kept = ~once
        place, seg = at[kept], of[kept]
        cut = np.ones(len(place), dtype=bool)
        cut[1:] = (place[1:] != place[:-1] + 1) | (seg[1:] != seg[:-1])
        number = np.cumsum(cut) - 1
        long = np.bincount(number)[number] >= MIN_RUN if len(place) else np.zeros(0, dtype=bool)
        if not once.any() and long.all():
            first = np.flatnonzero(cut)
            return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(first, [*first[1:], len(place)])]
        at, of = place[long], number[long]
    return []


def _stretch(w: np.ndarray, q: int, i: int, size: int) -> tuple[int, int]:
    """Bounds of the words around i that equal the word q later (w[i:i+size] does, as far as hashes tell)."""
    n = len(w) - q
    hi, step = i, max(size, 16)
    while hi < n:
        differ = np.flatnonzero(w[hi:min(hi + step, n)] != w[hi + q:min(hi + step, n) + q])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = min(hi + step, n), 2 * step
    lo, step = i, 16
    while lo > 0:
        a = max(lo - step, 0)
        differ = np.flatnonzero(w[a:lo] != w[a + q:lo + q])
        if len(differ):
            lo = a + int(differ[-1]) + 1
            break
        lo, step = a, 2 * step
    return lo, hi


def _candidates(w: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
    """(lag, starts, length) of the stretches that agree with those a lag later, for ascending lags from SCAN + 1 to half the segment."""
    n = len(w)
    power = np.full(n + 1, 1, dtype=np.uint64)
    power[1:] = np.cumprod(np.full(n, _BASE, dtype=np.uint64))
    total = np.zeros(n + 1, dtype=np.uint64)
    total[1:] = np.cumsum(w * power[:n])
    q = SCAN + 1
    while q <= n // 2:
        # Lags q to r - 1, whose stretches are some PAIRS at most in all.
        r = min(n // 2 + 1, q + max(1, PAIRS * (q // 2 + 1) // n))
        lags = np.arange(q, r)
        size = lags // 2
        step = lags - size + 1  # each stretch of lag words holds size words from a multiple of step
        count = np.maximum((n - lags - size) // step + 1, 0)
        which = np.repeat(np.arange(len(lags)), count)
        start = (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)) * step[which]
        lag, length = lags[which], size[which]
        here = total[start + length] - total[start]
        there = total[start + lag + length] - total[start + lag]
        same = here * power[lag] == there
        lag, start = lag[same], start[same]
        first = runs(lag)
        for a, b in zip(first, [*first[1:], len(lag)]):
            yield int(lag[a]), start[a:b], int(lag[a]) // 2
        q = r


def find_runs(w: np.ndarray, base: int = 0) -> list[Run]:
    """The runs of a segment, by start and period; ``base`` is added to the starts."""
    n = len(w)
    found: dict[tuple[int, int], int] = {}
    known: dict[int, list[tuple[int, int]]] = {}  # by multiple of a found period, where nothing new can be

    def add(lo: int, hi: int, q: int) -> None:
        """The words lo to hi equal those q later."""
        if hi - lo >= max(q, MIN_RUN - q) and (lo, hi + q) not in found:
            found[lo, hi + q] = q
            for k in range(2 * q, (hi + q - lo) // 2 + 1, q):
                if k > SCAN:
                    known.setdefault(k, []).append((lo, hi + q))

    for q in range(1, min(SCAN, n // 2) + 1):
        edge = np.flatnonzero(np.concatenate([[True], w[:-q] != w[q:], [True]]))
        for k in np.flatnonzero(np.diff(edge) - 1 >= max(q, MIN_RUN - q)):
            add(int(edge[k]), int(edge[k + 1]) - 1, q)
    for q, start, size in _candidates(w):
        for a, b in known.pop(q, ()):
            start = start[(start < a) | (start + q + size > b)]
        while len(start):
            lo, hi = _stretch(w, q, int(start[0]), size)
            add(lo, hi, q)
            start = start[start >= max(hi, int(start[0]) + 1)]
    return sorted((base + a, b - a, q) for (a, b), q in found.items())


def text_runs(word: np.ndarray, text: np.ndarray) -> dict[int, list[Run]]:
    """Runs of each text that has some, starts counted within the text."""
    out: dict[int, list[Run]] = {}
    for a, b in segments(word, text):
        number = int(text[a])
        first = int(np.searchsorted(text, number))
        if found := find_runs(word[a:b], a - first):
            out.setdefault(number, []).extend(found)
    return out


def rewritten(doc_id: int | None, n: int) -> np.ndarray | None:
    """For each place the place of the original word that stands there, for the tenth of the documents that get a period."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


RESULT = T.StructType([T.StructField("n_runs", T.LongType()), *[T.StructField(c, T.LongType()) for c in ("start", "length", "period", "exponent_milli")],
                       T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType()),
                       T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
                       T.StructField("collapsed", T.StringType())])


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rewrite: bool = False, with_text: bool = True) -> DataFrame:
    """doc_id, number of runs, the longest, digests, all runs and the text without repeated periods (null unless ``with_text``) of every row.

    ``rewrite`` gives a tenth of the documents, dealt by a hash of their id, a
    period of words first (``rewritten``).
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *RESULT])
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                yield _rows(part, rewrite, with_text, arrow)

    src = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return src.mapInArrow(task, schema)


def _rows(part: pa.RecordBatch, rewrite: bool, with_text: bool, schema: pa.Schema) -> pa.RecordBatch:
    w = find_words(part.column("_text"))
    word, first = hash_words(w), w.first()
    order = {}
    if rewrite:
        for k, value in enumerate(part.column("_id").to_pylist()):
            places = rewritten(value, int(first[k + 1] - first[k]))
            if places is not None:
                order[k] = places
                word[first[k]:first[k + 1]] = word[first[k] + places]
    found = text_runs(word, w.row)
    columns: list[list] = [[] for _ in range(9)]
    for k, value in enumerate(part.column("_text").to_pylist()):
        words = value.encode().split()
        if k in order:
            words = [words[i] for i in order[k].tolist()]
        spans = found.get(k, [])
        longest = min(spans, key=lambda r: (-r[1], r[0], r[2]), default=None)
        if spans:
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, [s + q for s, _, q in spans], 1)
            np.add.at(edge, [s + n for s, n, _ in spans], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
        rest = b" ".join(words)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in spans)
        row = (len(spans), *(longest or (None, None, None)), 1000 * longest[1] // longest[2] if longest else None,
               hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest(),
               [dict(zip(("start", "length", "period"), r)) for r in spans], rest.decode() if with_text else None)
        for column, x in zip(columns, row):
            column.append(x)
    ids = part.column("_id").cast(schema.field(0).type)
    return pa.RecordBatch.from_arrays([ids, *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]], schema=schema)
