"""Operator 13 against a plain search over all stretches and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lakeloom.llm import periodic

from .conftest import ODD

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_runs(w, least=periodic.MIN_RUN):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def numbers(words):
    return np.array([hash(x) & 0xFFFFFFFFFFFFFFFF for x in words], dtype=np.uint64)


def text_of(rng):
    """Random words, powers, nested powers and rests of powers."""
    out = []
    for _ in range(rng.randint(1, 5)):
        u = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:
            u = u * rng.randint(1, 3) + [rng.choice("xyz")]
        u = u * rng.randint(1, 6)
        out += u[:rng.randint(1, len(u))]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_a_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(60):
        w = text_of(rng)
        assert periodic.find_runs(numbers(w)) == plain_runs(w), w
        got = periodic.text_runs(numbers(w), np.zeros(len(w), np.int64)).get(0, [])
        assert got == plain_runs(w), w


def test_small_blocks_of_lags(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(periodic, "PAIRS", 8)
    for _ in range(40):
        w = text_of(rng)
        assert periodic.find_runs(numbers(w)) == plain_runs(w)


def test_segments_of_several_texts_do_not_meet():
    w = numbers(list("ab" * 5) + list("ab" * 7) + list("cab" * 3))
    text = np.repeat([0, 1, 2], [10, 14, 9])
    assert periodic.segments(w, text) == [(10, 24)]
    assert periodic.text_runs(w, text) == {1: [(0, 14, 2)]}


def test_very_long_texts():
    n = 300_000
    assert periodic.find_runs(np.zeros(n, np.uint64)) == [(0, n, 1)]
    u = np.random.default_rng(1).integers(0, 50, n // 3).astype(np.uint64)
    assert (0, 3 * len(u), len(u)) in periodic.find_runs(np.tile(u, 3))


def expected(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def key(row):
    return tuple((x is not None, x) for x in row)


def test_rows(spark, odd, empty, clashing):
    rng = random.Random(4)
    texts = [r[:2] for r in ODD] + [(100 + k, " ".join(text_of(rng))) for k in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = [tuple(r) for r in periodic.periodic_runs(docs, rewrite=True).drop("runs", "collapsed").collect()]
    assert sorted(rows, key=key) == sorted((expected(*t) for t in texts), key=key)
    assert periodic.periodic_runs(empty).count() == 0
    assert periodic.periodic_runs(clashing).count() == clashing.count()
    r = periodic.periodic_runs(spark.createDataFrame([(1, "x " + "a b " * 8 + "y")], "doc_id long, text string")).first()
    assert (r.start, r.length, r.period, r.exponent_milli, r.collapsed) == (1, 16, 2, 8000, "x a b y")
    assert [tuple(x) for x in r.runs] == [(1, 16, 2)]
