"""Operator 12 against plain counting, plain edit distances and plain chains."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import spelling

from .conftest import ODD

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, misspell=True):
    counts = {}
    for doc_id, text in rows:
        for run in RUN.findall((text or "")):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if misspell and doc_id is not None and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_variants(words):
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def word_list(rng, n, letters="abcdeéÿ×", longest=14):
    """Words and words some edits away from them."""
    out = set()
    while len(out) < n:
        w = [rng.choice(letters) for _ in range(rng.randint(6, longest))]
        out.add("".join(w))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(w))
            kind = rng.randrange(3)
            w = w[:k] + ([rng.choice(letters)] if kind < 2 else []) + w[k + (kind > 0):]
            if len(w) >= 6:
                out.add("".join(w))
    return sorted(out)


@pytest.mark.parametrize("seed", range(8))
def test_scan_of_one_list_finds_all_pairs_of_one_edit(seed):
    rng = random.Random(seed)
    start = "".join(rng.choice("ab") for _ in range(3))
    words = sorted({start + w for w in word_list(rng, 120, "ab" if seed % 2 else "abcé", 9)})
    data, bounds = spelling._letters(pa.array(words))
    every = np.arange(len(words))
    a, b = spelling.scan(data, bounds, every, every, np.zeros(len(words), np.int64), np.full(len(words), 3))
    got = list(zip(a.tolist(), b.tolist()))
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i in every for j in every if one_edit(words[i], words[j])}


@pytest.mark.parametrize("list_words", [3, 20_000])
def test_variants(spark, list_words, monkeypatch):
    rng = random.Random(list_words)
    words = {w: rng.choice([5, 6, 30, 31, 200, 1000, 6000]) for w in word_list(rng, 400) + ["x" * 3000, "x" * 3001]}
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    rows = [tuple(r) for r in spelling.variants(vocabulary, list_words=list_words).collect()]
    assert len(rows) == len(words) and set(rows) == plain_variants(words)
    assert any(r[1] and r[2] != r[1] for r in rows)  # chains


def test_small_chunks(spark):
    rng = random.Random(5)
    words = {w: 5 for w in word_list(rng, 300, "ab", 8)}
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spelling.near_words(vocabulary, list_words=4, chunk_words=10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.word, r.near) for r in rows) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_documents(spark, odd, empty, clashing):
    rng = random.Random(2)
    words = word_list(rng, 200)
    rows = [r[:2] for r in ODD] + [(k, " ".join(rng.choices([w.upper() if rng.random() < 0.1 else w for w in words], [1 / (1 + i % 50) for i in range(len(words))], k=60)))
                                   for k in [*range(100, 400), 100, None]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = spelling.spelling_variants(docs, misspell=True).collect()
    assert len(got) > 100 and {tuple(r) for r in got} == plain_variants(plain_words(rows))
    assert {tuple(r) for r in spelling.count_words(docs, min_count=1).collect()} >= set(plain_words(rows, False).items())
    assert spelling.spelling_variants(empty).count() == 0
    assert spelling.spelling_variants(odd, misspell=True).count() == len(plain_words([r[:2] for r in ODD]))
    assert spelling.spelling_variants(clashing).columns == ["word", "form", "root", "n", "n_near", "form_n"]
