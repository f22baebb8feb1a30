"""Substrings, near duplicates, mixing and shuffling against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import minhash, mixing, shuffling, substrings

from .conftest import ODD, words

WORD = re.compile("[^\x20\x09-\x0D]+")
TABLE = "doc_id long, text string"


def plain_removal(rows, size):
    first, parts = {}, [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in parts:
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, w in parts:
        gone = {i + j for i in range(len(w) - size + 1) if first[tuple(w[i:i + size])] < (d, i) for j in range(size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def removal(df, **options):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeated(df, **options).collect())


def test_substrings(spark, empty, clashing):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for k in range(60)]
    rows += [(100, words(25) + " " + words(25)), (101, "q " + words(25)), (102, None), (103, " "), (104, "x " * 100), (105, "É" * 300 + " " + words(25))]
    for size in (5, 20):
        assert removal(spark.createDataFrame(rows, TABLE).repartition(7), size=size) == plain_removal(rows, size)
    assert substrings.remove_repeated(empty).count() == 0
    assert substrings.remove_repeated(clashing).count() == 6


def test_substrings_of_odd_rows(odd):
    got = substrings.remove_repeated(odd).collect()
    by = {(r.doc_id, r.n_words): r.n_removed for r in got}
    assert len(got) == len(ODD) and by[6, 60] == 60 and by[1, 60] == 0 and by[8, 61] == 60
    assert by[10, 30] == 0 and by[None, 30] == 0  # equal rows of one doc_id start at the same place


def test_full_sketch_loses_nothing(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("abcd") for _ in range(80))) for k in range(40)]
    want = plain_removal(rows, 20)
    monkeypatch.setattr(substrings, "MIN_CELLS", 1 << 22)
    monkeypatch.setattr(substrings, "FLUSH_WINDOWS", 100)
    monkeypatch.setattr(substrings, "_cells", lambda h, row, cells: np.zeros(len(h), dtype=np.uint32))  # every window in one cell
    assert removal(spark.createDataFrame(rows, TABLE)) == want


def plain_groups(rows):
    def shingles(t):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    sets = {d: shingles(t) for d, t in rows}
    label = {d: d for d in sets}
    ids = sorted(sets)
    moved = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((d, len(sets[d]), label[d], label[d] == d) for d in ids)


def test_near_duplicates(spark):
    rng = random.Random(4)
    rows, n = [], 0
    for g in range(12):
        base = words(rng.choice([3, 6, 40, 120]), g).split()
        for _ in range(rng.choice([1, 2, 9])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 20))):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append((n * 37 % 1009, " ".join(w).upper() if rng.random() < 0.3 else "  ".join(w)))
            n += 1
    rows += [(2000, None), (2001, ""), (2002, "a b"), (2003, "A  b"), (2004, "b a")]
    got = sorted(tuple(r)[:4] for r in minhash.near_duplicates(spark.createDataFrame(rows, TABLE)).collect())
    assert got == plain_groups(rows)


def test_near_duplicates_in_a_chain(spark):
    """Each text is near the next one only; the group reaches from end to end."""
    base = words(400).split()
    rows = [(50 - k, " ".join(["x%d" % i if i < 20 * k else w for i, w in enumerate(base)])) for k in range(15)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, TABLE)).collect()}
    assert [(d, c) for d, _, c, _ in plain_groups(rows)] == sorted(got.items())


@pytest.mark.parametrize("rows_of_block", [8_192, 5])
def test_near_duplicates_in_small_parts(spark, monkeypatch, rows_of_block):
    """Blocks of few rows, cut into parts of few bytes, lose no link."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", rows_of_block)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 6_000)
    base = words(300).split()
    rows = [(90 - 7 * k - c, " ".join(["x%d" % i if i < 13 * k else "y%d" % c if i == 299 else w for i, w in enumerate(base)])) for k in range(12) for c in range(3)]
    rows += [(200 + k, words(300, k)) for k in range(5)]
    got = sorted(tuple(r)[:4] for r in minhash.near_duplicates(spark.createDataFrame(rows, TABLE)).collect())
    assert got == plain_groups(rows)


def test_parts_meet_once_at_least(spark):
    rows = spark.createDataFrame([(c, n) for n in (1, 3) for c in range(40)], "c long, n long")
    met = {}
    for r in minhash._dealt(rows.withColumn("g", F.col("n")), "c", "n").collect():
        met.setdefault((r.g, r.low, r.high), set()).add(r.c)
    for g in (1, 3):
        parts = [m for (k, _, _), m in met.items() if k == g]
        assert all(any({a, b} <= m for m in parts) for a in range(40) for b in range(a))
        assert sum(map(len, parts)) == 40 * g


def test_classes_that_share_a_hash_keep_apart(spark):
    got = minhash._named(spark.createDataFrame([(1, 5), (1, 6), (1, 9), (2, 5), (-3, 0)], "k1 long, k2 long")).collect()
    assert len({r.c for r in got}) == 5 and {r.c for r in got} >= {1, 2, -3}


def test_near_duplicates_of_odd_rows(odd, empty, clashing):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert got[6, 56] == got[8, 57] == (1, False) and got[1, 56] == (1, True)
    assert got[2, 0] == (2, True) and got[3, 0] == (3, True) and got[None, 26] == (None, False)
    assert got[10, 26] == (10, True)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.near_duplicates(clashing).count() == 6


def test_estimate_counts_equal_fields(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 16, (2, minhash.MINIMA))
    pack = lambda x: (x.reshape(-1, 16).astype(np.uint64) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(1).astype(np.uint64).view(np.int64).tolist()
    got = spark.range(1).select(F.array(*map(F.lit, pack(a))).alias("a"), F.array(*map(F.lit, pack(b))).alias("b")).select(minhash.estimate("a", "b")).first()[0]
    assert got == pytest.approx(((a == b).mean() - 1 / 16) / (15 / 16))


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and free:
        total, share, left = sum(weight[s] for s in free), left, 0.0
        for s in list(free):
            target[s] += share * weight[s] / total
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


def test_mixing(spark):
    rng = random.Random(6)
    sources = ["a", "b", "B", "é", "zz", None, "", "tiny", "none"]
    rows = [(k, words(rng.randint(0, 400), k), sources[k % 7]) for k in range(210)] + [(500, "just a few words", "tiny"), (501, "", "none"), (502, None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.taken(df, block=16, shard_slots=256).collect()}
    again = {r.doc_id: r for r in mixing.taken(df.repartition(5), block=16, shard_slots=256).collect()}
    assert got == again and len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for i, t, s in rows:
        r = got[i]
        assert r.size == len(WORD.findall(t or "")) and r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.03 * want[s] + 48


def test_permutations():
    for n in (1, 2, 3, 17, 1000):
        k = np.arange(n)
        for key in (1, 99):
            got = mixing._permuted(k, np.full(n, n), np.full(n, key, dtype=np.uint64))
            assert sorted(got.tolist()) == k.tolist()


def test_mixed_documents_hold_what_was_taken(odd, empty, clashing):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    mixed = mixing.mixed_documents(odd, columns, block=4).collect()
    taken = {}
    for r in mixing.taken(odd, block=4).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    found = dict.fromkeys(taken, 0)
    for r in mixed:
        found[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert found == taken
    assert mixing.taken(empty).count() == 0 and mixing.mixed_documents(empty, columns).count() == 0
    assert mixing.taken(clashing).count() == 6


def test_shuffle(odd, empty, clashing):
    rows = shuffling.shard_documents(odd, n_shards=5).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1 and len(rows) == len(ODD)
    for s in range(5):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in ODD)
    assert sorted((r["size"], r.text_crc32) for r in rows) == want
    assert sorted(map(str, shuffling.shard_documents(odd.repartition(3), n_shards=5).collect())) == sorted(map(str, rows))
    assert shuffling.shard_documents(empty).count() == 0
    assert shuffling.shuffle_into_shards(clashing.drop("text"), 4).filter("shard >= 0 and slot >= 0").count() == 6


def test_hypergeometric_draws_follow_the_exact_law():
    from math import comb
    rng = np.random.default_rng(7)
    for good, bad, n in ((5, 7, 6), (1, 3, 2), (30, 10, 35)):
        got = np.bincount([shuffling._hypergeometric(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1) / 20_000
        law = np.array([comb(good, k) * comb(bad, n - k) / comb(good + bad, n) if k <= good and n - k <= bad else 0 for k in range(n + 1)])
        assert np.abs(got - law).max() < 0.015 and not got[law == 0].any()
    for good, bad, n in ((10**11 // 16, 10**11 * 15 // 16, 250_000), (10**12, 10**12, 10**9)):  # one way for all sizes
        x = np.array([shuffling._hypergeometric(rng, good, bad, n) for _ in range(2_000)], dtype=float)
        size = good + bad
        var = n * (good / size) * (bad / size) * ((size - n) / (size - 1))
        assert abs(x.mean() - n * good / size) < 5 * (var / 2_000) ** 0.5 and 0.85 < x.var() / var < 1.15
    assert shuffling._hypergeometric(rng, 0, 5, 3) == 0 and shuffling._hypergeometric(rng, 5, 0, 3) == 3


def test_communication_matrix():
    counts = [10, 0, 7, 1, 30]
    total = np.zeros((len(counts), 4))
    for seed in range(400):
        m = np.array(shuffling.communication_matrix(counts, 4, seed))
        assert m.sum(1).tolist() == counts and sorted(m.sum(0).tolist()) == [12, 12, 12, 12]
        total += m
    assert np.allclose(total / 400, np.array(counts)[:, None] / 4, atol=0.5)
