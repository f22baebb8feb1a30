"""Operator 11 against a plain search of windows and of near terms."""

import hashlib
import random
import re
from collections import Counter

import pytest

from lakeloom.llm import positional

from .conftest import ODD, words

WORD = re.compile(positional.TERM)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, size=positional.WINDOW, n_terms=positional.NEAR_TERMS, within=positional.NEAR_WORDS):
    seen = Counter(t for _, text in docs for t in terms(text))
    windows = []
    for item_id, text in items:
        w = terms(text)
        m = min(len(w), size)
        windows += [("" if item_id is None else str(item_id), w[i:i + m]) for i in range(len(w) - m + 1) if m]
    out = []
    for doc_id, text in docs:
        w = terms(text)
        hit, ids, near = set(), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    ids.add(item)
            k = min(n_terms, len(set(win)))
            rare = sorted((seen[t], t) for t in set(win) if seen[t])[:k]
            if len(rare) == k and any({t for _, t in rare} <= set(w[i:i + within]) for i in range(len(w))):
                near.add(item)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit), len(near)))
    return out


def found(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in positional.contamination(docs, items, **options).collect()]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_hits_are_those_of_a_plain_search(spark, limit, monkeypatch):
    monkeypatch.setattr(positional, "BROADCAST_ROWS", limit)
    rng = random.Random(limit)
    vocabulary = ["the", "of", "É", "漢字", "x1", "don", "t"] + [f"w{i}" for i in range(30)]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "' "]) for _ in range(n))
    items = [(k, text(rng.choice([3, 9, 10, 11, 25]))) for k in range(12)] + [(3, "The W1, of"), (None, text(14)), (20, ""), (21, None), (22, "the"), (23, "no such term")]
    docs = [(k, text(rng.randint(0, 80))) for k in range(60)]
    for k in range(25):  # passages, whole and in part, with other case and marks
        words_ = terms(rng.choice(items[:13])[1])
        a = rng.randint(0, 2)
        docs.append((100 + k, text(5) + "; ".join(words_[a:rng.randint(a, len(words_))]).upper() + " " + text(4)))
    docs += [(1, docs[70][1]), (1, docs[70][1]), (None, docs[71][1]), (200, None), (201, ""), (202, "the " * 40)]
    got, want = found(spark, docs, items), plain(docs, items)
    assert sum(r[5] for r in want) > 15 and sum(r[6] for r in want) > 15
    assert sorted(got, key=key) == sorted(want, key=key)


def test_items_of_one_repeated_word(spark):
    docs, items = [(1, "a " * 30), (2, "a " * 9 + "b " + "a " * 10), (3, "b")], [(1, "a " * 12), (2, "b")]
    assert sorted(found(spark, docs, items)) == sorted(plain(docs, items))


def test_odd_and_empty_tables(spark, odd, empty, clashing):
    items = [(7, words(12, 1)), (8, "漢字")]
    want = plain([r[:2] for r in ODD], items)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [tuple(r) for r in positional.contamination(odd, benchmark).collect()]
    assert sorted(rows, key=key) == sorted(want, key=key)
    assert positional.contamination(empty, benchmark).count() == 0
    rows = positional.contamination(clashing, benchmark.limit(0)).collect()
    assert len(rows) == clashing.count() and not any(r.contaminated or r.n_near for r in rows)
    assert positional.contamination(clashing, clashing, item_id="doc_id").filter("contaminated").count() > 0


def test_matches_are_spans(spark):
    index = positional.build_index(spark.createDataFrame([(5, "x y " + " ".join(f"t{i}" for i in range(14)) + " z")], "doc_id long, text string"))
    words_ = positional.item_terms(index, spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(20)))], "item_id long, text string"))
    rows = positional.phrase_matches(index, words_).collect()
    assert [(r.item_id, r["first"], r["last"]) for r in rows] == [("1", 2, 15)]
