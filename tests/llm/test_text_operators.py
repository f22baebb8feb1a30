"""PII, quality rules, BPE and licences against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from lakeloom.llm import bpe, licenses, pii, quality
from lakeloom.llm.words import find_words, hash_words

from .conftest import ODD, words

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(d)]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found)


@pytest.mark.parametrize("letters", ["a@.-1", "12. -+()", "a1@.+_é 0", "0123456789 -"])
def test_base_spans_are_those_of_the_plain_patterns(letters):
    rng = random.Random(letters)
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)


def test_validators_and_context():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    kinds = lambda t: [pii.KINDS[k] for _, k, _, _ in pii.find_spans(t)]
    assert kinds("iban GB82 WEST 1234 5698 7654 32 NOW") == ["iban"]
    assert kinds("my social security number is 123-45-6789") == ["ssn"]
    assert kinds("part order 123-45-6789") == []
    assert pii.redact("mail a@b.de or +49 30 1234567", pii.find_spans("mail a@b.de or +49 30 1234567")) == "mail [EMAIL] or [PHONE]"


def test_grouped_ibans_in_a_row():
    text = "pay BE68 5390 0754 7034 BE71 0961 2345 6769 ES91 2100 0418 4502 0005 1332 ES79 2100 0813 6101 2345 6789 or XX00 1111 2222 BE68 5390 0754 7034"
    assert [text[s:e] for s, k, e, _ in pii.find_spans(text) if pii.KINDS[k] == "iban"] == [
        "BE68 5390 0754 7034", "BE71 0961 2345 6769", "ES91 2100 0418 4502 0005 1332", "ES79 2100 0813 6101 2345 6789", "BE68 5390 0754 7034"]


def test_pii_rows(spark, odd, empty, clashing):
    rows = pii.find_pii(odd).collect()
    assert len(rows) == len(ODD) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.find_pii(empty).count() == 0
    assert pii.find_pii(clashing, carry=["doc_id", "spans"]).columns[:2] == ["doc_id", "spans"]
    text = "x 10.0.0.1 a@b.de"
    r = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_email, r.n_ip, r.spans, r.redacted) == (1, 1, "ip:2:10,email:11:17", "x [IP] [EMAIL]")


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = [t for _, t, *_ in ODD]
    w = find_words(pa.array(texts))
    got = [(int(r), w.data[s:e].tobytes().decode()) for r, s, e in zip(w.row, w.start, w.end)]
    assert got == [(k, x) for k, t in enumerate(texts) for x in WORD.findall(t or "")]
    h = hash_words(w)
    assert len(set(h.tolist())) == len({x for _, x in got})


def test_quality_counts(spark, odd, empty, clashing):
    model = quality.fit_model(odd)
    rows = quality.judge(odd, model, {}, carry=("doc_id", "text")).collect()
    for r in rows:
        text = r.text or ""
        w = WORD.findall(text)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in range(3)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), again, len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and r.kept == (not r.base_failed)
    assert quality.quality_rules(empty).count() == 0
    assert quality.quality_rules(clashing, carry=("doc_id", "n_words")).filter("n_words = 'x'").count() == 6


def test_bands_reject_another_language(spark):
    rng = random.Random(5)
    prose = lambda syllables: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(120))
    schema = "doc_id long, text string, lang string"
    corpus = spark.createDataFrame([(k, prose(["the", "an", "re", "on", "ing", "st"]), "en") for k in range(300)], schema)
    more = spark.createDataFrame([(900, prose(["zq", "xk", "jv", "wq", "qq"]), "en"), (901, "".join(rng.choice("abcdefghijklmnopq ") for _ in range(800)), "en")], schema)
    model = quality.fit_model(corpus)
    bands = quality.fit_bands(corpus, model)
    kept = {r.doc_id: r.kept for r in quality.judge(corpus.union(more), model, bands).collect()}
    assert not kept.pop(900) and not kept.pop(901) and all(kept.values())


def test_bands_are_those_of_the_language_value(spark):
    rng = random.Random(6)
    prose = lambda syllables: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(120))
    many = [(prose(["the", "an", "re", "on", "ing", "st"]), "de") for _ in range(60)]
    few = [(prose(["ka", "mo", "lu", "pe", "zi", "qo"]), None) for _ in range(20)]  # null and 'de' had one band
    docs = spark.createDataFrame([(k, *x) for k, x in enumerate(many + few)], "doc_id long, text string, lang string")
    rows = quality.quality_rules(docs, carry=("doc_id", "lang")).collect()
    assert len(rows) == 80 and all(r.kept for r in rows)
    bands = quality.fit_bands(docs, quality.fit_model(docs))
    assert set(bands) == {"de", None} and bands["de"] != bands[None]


def plain_symbols(text):
    return ["\x02"] * (quality.ORDER - 1) + [{" ": " "}.get(c, "0" if c in "0123456789" else c) for c in re.sub("[\x20\x09-\x0D]+", " ", text.lower())]


def plain_model(texts):
    """P(symbol | symbols before it) of a modified Kneser-Ney model with counts from ``texts``."""
    top = collections.Counter()
    for t in texts:
        s = plain_symbols(t)
        top.update(tuple(s[i - quality.ORDER + 1:i + 1]) for i in range(quality.ORDER - 1, len(s)))
    levels = {quality.ORDER: top}
    for k in range(quality.ORDER - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    cuts = {k: quality.discounts([sum(n == x for n in level.values()) for x in (1, 2, 3, 4)]) for k, level in levels.items()}
    below = collections.defaultdict(list)
    for level in levels.values():
        for g, n in level.items():
            below[g[:-1]].append(n)

    def p(g):
        if not g:
            return 1 / (len(levels[1]) + 1)
        k, known = len(g), below.get(g[:-1])
        if not known:
            return p(g[1:])
        n = levels[k].get(g, 0)
        return (n - cuts[k][min(n, 3)] + sum(cuts[k][min(x, 3)] for x in known) * p(g[1:])) / sum(known)
    return p, levels


def test_losses_are_those_of_a_plain_model_of_the_other_half(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 25))) for _ in range(60)]
    texts += ["б в Б г в", "漢 字 漢 \U0001f600", "in 1999\t\n and 2024", " lead", "x", "\x00\x02 ctl"]
    rows = [(k, t) for k, t in enumerate([*texts, *texts[:5], texts[0], None, ""])]  # copies don't count
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fold = {r.text: r._k1 & 1 for r in docs.select("text", *quality._version("text")).collect()}
    half = [plain_model([t for t in {*texts, ""} if fold[t] == f and "ctl" not in t] + [t.replace("\x00", "\x1f").replace("\x02", "\x1f") for t in texts if "ctl" in t and fold[t] == f]) for f in (0, 1)]
    model = quality.fit_model(docs)
    got = {r.text: r.loss for r in quality.judge(docs, model, {}, carry=("text",), lang="text").collect()}
    assert got[None] == got[""] == 0
    for t in texts:
        p, _ = half[1 - fold[t]]
        s = plain_symbols(t.replace("\x00", "\x1f").replace("\x02", "\x1f"))
        logs = [np.log(p(tuple(s[i - quality.ORDER + 1:i + 1]))) for i in range(quality.ORDER - 1, len(s))]
        assert got[t] == pytest.approx(-sum(logs) / len(logs), rel=1e-4), t
    # A model too large to be broadcast gives the same; its arrays are sorted and hold every entry.
    joined = {(r._k1, r._k2): (r.n, r.loss) for r in quality.text_losses(docs, model, broadcast_entries=0).collect()}
    sent = {(r._k1, r._k2): (r.n, r.loss) for r in quality.text_losses(docs, model).collect()}
    assert set(joined) == set(sent) and all(joined[k] == pytest.approx(sent[k], rel=1e-6) for k in sent)
    keys = quality.model_arrays(model)[0]
    assert len(keys) == model.n_entries and (keys[1:] > keys[:-1]).all()


def test_model_is_a_distribution(spark):
    rng = np.random.default_rng(1)
    docs = spark.createDataFrame([("".join(rng.choice(list("abcde "), 400)),) for _ in range(40)], "text string")
    model = quality.fit_model(docs, doc_id="none")
    arrays = quality.model_arrays(model)
    import pyarrow as pa
    for context in ("abcd", "eeee", "a bc", "zzzz", ""):
        logs = []
        for c in "abcde ":
            code, at, _, _ = quality._symbols(pa.array([context + c]))
            logs.append(quality.log_probabilities(arrays, code, at[-1:], 0, model.floors[0])[0])
        new = quality._symbols(pa.array([context + "#"]))
        logs.append(quality.log_probabilities(arrays, new[0], new[1][-1:], 0, model.floors[0])[0])
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_junk_in_any_script_is_less_likely_than_prose(spark):
    rng = random.Random(9)
    for letters in ("абвгдежзиклмнопрстуфх", "αβγδεζηθικλμνξοπρστυ", "人大小中国山川日月火水木金土上下左右天"):
        word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 6)))
        known = [word() for _ in range(80)]
        rows = [(k, " ".join(rng.choice(known) for _ in range(100)), "xx") for k in range(150)]
        docs = spark.createDataFrame([*rows, (900, " ".join(word() for _ in range(100)), "xx")], "doc_id long, text string, lang string")
        kept = {r.doc_id: r.kept for r in quality.quality_rules(docs).collect()}
        assert not kept.pop(900) and all(kept.values())


def test_bands_follow_the_spread_of_the_losses(spark):
    """A text 0.2 nats over a tight distribution goes, one 0.2 over a wide one stays."""
    docs = spark.createDataFrame([(f"{lang}{k}", lang) for lang in ("tight", "wide") for k in range(1001)], "text string, lang string")
    shift = {"tight": 0.02, "wide": 0.5}
    rows = [(r.text, r._k1, r._k2, 60, 8.0 + shift[r.lang] * (int(r.text[len(r.lang):]) - 500) / 500)
            for r in docs.select("*", *quality._version("text")).collect()]
    losses = spark.createDataFrame([x[1:] for x in rows], "_k1 long, _k2 int, n long, loss double")
    bands = quality.fit_bands(docs, None, losses=losses)
    assert bands["tight"][1] < 8.2 < bands["wide"][1] and bands["tight"][0] > 7.8 > bands["wide"][0]
    assert quality.fit_bands(docs.limit(0), None, losses=losses) == {}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("leaf", [3, 20, 512])
def test_tree_of_pieces_is_the_librarys_encoding(library, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    c = bpe.codec(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(leaf)
    alphabets = ["ab", "abc ", "the ing 's're'll", "é日本語カ", "01 9", "!?-'s ", "\n\t  x", ["<|endoftext|>", "a", "  ", "x'"], "ab'sl 1é\n"]
    for n in range(300):
        letters = rng.choice(alphabets)
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 40, 400])))
        want = library.encode(text, add_special_tokens=False).ids
        assert c.encode(text) == want
        assert bpe.tree(c, [(p, c.encode(p)) for p in c.pieces(text, rng.choice([2, 7, 50]))]) == want
        assert c.decode(want).decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_rows(odd, empty, clashing, library):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(odd, path, piece=1000).collect())
    want = []
    for i, t, *_ in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_decode(empty, path).count() == 0
    assert bpe.encode_decode(clashing, path).count() == 6


def test_licences(spark, odd, empty, clashing):
    notice = "Released under the MIT License."
    mit = next(t for n, _, t in licenses.TEMPLATES if n == "mit-text")
    rows = [(1, words(50) + "\n" + notice), (2, "Copyright (c) 2020 A. Person\n\n" + mit.replace("Software", "software")), (3, None), (4, "released UNDER the mit licence"),
            (1, words(50) + "\n" + notice)]
    got = sorted((r.doc_id, r.licence, r.dice, r.kind, r.n_matches) for r in licenses.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
                 if r.licence)
    assert got[0] == got[1] and got[0][:3] == (1, "MIT", 1.0) and got[2][:3] == (2, "MIT", 1.0) and len(got) == 3
    assert licenses.licences(odd).filter("licence is null and n_matches = 0").count() == len(ODD)
    assert licenses.licences(empty).count() == 0 and licenses.licences(clashing).count() == 6


def plain_windows(text, threshold):
    """Best (dice, first word) of each template, over every window that starts at one of its bigrams."""
    w, best = licenses.normalised(text or ""), {}
    for name, _, template in licenses.TEMPLATES:
        grams, n = set(licenses.bigrams(template)), len(licenses.normalised(template)) - 1
        for k in range(len(w) - 1):
            if f"{w[k]} {w[k + 1]}" in grams:
                here = {f"{x} {y}" for x, y in zip(w[k:k + n], w[k + 1:k + n + 1])}
                dice = 2 * len(here & grams) / (len(here) + len(grams))
                if dice >= threshold and (name not in best or dice > best[name][0]):
                    best[name] = (dice, k)
    return best


def test_licences_within_longer_texts(spark):
    text = {n: t for n, _, t in licenses.TEMPLATES}
    paragraphs = text["mit-text"].replace("conditions: The", "conditions:\n\nThe").replace("SOFTWARE IS PROVIDED", "SOFTWARE IS PROVIDED", 1).replace("Software. THE", "Software.\n\nTHE")
    code = "\n".join(f"def f{k}(x): return x + {k}" for k in range(60))
    rows = [
        (1, paragraphs + "\n\n" + code),
        (2, "/*\n * " + "\n * ".join(paragraphs.split("\n")) + "\n */\n" + code),
        (3, "This module is Released under the MIT License. See the file for more."),
        (4, words(1018) + " " + text["zlib-text"] + " " + words(900, 2)),  # across a border of chunks
        (5, words(5000) + "\n" + code + "\n" + text["bsd-3-text"].replace("express", "explicit") + "\n" + words(3000, 3) + " licensed under\n\nCC BY 4.0"),
        (6, "the software and the license of the work " * 400),
        (7, " ".join(["Licensed under the MIT License and"] * 300)),  # ties: the first
        (8, "we released it, and under the terms of the MIT it stands; license fees"),
        (9, "words before " + text["isc-text"][:400] + " words after"),  # half of a text
        (None, "x Licensed under CC BY-SA 4.0. y"),
    ] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (licenses.CHUNK, 100):
        got = {}
        for r in licenses.scan(df, chunk=chunk).collect():
            if r.kind == licenses.WINDOW:
                assert (r.doc_id, r.template) not in got
                got[r.doc_id, r.template] = (round(r.dice, 9), r.no)
        want = {(i, name): (round(dice, 9), at) for i, t in rows for name, (dice, at) in plain_windows(t, licenses.THRESHOLD).items()}
        assert got == want and {i for i, _ in got} == {1, 2, 3, 4, 5, 7, None}
    best = {r.doc_id: r for r in licenses.licences(df).collect()}
    assert [best[k].licence for k in (1, 2, 3, 4, 6, 8, 9)] == ["MIT", "MIT", "MIT", "Zlib", None, None, None]


def test_licence_anchors_lose_nothing():
    """A set at the threshold holds an anchor, whichever bigrams it lacks."""
    for _, _, template in licenses.TEMPLATES:
        grams = licenses.bigrams(template)
        known = set(licenses.anchors([("", "", template)], licenses.THRESHOLD))
        least = licenses.least_common(len(grams), licenses.THRESHOLD)
        assert len(known) + least > len(grams) and 2 * (least - 1) < licenses.THRESHOLD * (least - 1 + len(grams))
