"""Operator 3: base quality rules and language-specific perplexity bands.

The language model is a modified Kneser-Ney model of order ``ORDER`` over code
points (lower case, ASCII white space as one gap, digits as one symbol), of any
script: its table grows with the n-grams of the corpus. Every distinct text
counts once, however many copies it has. There are two models, one of each half
of the distinct texts (dealt by a hash of the text), and a text is scored by the
model of the half it is not in; else junk would be as likely as prose, since it
has seen itself.

1. Tasks count the n-grams of the highest order in flushes of some million code
   points; Spark adds them up by group (``count_ngrams``).
2. Lower orders, discounts, contexts' totals and interpolated probabilities are
   groupings and joins of the n-gram tables (``fit_model``); the driver sees
   counts of counts and totals, some fifty numbers.
3. N-grams of all orders, hashed to 64 bits, become sorted arrays of keys, log
   probabilities and log back-off weights, a row a hash range.
4. Up to ``BROADCAST_ENTRIES`` entries the arrays are broadcast and every task
   scores the texts it reads. Beyond, the n-grams asked for by blocks of texts
   meet the same entries in a join and come back to the block. Both ways score
   with the same function.

A language's band comes from the losses (nats per code point) of its distinct
texts of at least ``MIN_WORDS`` words. Above the median it is ``spread`` standard
deviations wide, estimated from the third quartile; below, from the first, but
no more than the share ``low_share`` of the texts lies under it: a text that
others predict well has near copies, which is for the near-duplicate stage to
decide. There are no floors; where a quartile equals the median there is
nothing to estimate from, and that side has no limit.

Defined cases: a null text has no words, so the base rules reject it, and a loss
of 0; a null language is a language of its own; very long texts are scored whole
(memory follows the longest text); repeated rows each get their own verdict, and
count once in the model, but for rows equal in text and id in different tasks;
an empty table gives an empty result; only the carried input columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import staged
from lakeloom.llm.words import WORD_SPACE, find_words, hash_windows, hash_words, mix, runs, slices, text_bytes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
ORDER = 5
FLUSH = 2_000_000  # code points counted together
RANGE_ENTRIES = 50_000
BROADCAST_ENTRIES = 16_000_000  # 16 bytes each
COPIES_BROADCAST = 2_000_000
BLOCK_BYTES = 4 << 20
_START, _GAP, _DIGIT, _CONTROL = 2, 32, 48, 31
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_FOLD, _ORDER = 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7


def discounts(few: list[int]) -> np.ndarray:
    """Discounts for counts 0 to 3 and more, from the numbers of n-grams with counts 1 to 4."""
    y = few[0] / (few[0] + 2 * few[1]) if few[0] else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * few[k] / few[k - 1] if few[k - 1] else 0.5 * k
        out.append(min(max(d, 0.1 * k), 0.95 * k))  # where counts are too few or odd
    return np.array(out)


_PLAIN = np.arange(128, dtype=np.uint32)
_PLAIN[:32] = _CONTROL
_PLAIN[list(WORD_SPACE)] = _GAP
_PLAIN[48:58] = _DIGIT


def _symbols(col) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each after ORDER - 1 start symbols; places and texts of those that aren't start symbols; words by text."""
    texts = [t or "" for t in pc.utf8_lower(col).to_pylist()]
    lead = chr(_START) * (ORDER - 1)
    points = np.frombuffer((lead + lead.join(texts)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if texts else np.zeros(0, np.uint32)
    size = np.array([len(t) for t in texts], dtype=np.int64) + ORDER - 1
    row = np.repeat(np.arange(len(texts)), size)
    head = np.cumsum(size) - size
    code = np.where(points < 128, _PLAIN[np.minimum(points, 127)], points)
    for j in range(ORDER - 1):
        code[head + j] = _START
    gap = code == _GAP
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    code, row = code[keep], row[keep]
    at = np.flatnonzero(code != _START)
    break_ = (code == _GAP) | (code == _START)
    first = ~break_
    first[1:] &= break_[:-1]
    return code, at, row[at], np.bincount(row[first], minlength=len(texts))


def _raw(code: np.ndarray, order: int, at: np.ndarray | None = None) -> np.ndarray:
    """A hash of the ``order`` symbols that end at each place (at all places: those before the first count as none)."""
    out = np.zeros(len(code) if at is None else len(at), dtype=np.uint64)
    for k in range(order - 1, -1, -1):  # the farthest first
        out *= _BASE
        if at is not None:
            out += code[at - k]
        elif k:
            out[k:] += code[:-k]
        else:
            out += code
    return out


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that puts equal values together, where each run of them starts in it, and their numbers."""
    order = np.argsort(values)
    head = runs(values[order])
    return order, head, np.diff(head, append=len(values))


def _key(order: int, raw: np.ndarray, fold: int) -> np.ndarray:
    return mix(raw + np.uint64((order * _ORDER + fold * _FOLD) & 0xFFFFFFFFFFFFFFFF))


def _version(text: str) -> list:
    """Two hashes that tell texts apart."""
    return [F.xxhash64(text).alias("_k1"), F.hash(text).alias("_k2")]


def _counted_texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """_text, _k1, _k2 of one row of each distinct text: of copies, that of the smallest id."""
    has = docs.filter(F.col(text).isNotNull())
    ident = F.col(doc_id).cast("string") if doc_id in docs.columns else F.lit(None).cast("string")
    copies = staged(has.select(*_version(text), ident.alias("_id")).groupBy("_k1", "_k2").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
                    .filter("_n > 1").drop("_n").withColumn("_copied", F.lit(True)), "op3-copies")
    rows = has.select(F.col(text).alias("_text"), *_version(text), ident.alias("_id"))
    if copies.isEmpty():
        return rows.drop("_id")
    known = F.broadcast(copies) if copies.count() <= COPIES_BROADCAST else copies
    return rows.join(known, ["_k1", "_k2"], "left").filter("_copied is null or _id <=> _first").select("_text", "_k1", "_k2")


def count_ngrams(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """fold, g, n: how often each n-gram of the highest order occurs in the distinct texts of a half."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            code = np.concatenate([p[0] for p in parts])
            shift = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
            at = np.concatenate([p[1] + s for p, s in zip(parts, shift)])
            fold = np.concatenate([p[2] for p in parts])
            top = _raw(code, ORDER)[at]
            for f in (0, 1):
                own = fold == f
                order, head, n = _groups(top[own])
                where = at[own][order[head]]
                grams = np.ascontiguousarray(code[where[:, None] + np.arange(1 - ORDER, 1)]).view(f"<U{ORDER}").ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), f, np.int32)), pa.array(grams.tolist(), pa.string()), pa.array(n.astype(np.int64))], names=["fold", "g", "n"])

        parts, size, seen = [], 0, set()
        for batch in batches:
            for part in slices(batch, "_text"):
                k1, k2 = part.column("_k1").to_numpy(), part.column("_k2").to_numpy()
                fresh = []
                for key in zip(k1.tolist(), k2.tolist()):
                    fresh.append(key not in seen)
                    seen.add(key)
                code, at, row, _ = _symbols(part.column("_text"))
                own = np.array(fresh, dtype=bool)[row] if len(row) else np.zeros(0, bool)
                parts.append((code, at[own], (k1 & 1)[row[own]]))
                size += len(code)
                if size >= FLUSH:
                    yield from flush(parts)
                    parts, size, seen = [], 0, set()
        if parts:
            yield from flush(parts)

    return _counted_texts(docs, text, doc_id).mapInArrow(task, "fold int, g string, n long").groupBy("fold", "g").agg(F.sum("n").alias("n"))


@dataclass
class NgramModel:
    """``entries`` (key, log, back) of both halves' n-grams, the same as sorted arrays by hash range, and by half the log probability of a new symbol."""

    entries: DataFrame
    ranges: DataFrame
    n_entries: int
    floors: tuple[float, float]


def _cut(cuts: dict[tuple[int, int], np.ndarray], order: int) -> Column:
    """The discount of a count ``n`` in half ``fold``."""
    of = [F.element_at(F.array(*map(F.lit, cuts[order, f][1:].tolist())), F.least(F.col("n"), F.lit(3)).cast("int")) for f in (0, 1)]
    return F.when(F.col("fold") == 0, of[0]).otherwise(of[1])


def ngram_tables(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, tuple[float, float]]:
    """(fold, g, p, back) of the n-grams of all orders, and by half the probability of a new symbol.

    The highest order uses the counts, lower orders the number of distinct
    symbols before an n-gram. What the discounts of a context's n-grams free goes
    to the next lower order, the lowest to the uniform distribution over its
    symbols and one more.
    """
    levels = {ORDER: staged(count_ngrams(docs, text, doc_id), f"op3-{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = staged(levels[k + 1].groupBy("fold", F.substring("g", 2, k).alias("g")).agg(F.count("*").alias("n")), f"op3-{k}")
    few: dict[tuple[int, int], list[int]] = {(k, f): [0] * 4 for k in levels for f in (0, 1)}
    every = None
    for k, level in levels.items():
        part = level.filter("n <= 4").groupBy("fold", "n").count().withColumn("k", F.lit(k))
        every = part if every is None else every.unionByName(part)
    for r in every.collect():  # 4 counts of 2 halves of each order
        few[r.k, r.fold][r.n - 1] = r["count"]
    cuts = {key: discounts(v) for key, v in few.items()}
    low = {r.fold: r for r in levels[1].groupBy("fold").agg(F.count("*").alias("v"), F.sum("n").alias("total"), F.sum(_cut(cuts, 1)).alias("freed")).collect()}
    floors = tuple(low[f].freed / low[f].total / (low[f].v + 1) if f in low else 1.0 for f in (0, 1))
    total = F.when(F.col("fold") == 0, float(low[0].total if 0 in low else 1)).otherwise(float(low[1].total if 1 in low else 1))
    floor = F.when(F.col("fold") == 0, floors[0]).otherwise(floors[1])
    p = staged(levels[1].select("fold", "g", ((F.col("n") - _cut(cuts, 1)) / total + floor).alias("p")), "op3-p1")
    out = []
    for k in range(2, ORDER + 1):
        rows = levels[k].select("fold", "g", "n", _cut(cuts, k).alias("cut"), F.substring("g", 1, k - 1).alias("c"), F.substring("g", 2, k - 1).alias("low"))
        context = staged(rows.groupBy("fold", "c").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("back")), f"op3-c{k}")
        # A context that starts a text ends no n-gram: it has a back-off weight and no probability.
        out.append(p.join(context.select("fold", F.col("c").alias("g"), "back"), ["fold", "g"], "full_outer"))
        lower = p.select("fold", F.col("g").alias("low"), F.col("p").alias("below"))
        p = staged(rows.join(context, ["fold", "c"]).join(lower, ["fold", "low"])
                   .select("fold", "g", ((F.col("n") - F.col("cut")) / F.col("total") + F.col("back") * F.col("below")).alias("p")), f"op3-p{k}")
    out.append(p.withColumn("back", F.lit(1.0)))
    table = out[0]
    for t in out[1:]:
        table = table.unionByName(t)
    return table, floors


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of n-grams given as text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        grams = np.array(batch.column("g").to_pylist(), dtype=f"<U{ORDER}")
        code = grams.view(np.uint32).reshape(len(grams), ORDER).astype(np.uint64)
        order = np.asarray(pc.utf8_length(batch.column("g")))
        fold = np.asarray(batch.column("fold"))
        key = np.zeros(len(grams), dtype=np.uint64)
        for k in range(1, ORDER + 1):
            raw = np.zeros(len(grams), dtype=np.uint64)
            for j in range(k):  # as _raw does
                raw = raw * _BASE + code[:, j]
            for f in (0, 1):
                here = (order == k) & (fold == f)
                key[here] = _key(k, raw[here], f)
        logs, backs = (np.log(np.asarray(pc.fill_null(batch.column(c), 1.0))).astype(np.float32) for c in ("p", "back"))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(logs), pa.array(backs)], names=["key", "log", "back"])


def _packed(table: pa.Table) -> pa.Table:
    """A hash range as sorted arrays."""
    key = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([key[order].tobytes()], pa.binary()),
                     *[pa.array([table.column(c).to_numpy()[order].tobytes()], pa.binary()) for c in ("log", "back")]], names=["part", "keys", "logs", "backs"])


def fit_model(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> NgramModel:
    table, floors = ngram_tables(docs, text, doc_id)
    entries = staged(table.mapInArrow(_hashed, "key long, log float, back float"), "op3-entries")
    n = entries.count()
    bits = max(1, (n // RANGE_ENTRIES).bit_length())
    part = F.shiftrightunsigned("key", 64 - bits).cast("int")  # ranges in the order of their unsigned keys
    ranges = staged(entries.withColumn("part", part).groupBy("part").applyInArrow(_packed, "part int, keys binary, logs binary, backs binary"), "op3-model")
    return NgramModel(entries, ranges, n, tuple(float(np.log(f)) for f in floors))


#: Sorted keys, their log probabilities and log back-off weights.
Arrays = tuple[np.ndarray, np.ndarray, np.ndarray]


def model_arrays(model: NgramModel) -> Arrays:
    """The ranges one after another: sorted as a whole."""
    rows = sorted(model.ranges.toLocalIterator(), key=lambda r: r.part)
    return tuple(np.concatenate([np.frombuffer(r[c], dtype) for r in rows] or [np.zeros(0, dtype)]) for c, dtype in (
        ("keys", np.uint64), ("logs", np.float32), ("backs", np.float32)))


def _found(arrays: Arrays, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(arrays[0]):
        return np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=np.int64)
    at = np.minimum(np.searchsorted(arrays[0], key), len(arrays[0]) - 1)
    return arrays[0][at] == key, at


def log_probabilities(arrays: Arrays, code: np.ndarray, at: np.ndarray, fold: int, floor: float) -> np.ndarray:
    """Of the symbol at each place after those before it, in the model of a half: the longest n-gram known, less what backing off to it costs."""
    out = np.zeros(len(at))
    live = np.arange(len(at))
    for order in range(ORDER, 0, -1):
        hit, where = _found(arrays, _key(order, _raw(code, order, at[live]), fold))
        out[live[hit]] += arrays[1][where[hit]]
        live = live[~hit]
        if order > 1:
            known, where = _found(arrays, _key(order - 1, _raw(code, order - 1, at[live] - 1), fold))
            out[live[known]] += arrays[2][where[known]]
    out[live] += floor
    return out


def _losses(part: pa.RecordBatch, arrays: Arrays, floors: tuple[float, float]) -> pa.RecordBatch:
    """_k1, _k2, n, loss of the texts of a slice."""
    code, at, row, words = _symbols(part.column("_text"))
    top = _raw(code, ORDER)[at]
    fold = (part.column("_k1").to_numpy() & 1)[row]
    total = np.zeros(part.num_rows)
    for f in (0, 1):
        own = fold == f
        order, head, n = _groups(top[own])
        logs = log_probabilities(arrays, code, at[own][order[head]], 1 - f, floors[1 - f])
        total += np.bincount(row[own][order], np.repeat(logs, n), part.num_rows)
    size = np.bincount(row, minlength=part.num_rows)
    return pa.RecordBatch.from_arrays([part.column("_k1"), part.column("_k2"), pa.array(words.astype(np.int64)), pa.array(-total / np.maximum(size, 1))],
                                      names=["_k1", "_k2", "n", "loss"])


LOSS = "_k1 long, _k2 int, n long, loss double"


def text_losses(docs: DataFrame, model: NgramModel, text: str = "text", broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """_k1, _k2, n, loss of each distinct text: its number of words, nats per code point."""
    texts = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("_text"), *_version(text))
    if model.n_entries > broadcast_entries:
        return _losses_by_join(texts, model)
    arrays, floors = docs.sparkSession.sparkContext.broadcast(model_arrays(model)), model.floors

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                yield _losses(part, arrays.value, floors)

    return texts.mapInArrow(task, LOSS).dropDuplicates(["_k1", "_k2"])


def _losses_by_join(texts: DataFrame, model: NgramModel) -> DataFrame:
    """The same with a model of any size: blocks of texts ask for their n-grams in a join."""
    texts = texts.dropDuplicates(["_k1", "_k2"])
    total = texts.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    blocks = max(16, total // BLOCK_BYTES)
    texts = staged(texts.withColumn("_block", F.pmod("_k1", F.lit(blocks)).cast("int")), "op3-blocks")
    floors = model.floors

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                code, at, row, _ = _symbols(part.column("_text"))
                fold, block = (1 - (part.column("_k1").to_numpy() & 1))[row], part.column("_block").to_numpy()[row]
                for b in np.unique(block):
                    for f in (0, 1):
                        own = at[(fold == f) & (block == b)]
                        keys = [_key(k, _raw(code, k, own), f) for k in range(1, ORDER + 1)] + [_key(k, _raw(code, k, own - 1), f) for k in range(1, ORDER)]
                        keys = np.unique(np.concatenate(keys))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), b, np.int32)), pa.array(keys.view(np.int64))], names=["_block", "key"])

    answers = texts.mapInArrow(ask, "_block int, key long").distinct().join(model.entries, "key")

    def score(rows: pa.Table, known: pa.Table) -> pa.Table:
        key = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        arrays = (key[order], known.column("log").to_numpy()[order], known.column("back").to_numpy()[order])
        return pa.Table.from_batches([_losses(part, arrays, floors) for batch in rows.to_batches() for part in slices(batch, "_text")],
                                     pa.schema([("_k1", pa.int64()), ("_k2", pa.int32()), ("n", pa.int64()), ("loss", pa.float64())]))

    return texts.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(score, LOSS)


QUARTILE = 0.6745  # of a normal distribution, in standard deviations


def fit_bands(docs: DataFrame, model: NgramModel, text: str = "text", lang: str = "lang", spread: float = 5.0, low_share: float = 0.001,
              losses: DataFrame | None = None) -> dict[str | None, tuple[float, float]]:
    """Lowest and highest loss kept, by language (null is one), from quantiles over the distinct texts of MIN_WORDS words or more."""
    losses = text_losses(docs, model, text) if losses is None else losses
    texts = docs.select(F.col(lang).cast("string").alias("lang"), *_version(text)).distinct()
    shares = F.array(*map(F.lit, (low_share, 0.25, 0.5, 0.75)))
    rows = (texts.join(losses.filter(F.col("n") >= MIN_WORDS), ["_k1", "_k2"])
            .groupBy("lang").agg(F.percentile_approx("loss", shares, 10_000).alias("q")).collect())  # one row a language
    out = {}
    for r in rows:
        least, first, mid, third = r.q
        low = min(least, mid - spread * (mid - first) / QUARTILE) if first < mid else -np.inf
        out[r.lang] = (low, mid + spread * (third - mid) / QUARTILE if third > mid else np.inf)
    return out


RESULT = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("loss", T.DoubleType())]


def _base(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    data, bounds = text_bytes(part.column("_text"))
    w = find_words(part.column("_text"))
    n_words = np.bincount(w.row, minlength=w.n_rows)
    space = np.zeros(256, dtype=np.int64)
    space[:128] = 1
    space[192:] = 1  # first bytes of code points
    space[list(WORD_SPACE)] = 0
    sym = np.zeros(256, dtype=np.int64)
    sym[list(SYMBOLS)] = 1

    def per_row(weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(weights[data])])
        return total[bounds[1:]] - total[bounds[:-1]]

    at, h = hash_windows(hash_words(w), w.row, 3)
    order = np.lexsort((h, w.row[at]))
    r, x = w.row[at][order], h[order]
    same = (r[1:] == r[:-1]) & (x[1:] == x[:-1])
    again = np.zeros(len(at), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    covered = np.zeros(len(w.row) + 3, dtype=bool)
    starts = at[order][again]
    for j in range(3):
        covered[starts + j] = True
    n_repeat = np.bincount(w.row, weights=covered[:len(w.row)], minlength=w.n_rows).astype(np.int64)
    dup_lines = np.zeros(w.n_rows, dtype=np.int64)
    for k, t in enumerate(part.column("_text").to_pylist()):
        if t and "\n" in t:
            lines = [x for x in t.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
            dup_lines[k] = len(lines) - len(set(lines))
    return n_words, per_row(space), per_row(sym), dup_lines, n_repeat


def judge(docs: DataFrame, model: NgramModel, bands: dict[str | None, tuple[float, float]], carry: Iterable[str] = ("doc_id",),
          text: str = "text", lang: str = "lang", losses: DataFrame | None = None) -> DataFrame:
    """Counts and verdict of every row, after the carried columns (which win over result columns of their name)."""
    carry = list(carry)
    new = [f for f in RESULT if f.name not in carry]
    counted = RESULT[:6]
    # A carried text goes to the tasks and back once, as _text.
    names = ["_text" if c == text else f"_c{k}" for k, c in enumerate(carry)]
    kept = {n: F.col(c).alias(n) for n, c in zip(names, carry)}
    inner = [*kept, "_lang", "_k1", "_k2"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                n_words, chars, symbols, lines, repeat = _base(part)
                failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in inner] + [pa.array(v) for v in (n_words, chars, symbols, lines, repeat, failed)],
                                                 names=[*inner, *(f"_r_{f.name}" for f in counted)])

    src = docs.select(*(kept | {"_text": F.col(text).alias("_text")}).values(), F.col(lang).cast("string").alias("_lang"), *_version(text))
    types = T.StructType([src.schema[c] for c in inner] + [T.StructField(f"_r_{f.name}", f.dataType) for f in counted])
    losses = text_losses(docs, model, text) if losses is None else losses
    rows = src.mapInArrow(task, types).join(losses.select("_k1", "_k2", F.col("loss").alias("_r_loss")), ["_k1", "_k2"], "left")
    loss = F.coalesce("_r_loss", F.lit(0.0))
    inside = F.lit(True)
    if bands:  # one row a language
        limits = docs.sparkSession.createDataFrame([(k, float(a), float(b)) for k, (a, b) in bands.items()], "_of string, _low double, _high double")
        rows = rows.join(F.broadcast(limits), F.col("_lang").eqNullSafe(F.col("_of")), "left")
        inside = F.coalesce(loss.between(F.col("_low"), F.col("_high")), F.lit(True))
    found = {f.name: F.col(f"_r_{f.name}") for f in counted} | {"kept": ~F.col("_r_base_failed") & inside, "loss": loss}
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], *[found[f.name].alias(f.name) for f in new])


def quality_rules(docs: DataFrame, carry: Iterable[str] = ("doc_id",), text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **bands) -> DataFrame:
    """Base rules and perplexity bands, model and bands taken from ``docs`` itself."""
    model = fit_model(docs, text, doc_id)
    losses = staged(text_losses(docs, model, text), "op3-losses")
    return judge(docs, model, fit_bands(docs, model, text, lang, losses=losses, **bands), carry, text, lang, losses)
