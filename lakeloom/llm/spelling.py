"""Operator 12: spelling variants by dynamic programming over sorted word lists.

1. Spark counts the words of all texts (``count_words``, partial counts first).
2. Two words within one edit share their first or their last half: of lengths m
   and m or m + 1, the first m // 2 code points or the last ones. So each word
   goes, as it is and reversed, to the lists (m, half) of its own length and of
   one less, and only words of one list are compared. A list of more than
   ``LIST_WORDS`` words is dealt into blocks, which all words of that list
   visit as queries; every task holds a block or so.
3. A list is sorted, so words with a common prefix are neighbours. For a query
   the rows of the edit matrix, a band of three cells around the diagonal, are
   computed along the list: the row of a shared prefix once for the whole range
   of words that share it (as far as adjacent longest common prefixes reach), and
   a range whose row holds no cell of at most one edit is skipped with all its
   words. All queries of a block go down one code point at a time together; a
   query that has used its edit asks only for the code points that can follow.
4. A word's near words give its form; roots follow forms by pointer doubling,
   some rounds of joins, each from a written table.

Defined cases: a null text has no words; a null doc_id deletes nothing; repeated
rows all count; ties go to the smallest word in code-point order; an empty table
or one without qualifying words gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import staged
from lakeloom.llm.words import runs

MIN_LENGTH, MIN_COUNT, TIMES = 6, 5, 5
LIST_WORDS = 20_000
CHUNK_WORDS = 20_000  # that a task scans together
BROADCAST_ROWS = 500_000
BETWEEN = "[^a-zÀ-ÿ]+"  # after A-Z are lower case
DELETE_EVERY = 199
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BOTH, _LISTED, _QUERY = 0, 1, 2
_FAR = np.int8(2)


def _misspelt(run: Column, doc_id: Column) -> Column:
    """The run without one code point, for one in DELETE_EVERY runs by a hash of document and run."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DELETE_EVERY == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", misspell: bool = False,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: runs of letters, A-Z in lower case, of ``min_length`` code points that occur ``min_count`` times."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    found = docs.select(F.col(doc_id).alias("_id"), F.explode(F.split(low, BETWEEN)).alias("word")).filter(F.length("word") >= min_length)
    if misspell:
        found = found.withColumn("word", _misspelt(F.col("word"), F.col("_id"))).filter(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _lists(vocabulary: DataFrame, list_words: int) -> DataFrame:
    """key, m, side, block, role, word (reversed on side 1), n: the rows of all lists."""
    size = F.length("word")
    side = lambda k, w, m: F.struct(m.alias("m"), F.lit(k).alias("side"), w.alias("word"), F.substring(w, F.lit(1), F.floor(m / 2).cast("int")).alias("half"))
    back = F.reverse("word")
    entries = F.filter(F.array(*[side(k, w, m) for m in (size, size - 1) for k, w in ((0, F.col("word")), (1, back))]), lambda e: e["m"] >= MIN_LENGTH)
    rows = vocabulary.select("n", F.explode(entries).alias("e")).select("e.*", "n").withColumn("key", F.concat_ws(":", "side", "m", "half")).drop("half")
    hot = staged(rows.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > list_words)
                 .select("key", F.ceil(F.col("size") / list_words).cast("int").alias("blocks")), "op12-hot")
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    own = F.struct(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"), F.lit(_LISTED).alias("role"))
    visits = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), F.lit(_QUERY).alias("role")))
    alone = F.array(F.struct(F.lit(0).alias("block"), F.lit(_BOTH).alias("role")))
    return (rows.join(hot, "key", "left").withColumn("_at", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(F.concat(F.array(own), visits))))
            .select("key", "m", "side", "_at.block", "_at.role", "word", "n"))


def _letters(arr) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, a byte each (none is beyond U+00FF), and the words' bounds."""
    arr = pa.concat_arrays(arr.chunks) if isinstance(arr, pa.ChunkedArray) else arr
    arr = arr.cast(pa.large_string())
    bounds = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
    lead = data == 0xC3
    after = np.concatenate([[0], np.cumsum(~lead)])
    data = np.where((data & 0xC0) == 0x80, data + np.uint8(0x40), data)[~lead]
    return data, after[bounds - bounds[0]]


def _at(data: np.ndarray, bounds: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The code point at a place of each row's word, 0 before and beyond it."""
    inside = (place >= 0) & (place < bounds[row + 1] - bounds[row])
    return np.where(inside, data[np.where(inside, bounds[row] + place, 0)], 0) if len(data) else np.zeros(len(row), np.uint8)


def scan(data: np.ndarray, bounds: np.ndarray, listed: np.ndarray, query: np.ndarray, group: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, listed row) of one group whose words are exactly one edit apart.

    Rows are words of ``data`` with ``bounds``; ``listed`` are rows in the order
    of their words within ascending groups, ``query`` rows of any order. All
    words of a group share their first ``shared`` code points.
    """
    # A node is a range of listed words with a common prefix; at first each group is one.
    names, first = np.unique(group[listed], return_index=True)
    node_from, node_to = first, np.append(first[1:], len(listed))
    node = np.searchsorted(names, group[query])
    known = (node < len(names)) & (names[np.minimum(node, len(names) - 1)] == group[query]) if len(names) else np.zeros(len(query), bool)
    q, node = query[known], node[known]
    cells = np.tile(np.array([[1], [0], [1]], dtype=np.int8), (1, len(q)))  # one edit off, on and one edit off the diagonal
    size = np.diff(bounds)
    level, pairs = 0, []
    while len(q):
        # The ranges' words fall by their next code point into smaller ranges; a word that ends here has a 0.
        many = node_to - node_from
        parent = np.repeat(np.arange(len(node_from)), many)
        place = np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many) + node_from[parent]
        letter = _at(data, bounds, listed[place], shared[listed[place]] + level).astype(np.int64)
        code = (parent << 8) | letter
        head = runs(code)
        child = code[head]
        child_from, child_to = place[head], np.append(place[head[1:] - 1], place[-1]) + 1
        # Rows with an edit left meet all ranges below theirs, the others those of the code points that can follow.
        depth = shared[q] + level
        around = [_at(data, bounds, q, depth + k).astype(np.int64) for k in (-1, 0, 1)]
        free = cells.min(axis=0) == 0
        low, high = np.searchsorted(child, node[free] << 8), np.searchsorted(child, (node[free] + 1) << 8)
        which = [np.repeat(np.flatnonzero(free), high - low)]
        below = [np.arange(len(which[0])) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)]
        spent = np.flatnonzero(~free)
        asked: list[np.ndarray] = []
        for letter in [np.zeros(len(spent), np.int64), *(a[spent] for a in around)]:
            want = (node[spent] << 8) | letter
            at = np.minimum(np.searchsorted(child, want), len(child) - 1)
            hit = child[at] == want
            for earlier in asked:
                hit &= letter != earlier
            asked.append(letter)
            which.append(spent[hit])
            below.append(at[hit])
        which, below = np.concatenate(which), np.concatenate(below)
        letter = child[below] & 0xFF
        rest = size[q[which]] - depth[which]  # of the query beyond the prefix's length
        ends = letter == 0
        cell = np.clip(rest[ends] + 1, 0, 2)
        near = (np.abs(rest[ends]) <= 1) & (cells[cell, which[ends]] == 1)
        pairs.append((q[which[ends][near]], listed[child_from[below[ends][near]]]))
        which, below, letter, rest = (x[~ends] for x in (which, below, letter, rest))
        old = cells[:, which]
        differ = [(letter != a[which]).astype(np.int8) for a in around]
        new0 = np.where(rest >= 0, np.minimum(old[0] + differ[0], old[1] + 1), _FAR)
        new1 = np.where(rest >= 1, np.minimum(np.minimum(old[1] + differ[1], old[2] + 1), new0 + 1), _FAR)
        new2 = np.where(rest >= 2, np.minimum(old[2] + differ[2], new1 + 1), _FAR)
        cells = np.minimum(np.stack([new0, new1, new2]), _FAR).astype(np.int8)
        alive = cells.min(axis=0) < _FAR
        q, below, cells = q[which[alive]], below[alive], cells[:, alive]
        used, node = np.unique(below, return_inverse=True)
        node_from, node_to = child_from[used], child_to[used]
        level += 1
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs])


NEAR = "word string, near string, near_n long"


def _scanned(table: pa.Table) -> pa.RecordBatch:
    """The near pairs that the lists of some rows (sorted by key, block, role, word) are there for."""
    data, bounds = _letters(table.column("word"))
    n, m, side, role = (table.column(c).to_numpy() for c in ("n", "m", "side", "role"))
    new = np.ones(table.num_rows, dtype=bool)
    key = table.column("key").combine_chunks().dictionary_encode()
    key = (key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy()
    block = table.column("block").to_numpy()
    new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
    group = np.cumsum(new) - 1
    a, b = scan(data, bounds, np.flatnonzero(role != _QUERY), np.flatnonzero(role != _LISTED), group, (m // 2).astype(np.int64))
    size = np.diff(bounds)
    # A pair belongs to the list of its shorter word's length, and to the reversed one only if the halves at the front differ.
    own = np.minimum(size[a], size[b]) == m[a]
    a, b = a[own], b[own]
    same, half = side[a] == 1, m[a] // 2
    for k in range(int(half.max(initial=0))):
        at = np.flatnonzero(same & (k < half))
        same[at] = _at(data, bounds, a[at], size[a[at]] - 1 - k) == _at(data, bounds, b[at], size[b[at]] - 1 - k)
    a, b = a[~same], b[~same]
    turned = side[a] == 1
    letters = ["".join(map(chr, data[bounds[i]:bounds[i + 1]][::-1 if t else 1].tolist())) for x in (a, b) for i, t in zip(x.tolist(), turned.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(letters[:len(a)], pa.string()), pa.array(letters[len(a):], pa.string()), pa.array(n[b], pa.int64())], names=["word", "near", "near_n"])


def near_words(vocabulary: DataFrame, list_words: int = LIST_WORDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """word, near, near_n: all ordered pairs of words one edit apart, each once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < chunk_words:
                continue
            key, block, role = (held.column(c).combine_chunks() for c in ("key", "block", "role"))
            last = np.array([k == key[-1] for k in key]) & (block.to_numpy() == block[-1].as_py())
            first = int(np.argmax(last))
            if first:
                yield _scanned(held.slice(0, first))
                held = held.slice(first)
            elif (role.to_numpy() == _QUERY).any():  # a block whose list is complete: its queries so far
                yield _scanned(held)
                held = held.filter(pa.array(role.to_numpy() == _LISTED))
        if held is not None and held.num_rows:
            yield _scanned(held)

    return (_lists(vocabulary, list_words).repartition("key", "block").sortWithinPartitions("key", "block", "role", "word")
            .mapInArrow(task, NEAR))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of rows (word, form): forms followed to the last, by pointer doubling."""
    ahead = staged(forms.select("word", F.col("form").alias("root")), "op12-roots")
    while True:
        to = ahead.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        ahead = staged(ahead.join(to, F.col("root") == F.col("_at"), "left")
                       .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "op12-roots")
        if ahead.filter("moved").isEmpty():
            return ahead.drop("moved")
        ahead = ahead.drop("moved")


def variants(vocabulary: DataFrame, times: int = TIMES, list_words: int = LIST_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a vocabulary (word, n)."""
    near = near_words(vocabulary, list_words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("c"), F.col("near").alias("w"))).alias("b"))
    found = F.col("b").isNotNull() & (-F.col("b.c") >= times * F.col("n"))
    rows = staged(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(found, F.col("b.w")).alias("form"), F.when(found, -F.col("b.c")).alias("form_n")), "op12-forms")
    return (rows.join(roots(rows.filter("form is not null").select("word", "form")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", misspell: bool = False, list_words: int = LIST_WORDS) -> DataFrame:
    """``variants`` of the words of all documents; ``misspell`` first deletes a code point of some runs (``_misspelt``)."""
    return variants(staged(count_words(docs, text, doc_id, misspell), "op12-words"), list_words=list_words)
