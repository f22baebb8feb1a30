"""Operator 9: near-duplicate groups by b-bit MinHash.

1. One pass gives each text the size of its set of 5-word shingles, two hashes of
   its word sequence, ``BANDS`` band keys of ``ROWS`` minima each, and a packed
   signature of the low ``BITS`` bits of all minima. Texts that agree in both
   hashes form a class that its smallest doc_id stands for; only those go on.
2. Band keys shared by several classes are buckets. Every member is compared
   with the bucket's most copied text: equal low bits are counted, the share
   that equals by chance is taken off, and pairs whose estimate is within
   ``MARGIN`` of the threshold stay. The best of a member's candidates is
   confirmed on the full shingle sets. Links give groups.
3. Members of buckets that still hold several groups are compared across groups
   with the same estimate, in tasks of two blocks of a bucket; those that may
   have a link meet again with their texts, two parts of at most some
   ``BLOCK_BYTES`` each, where counts of shared shingles give all links exactly. Only links that join groups leave a task, so the pairs
   inside a group are never listed, and none that joins two groups is lost.

Nothing but row counts reaches the driver. A bucket with a third of all texts is
met by key joins whose other side has one row a bucket.

Defined cases: a null or wordless text has an empty set, links with nothing and
is its own group; fewer than five words form one shingle; rows that share a
doc_id are one document, linked by what any of their texts is linked by; a null
doc_id links like any other and never names a group, so a group of such rows
alone has a null component_id and keeps none; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import staged
from lakeloom.llm.words import find_words, hash_windows, hash_words, mix, runs, slices

SHINGLE = 5
BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
PERCENT = 75
MARGIN = 0.18  # over four standard deviations of the estimate at the threshold
BLOCK_ROWS = 8_192
BLOCK_BYTES = 32 << 20
_NO_ID = np.iinfo(np.int64).max


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(90_210))
    a, b = rng.integers(0, 1 << 32, (2, MINIMA), dtype=np.uint64).astype(np.uint32)
    return a | np.uint32(1), b


def shingle_sets(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Row and hash of each distinct shingle, sorted by both; two hashes of each row's word sequence; number of rows."""
    w = find_words(texts, lower=True)
    h = hash_words(w)
    at, s = hash_windows(h, w.row, SHINGLE)
    row = w.row[at]
    first = w.first()
    count = np.diff(first)
    place = (np.arange(len(h)) - first[w.row]).astype(np.uint64)
    seq = np.zeros((2, w.n_rows), dtype=np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        for k, c in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            seq[k, full] = np.add.reduceat(mix(h + mix(place + np.uint64(c))), first[full])
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    row, s = np.concatenate([row, few]), np.concatenate([s, mix(seq[0, few] + count[few].astype(np.uint64))])
    order = np.lexsort((s, row))
    row, s = row[order], s[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (s[1:] != s[:-1])
    return row[new], s[new], seq[0], seq[1], w.n_rows


def _minima(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MINIMA hash minima of each run of shingles."""
    a, b = _factors()
    x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(starts), MINIMA), dtype=np.uint32)
    for j in range(MINIMA):
        out[:, j] = np.minimum.reduceat(x * a[j] + b[j], starts)
    return out


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """_id, _version, k1, k2, n_shingles, bands, sig of every row; the last two null for an empty set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                row, s, k1, k2, n = shingle_sets(part.column("_text"))
                size = np.bincount(row, minlength=n)
                full = np.flatnonzero(size)
                bands, sig = [None] * n, [None] * n
                if len(full):
                    low = _minima(s, runs(row))
                    wide = low.astype(np.uint64).reshape(len(full), BANDS, ROWS)
                    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), wide.shape[:2])
                    for r in range(ROWS):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r])
                    per = 64 // BITS
                    bits = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(full), MINIMA // per, per)
                    packed = np.bitwise_or.reduce(bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS)), axis=2)
                    for k, at in enumerate(full):
                        bands[at], sig[at] = key[k].view(np.int64), packed[k].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_version"), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(size),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int64()))],
                    names=["_id", "_version", "k1", "k2", "n_shingles", "bands", "sig"])

    return _keyed(docs, text, doc_id).mapInArrow(
        task, "_id long, _version long, k1 long, k2 long, n_shingles long, bands array<long>, sig array<long>")


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(int(_NO_ID))).alias("_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("_version"),
                       F.col(text).alias("_text"))


def estimate(a: str, b: str) -> Column:
    """Similarity from packed signatures: the share of equal fields, less those that are equal by chance."""
    differ = F.lit(0)
    lowest = sum(1 << k for k in range(0, 64, BITS))
    lowest -= (1 << 64) * (lowest >> 63)
    for k in range(MINIMA * BITS // 64):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(lowest)))
    chance = 1 / (1 << BITS)
    return (1 - differ / MINIMA - chance) / (1 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) with ``linked`` from their full shingle sets. ``texts`` has c, _text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ra, sa, _, _, n = shingle_sets(part.column("at"))
                rb, sb, _, _, _ = shingle_sets(part.column("bt"))
                row, s = np.concatenate([ra, rb]), np.concatenate([sa, sb])
                order = np.lexsort((s, row))
                row, s = row[order], s[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (s[1:] == s[:-1])], minlength=n)
                union = np.bincount(ra, minlength=n) + np.bincount(rb, minlength=n) - both
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(100 * both >= percent * union)], names=["a", "b", "linked"])

    a, b = (texts.select(F.col("c").alias(x), F.col("_text").alias(x + "t")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "at", "bt").mapInArrow(task, "a long, b long, linked boolean")


def _similar(sig: np.ndarray, label: np.ndarray, side: np.ndarray, least: float) -> np.ndarray:
    """Rows with an estimate of at least ``least`` to some row of another label (and of the other side, if there are two)."""
    low = np.uint64(sum(1 << k for k in range(0, 64, BITS)))
    chance = 1 / (1 << BITS)
    most = MINIMA * (1 - chance) * (1 - least)  # differing fields
    out, two = np.zeros(len(sig), dtype=bool), side.min() != side.max()
    step = max(1, (1 << 22) // max(1, len(sig)))
    for at in range(0, len(sig), step):
        x = sig[at:at + step, None, :] ^ sig[None, :, :]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        near = np.bitwise_count(x & low).sum(2) <= most
        near &= label[at:at + step, None] != label[None, :]
        if two:
            near &= side[at:at + step, None] != side[None, :]
        out[at:at + step] = near.any(1)
    return out


def _joined(texts, label: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of labels that a link joins, as few as join all that links join: exact, from counts of shared shingles."""
    row, s, _, _, n = shingle_sets(texts)
    size = np.bincount(row, minlength=n)
    values, at = np.unique(s, return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, starts = row[order], np.searchsorted(at[order], np.arange(len(values) + 1))
    first = np.searchsorted(row, np.arange(n + 1))
    two = side.min() != side.max()
    names, root = np.unique(label, return_inverse=True)
    root = root.copy()
    common = np.bincount(root).argmax()
    found = []
    for k in np.flatnonzero(root != common):  # a pair inside the commonest label needs no look
        own = at[first[k]:first[k + 1]]
        length = starts[own + 1] - starts[own]
        place = np.repeat(starts[own], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        both = np.bincount(owner[place], minlength=n)
        linked = 100 * both >= percent * (size[k] + size - both)
        if two:
            linked &= side != side[k]
        for other in np.unique(root[linked]):
            if other != root[k]:
                found.append((int(names[other]), int(names[root[k]])))
                root[root == other] = root[k]
    return found


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable over links (a, b), for every node that has one."""
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "op9-links")
    state = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "op9-labels")
    while True:
        near = both.join(state, both["b"] == state["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = state.join(near, state["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = state.select(F.col("node").alias("up"), F.col("label").alias("top"))
        state = staged(step.join(above, step["label"] == above["up"]).select("node", "old", "top"), "op9-labels")
        moved = state.filter("old <> top").limit(1).count()
        state = state.select("node", F.col("top").alias("label"))
        if not moved:
            return state


def _named(classes: DataFrame) -> DataFrame:
    """Classes by (k1, k2) with a name c of 64 bits: k1, or a hash of both where several classes share k1."""
    shared = classes.groupBy("k1").agg(F.count("*").alias("n"), F.min("k2").alias("first")).filter("n > 1").select("k1", "first")
    return classes.join(shared, "k1", "left").withColumn("c", F.when(F.col("k2") > F.col("first"), F.xxhash64("k1", "k2")).otherwise(F.col("k1"))).drop("first")


def _dealt(rows: DataFrame, by: str, parts: str) -> DataFrame:
    """A copy of each row for every pair (low, high) of its group's parts that its own, by hash, belongs to."""
    own, other = F.pmod(F.xxhash64(by), F.col(parts)), F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    return rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("own", "other", parts)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and _version (a hash of the text) of every row."""
    least = percent / 100 - MARGIN
    rows = staged(signatures(docs, text, doc_id), "op9-signatures")
    full = rows.filter("n_shingles > 0")
    classes = staged(_named(full.groupBy("k1", "k2").agg(F.min(F.struct("_id", "_version", "bands", "sig")).alias("r"), F.count("*").alias("copies"))
                            .select("k1", "k2", "copies", F.col("r._id").alias("id"), F.col("r._version").alias("v"), "r.bands", "r.sig")), "op9-classes")
    names = classes.select("k1", "k2", "c")
    sig = classes.select("c", "sig")
    members = classes.select("c", "copies", F.explode("bands").alias("key"))
    # The most copied text of a bucket is the likeliest centre of its group.
    pivots = members.groupBy("key").agg(F.max_by("c", "copies").alias("p"), F.count("*").alias("n")).filter("n > 1")
    shared = staged(members.select("c", "key").join(pivots, "key"), "op9-buckets")

    wanted = classes.join(shared.select("c").distinct(), "c", "left_semi").select("c", F.col("id").alias("_id"), F.col("v").alias("_version"))
    texts = staged(_keyed(docs, text, doc_id).join(wanted, ["_id", "_version"]).select("c", "_text", F.octet_length("_text").cast("long").alias("bytes"))
                   .dropDuplicates(["c"]), "op9-texts")

    # Rows of one doc_id are one document: its classes are linked.
    several = (full.filter(F.col("_id") != int(_NO_ID)).groupBy("_id").agg(*[f(k).alias(f.__name__ + k) for f in (F.min, F.max) for k in ("k1", "k2")])
               .filter("mink1 < maxk1 or mink2 < maxk2").select("_id"))
    own = full.select("_id", "k1", "k2").join(several, "_id").join(names, ["k1", "k2"]).select("_id", "c").distinct()
    same = own.withColumnRenamed("c", "b").join(own.groupBy("_id").agg(F.min("c").alias("a")), "_id").select("a", "b").filter("a <> b")

    # The most similar candidate of each member first.
    stars = (shared.filter("p <> c").select(F.col("p").alias("a"), F.col("c").alias("b")).distinct()
             .join(sig.select(F.col("c").alias("a"), F.col("sig").alias("as")), "a").join(sig.select(F.col("c").alias("b"), F.col("sig").alias("bs")), "b")
             .withColumn("e", estimate("as", "bs")).filter(F.col("e") >= least))
    tried = stars.groupBy("b").agg(F.max_by("a", "e").alias("a")).select("a", "b")
    tested = staged(confirmed(tried, texts, percent), "op9-tested")
    labels = components(tested.filter("linked").select("a", "b").union(same))

    # Buckets of several groups, in blocks of BLOCK_ROWS; each two blocks of a bucket meet in one task.
    state = shared.join(labels, F.col("c") == F.col("node"), "left").select("key", "c", "n", F.coalesce("label", "c").alias("label"))
    several = state.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    state = (state.join(several, "key").withColumn("block", F.pmod(F.xxhash64("c"), blocks)).withColumn("other", other)
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "c", "label"))

    def open_rows(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = table.column("sig").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(table.num_rows, -1)
        near = _similar(x, table.column("label").to_numpy(), table.column("block").to_numpy(), least)
        return table.filter(pa.array(near)).drop_columns(["sig"])

    def links_of(table: pa.Table) -> pa.Table:
        found = _joined(table.column("_text"), table.column("label").to_numpy(), table.column("block").to_numpy(), percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    meet, part = ["key", "i", "j"], ["low", "high"]
    near = staged(state.join(sig, "c").select(*meet, "block", "c", "label", "sig").groupBy(*meet)
                  .applyInArrow(open_rows, "key long, i long, j long, block long, c long, label long"), "op9-open")
    weighed = near.join(texts.select("c", "bytes"), "c")
    parts = weighed.groupBy(*meet).agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("parts")).withColumn("parts", F.greatest("parts", F.lit(1)))
    dealt = _dealt(near.join(parts, meet), "c", "parts")
    joined = dealt.join(texts, "c").select(*meet, *part, "block", "c", "label", "_text").groupBy(*meet, *part).applyInArrow(links_of, "a long, b long")
    joined = components(staged(joined, "op9-joined"))
    moved = joined.select(F.col("node").alias("from"), F.col("label").alias("to"))
    old = labels.join(moved, labels["label"] == moved["from"], "left").select("node", F.coalesce("to", "label").alias("label"))
    alone = moved.join(labels, moved["from"] == labels["node"], "left_anti").select(F.col("from").alias("node"), F.col("to").alias("label"))
    labels = old.unionByName(alone)
    known = lambda c: F.when(c != int(_NO_ID), c)
    groups = classes.join(labels, classes["c"] == labels["node"], "left").select("k1", "k2", "id", F.coalesce("label", "c").alias("label"))
    groups = groups.join(groups.groupBy("label").agg(F.min("id").alias("component")), "label").select("k1", "k2", "component")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("_id"))
    return (rows.join(groups, ["k1", "k2"], "left")
            .select(known(F.col("_id")).cast(docs.schema[doc_id].dataType).alias("doc_id"), "n_shingles", known(component).alias("component_id"),
                    F.coalesce(known(F.col("_id")) == component, F.lit(False)).alias("kept"), "_version"))
