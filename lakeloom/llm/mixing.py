"""Operator 6: mixing sources to target weights by blocks of words.

Each source's documents, in a pseudorandom order, form one run of words that is
cut into blocks of ``BLOCK`` words. A mixture is a list of slots dealt over
output shards: every shard draws how many of its slots go to each source (the
whole part of a source's expected share is fixed, the rest is a multinomial
draw, which keeps the mean and most of the variance away). The k-th slot of a
source takes block ``permutation(k mod n)`` of its n blocks, with another
permutation for each round k div n, so a block is taken once a round and at
most ``MAX_REPEAT`` times. Slots and blocks are joined by block number.

Targets: sources in code-point order, null last, weigh 1, 2, 3, repeating, and
share all words; a target stops at ``MAX_REPEAT`` times its source's size, what
is over is shared by weight among the others. The table of sources, one row
each, is the only thing the driver holds.

All draws are hashes of the seed and of what they are for, so reruns agree.
Order inside a source comes from sums over hash chunks and then inside chunks,
so a source with a third of all rows is no single task.

Defined cases: a null text has size 0; a null source is a source, the last one;
documents of size 0 are taken 0 times; rows equal in doc_id, text and source are
numbered and mixed as documents of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import staged
from lakeloom.llm.words import mix as mix64

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
SHARD_SLOTS = 8192
CHUNK_ROWS = 100_000
MAX_REPEAT = 3
SEED = 20240229


def sized(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, source, size and what tells rows apart: a hash of the text and a number among equal rows."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("version"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "version", "source").orderBy("size")))


def targets(rows: DataFrame) -> DataFrame:
    """source, source_no, weight, source_size, target: one row a source."""
    cap, level = F.col("source_size") * float(MAX_REPEAT), F.col("level")
    # One row a source: these windows are over that small table.
    whole = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy(F.col("need"), F.col("source_no"))
    out = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("source_no", F.row_number().over(whole) - 1)
           .withColumn("weight", F.col("source_no") % 3 + 1)
           .withColumn("need", cap / F.col("weight"))
           .withColumn("before", F.coalesce(F.sum(cap).over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("rest", F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
           .withColumn("total", F.sum("source_size").over(by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    # Sources by the level at which they are full: those full below the level that the others then share.
    out = out.withColumn("level", (F.col("total") - F.col("before")) / F.col("rest")).withColumn("full", F.col("need") <= level)
    free = F.max(F.when(~F.col("full"), level)).over(by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (out.withColumn("target", F.when(F.col("full"), cap).otherwise(free * F.col("weight")))
            .select("source", "source_no", "weight", "source_size", "target"))


def _permuted(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 chosen by ``key``: Feistel rounds over the next power of four, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = k.astype(np.uint64)
    live = np.arange(len(x))
    while len(live):
        left, right = x[live] >> half[live], x[live] & mask[live]
        for r in range(4):
            left, right = right, left ^ (mix64(right + key[live] + np.uint64(r * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)) & mask[live])
        x[live] = (left << half[live]) | right
        live = live[x[live] >= n[live].astype(np.uint64)]
    return x.astype(np.int64)


def _key(*parts) -> np.ndarray:
    h = np.zeros(np.broadcast(*parts).shape, dtype=np.uint64)
    for p in parts:
        h = mix64(h + np.asarray(p).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h


def slots(sources: list, spark, seed: int = SEED, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, position, source_no, round, block: which block stands at each position of each output shard."""
    live = [s for s in sources if s.source_size]
    number = np.array([s.source_no for s in live], dtype=np.int64)
    blocks = np.array([-(-s.source_size // block) for s in live], dtype=np.int64)
    wanted = np.array([n * s.target / s.source_size for n, s in zip(blocks, live)])
    shards = max(1, int(np.ceil(wanted.sum() / shard_slots)))
    shared = spark.sparkContext.broadcast((number, blocks, wanted / shards))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_, blocks_, share = shared.value
        whole, part = np.floor(share).astype(np.int64), share - np.floor(share)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                rng = np.random.Generator(np.random.PCG64([seed, shard]))
                extra = int(part.sum()) + int(rng.random() < part.sum() % 1)
                n = whole + (rng.multinomial(extra, part / part.sum()) if extra else 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), shard)), pa.array(number_), pa.array(blocks_), pa.array(n)],
                                                 names=["shard", "source_no", "blocks", "n"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                c = {f: batch.column(f).slice(at, 64).to_numpy() for f in batch.schema.names}
                row = np.repeat(np.arange(len(c["n"])), c["n"])
                j = np.arange(len(row)) - np.repeat(np.cumsum(c["n"]) - c["n"], c["n"])
                k, n, no, shard = c["base"][row] + j, c["blocks"][row], c["source_no"][row], c["shard"][row]
                round_ = k // n
                place = _permuted(c["offset"][row] + j, c["slots"][row], _key(seed, 1, shard))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(place), pa.array(no), pa.array(round_), pa.array(_permuted(k % n, n, _key(seed, 2, no, round_)))],
                    names=["shard", "position", "source_no", "round", "block"]).filter(pa.array(round_ < MAX_REPEAT))

    drawn = spark.range(shards).mapInArrow(draw, "shard long, source_no long, blocks long, n long")
    before = Window.unboundedPreceding, -1
    counted = (drawn.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy("shard").rowsBetween(*before)), F.lit(0)))
               .withColumn("offset", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("source_no").rowsBetween(*before)), F.lit(0)))
               .withColumn("slots", F.sum("n").over(Window.partitionBy("shard"))).filter("n > 0"))
    return counted.mapInArrow(expand, "shard long, position long, source_no long, round long, block long")


def laid_out(rows: DataFrame, sources: DataFrame, total_rows: int, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """doc_id, version, copy, source_no, block, begin, words: the part of each block that lies in each document."""
    chunks = max(8, total_rows // CHUNK_ROWS)
    keyed = (rows.filter("size > 0").join(sources.select("source", "source_no"), rows["source"].eqNullSafe(sources["source"]))
             .select("doc_id", "version", "copy", "size", "source_no", F.xxhash64("doc_id", "version", "copy", F.lit(seed)).alias("key"))
             .withColumn("chunk", F.pmod("key", F.lit(chunks))))
    before = Window.unboundedPreceding, -1
    heads = (keyed.groupBy("source_no", "chunk").agg(F.sum("size").alias("n"))
             .withColumn("head", F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk").rowsBetween(*before)), F.lit(0)))
             .select("source_no", "chunk", "head"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("key", "doc_id", "version", "copy").rowsBetween(*before)
    start, end = F.col("start"), F.col("start") + F.col("size")
    return (keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(heads, ["source_no", "chunk"])
            .withColumn("start", F.col("head") + F.col("inside"))
            .withColumn("block", F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))))
            .withColumn("begin", F.greatest(start, F.col("block") * block) - start)
            .withColumn("words", F.least(end, (F.col("block") + 1) * block) - start - F.col("begin"))
            .select("doc_id", "version", "copy", "source_no", "block", "begin", "words"))


def mixture(docs: DataFrame, seed: int = SEED, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, **columns) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with sizes, the sources with targets, and the mixture: shard, position, round and the words that stand there."""
    rows = staged(sized(docs, **columns), "op6-sizes")
    sources = staged(targets(rows).coalesce(1), "op6-sources")
    placed = laid_out(rows, sources, rows.count(), seed, block)
    dealt = slots(sources.collect(), docs.sparkSession, seed, block, shard_slots)
    # The planner takes the slots for as few as the shards that they are expanded from.
    return rows, sources, dealt.hint("merge").join(placed.hint("merge"), ["source_no", "block"])


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    rows, sources, mixed = mixture(docs, **options)
    key = ["doc_id", "version", "copy", "source_no"]
    sums = mixed.groupBy(*key).agg(F.sum("words").alias("taken"))
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop("source")
    same = [rows[k].eqNullSafe(sums[k]) for k in key]
    return rows.join(sums, same, "left").select(rows["doc_id"], rows["size"], "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, columns: list[str], text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """The mixture as documents: for each round a document is drawn in, its drawn words, with ``columns`` of its row.

    A document drawn whole keeps its text as it is; else the drawn stretches are
    joined by one space. ``n_chars`` is counted anew.
    """
    _, sources, mixed = mixture(docs, text=text, **options)
    key = ["doc_id", "version", "copy", "source_no", "round"]
    drawn = mixed.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("begin", "words"))).alias("drawn"))  # one document's blocks
    rows = docs.withColumn("_version", F.xxhash64(text)).withColumn(
        "_copy", F.row_number().over(Window.partitionBy("doc_id", "_version", "source").orderBy("doc_id")))
    rows = rows.join(sources.select(F.col("source").alias("_source"), F.col("source_no").alias("_source_no")), rows["source"].eqNullSafe(F.col("_source")))
    same = [rows[a].eqNullSafe(drawn[b]) for a, b in (("doc_id", "doc_id"), ("_version", "version"), ("_copy", "copy"), ("_source_no", "source_no"))]
    joined = rows.join(drawn, same).select(*[rows[c] for c in columns], "drawn")
    arrow_names = columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, parts in zip(batch.column(text).to_pylist(), batch.column("drawn").to_pylist()):
                words = value.encode().split()
                if sum(p["words"] for p in parts) == len(words):
                    out.append(value)
                else:
                    out.append(b" ".join(w for p in parts for w in words[p["begin"]:p["begin"] + p["words"]]).decode())
            new = {text: pa.array(out, pa.string()), n_chars: pa.array([len(t) for t in out], pa.int64())}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in arrow_names], names=arrow_names)

    return joined.mapInArrow(cut, docs.select(*columns).schema)
