"""Operator 1: nearest neighbours by multi-index hashing.

Vectors are scaled to length one and centred; rotations learned on a bounded
sample (iterative quantisation: the rotation that best agrees with its own
signs) turn each into a binary code of about ``CODE_BITS`` bits. Codes are split
into 16-bit substrings, each with an index from value to codes. A code within
Hamming radius r of a query must, by the pigeonhole principle, be within r div m
of it in one of the first (r mod m) + 1 of m substrings or within one less in
one of the others, so probing those values in every index finds all codes within
the radius; full distances drop the rest, and cosines of the vectors themselves,
in double precision, rank what is left. Where the values to probe outnumber
those present, the index's directory is compared instead, to the same effect.

The radius is the one that holds ``TARGET`` of the true neighbours among the
sample; in more data neighbours are nearer, so it errs on the wide side. A query
that finds fewer than k neighbours is searched again with no radius.

Equal vectors are one entry that keeps its k + 1 smallest ids, all that can be
asked for. Entries are dealt by hash to shards of ``SHARD_ROWS``, queries to
blocks of ``QUERY_ROWS``; each block meets each shard in one task.

Defined cases: vectors that are null, zero, hold null or non-finite components
or have another dimension than most take no part, nor do rows without an id;
rows that share an id count once, with their least vector; a query has fewer
rows if there are fewer candidates; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import staged

FIT_ROWS = 10_000
FIT_QUERIES = 400
CODE_BITS = 256
TARGET = 0.97
ITERATIONS = 10
SHARD_ROWS = 65_536
MIN_SHARDS = 8
QUERY_ROWS = 8_192
SEED = 7


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id, x of the rows that take part, an id once."""
    fine = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(embedding, lambda c: c != 0)
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("x"))
    return rows.groupBy("id").agg(F.min("x").alias("x"))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def fit(sample: np.ndarray, k: int, bits: int = CODE_BITS, target: float = TARGET) -> dict:
    """Centre, rotation and radius."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    unit = _unit(sample)
    centre = unit.mean(0)
    v = unit - centre
    width = min(v.shape[1], 64)
    axes = np.linalg.eigh(v.T @ v)[1][:, ::-1][:, :width]
    low = v @ axes
    rotations = []
    for _ in range(max(1, bits // width)):
        r = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(ITERATIONS):
            a, _, b = np.linalg.svd(np.where(low @ r > 0, 1.0, -1.0).T @ low)
            r = b.T @ a.T
        rotations.append(axes @ r)
    model = {"centre": centre, "rotation": np.concatenate(rotations, axis=1)}
    pick = rng.permutation(len(unit))[:FIT_QUERIES]
    cos = unit[pick] @ unit.T
    cos[np.arange(len(pick)), pick] = -2
    near = np.argsort(-cos, axis=1)[:, :min(k, len(unit) - 1)]
    words = codes(model, sample)
    apart = np.bitwise_count(words[pick][:, None, :] ^ words[near]).sum(2)
    model["radius"] = int(np.quantile(apart, target, method="higher")) if apart.size else 0
    return model


def codes(model: dict, x: np.ndarray) -> np.ndarray:
    """Packed codes as rows of 64-bit words."""
    bits = (_unit(x) - model["centre"]) @ model["rotation"] > 0
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1).view(np.uint64)


class Index:
    """Substring indexes over codes."""

    def __init__(self, words: np.ndarray):
        self.words, self.parts = words, words.view(np.uint16)
        self.tables = []
        for j in range(self.parts.shape[1]):
            values, inverse = np.unique(self.parts[:, j], return_inverse=True)
            self.tables.append((values, inverse, np.argsort(inverse, kind="stable"), np.searchsorted(np.sort(inverse), np.arange(len(values) + 1))))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) pairs of all codes within the radius."""
        parts, m = queries.view(np.uint16), self.parts.shape[1]
        seen = np.zeros((len(queries), len(self.words)), dtype=bool)
        for j, (values, inverse, order, starts) in enumerate(self.tables):
            most = radius // m if j <= radius % m else radius // m - 1
            if most < 0:
                continue
            if most >= 16:
                seen[:] = True
                break
            if sum(comb(16, i) for i in range(most + 1)) < len(values):
                flips = np.arange(1 << 16, dtype=np.uint16)
                flips = flips[np.bitwise_count(flips) <= most]
                want = parts[:, j, None] ^ flips[None, :]
                at = np.minimum(np.searchsorted(values, want), len(values) - 1)
                q, p = np.nonzero(values[at] == want)
                bucket = at[q, p]
                size = starts[bucket + 1] - starts[bucket]
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                seen[np.repeat(q, size), order[np.repeat(starts[bucket], size) + step]] = True
            else:
                seen |= (np.bitwise_count(values[None, :] ^ parts[:, j, None]) <= most)[:, inverse]
        q, c = np.nonzero(seen)
        if radius < 64 * self.words.shape[1]:
            close = np.bitwise_count(queries[q] ^ self.words[c]).sum(1) <= radius
            q, c = q[close], c[close]
        return q, c


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(model: dict, index: pa.Table, queries: pa.Table, k: int, radius: int, batch: int = 64) -> pa.Table:
    """The k nearest of one shard for one block of queries."""
    out_q, out_v, out_s = [], [], []
    if index.num_rows and queries.num_rows:
        x, q = _matrix(index.column("x")), _matrix(queries.column("x"))
        ids, own = index.column("ids").to_pylist(), queries.column("id").to_pylist()
        first = np.array([i[0] for i in ids])
        table, words = Index(codes(model, x)), codes(model, q)
        xn, qn = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
        for at in range(0, len(q), batch):
            row, col = table.within(words[at:at + batch], radius)
            cos = np.empty(len(row))
            for lo in range(0, len(row), 100_000):
                r, c = row[lo:lo + 100_000] + at, col[lo:lo + 100_000]
                cos[lo:lo + 100_000] = np.einsum("ij,ij->i", q[r], x[c]) / (qn[r] * xn[c])
            cuts = np.searchsorted(row, np.arange(min(batch, len(q) - at) + 1))
            for n, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                best = lo + np.lexsort((first[col[lo:hi]], -cos[lo:hi]))[:k + 1]
                found = sorted((-cos[b], i) for b in best for i in ids[col[b]] if i != own[at + n])[:k]
                out_q += [own[at + n]] * len(found)
                out_v += [i for _, i in found]
                out_s += [-s for s, _ in found]
    return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` found for each row of ``queries``, itself left out."""
    spark = vectors.sparkSession
    rows = valid(vectors, vec_id, embedding)
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    rows = rows.filter(F.size("x") == d)
    # Ids beyond the k + 1 smallest of equal vectors can't be among a query's k.
    turn = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    entries = staged(rows.withColumn("turn", turn).filter(F.col("turn") <= k + 1).groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")), "op1-entries")
    asked = staged(valid(queries, vec_id, embedding).filter(F.size("x") == d), "op1-queries")
    n, n_asked = entries.count(), asked.count()
    schema = "query_id long, vec_id long, score double"
    if not n or not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.select("x", F.xxhash64("x").alias("h")).orderBy("h").limit(FIT_ROWS).select("x").toArrow()
    model = fit(_matrix(sample.column("x")), k)
    shared = spark.sparkContext.broadcast(model)

    def run(asked: DataFrame, n_asked: int, radius: int) -> DataFrame:
        shards, blocks = max(MIN_SHARDS, -(-n // SHARD_ROWS)), -(-n_asked // QUERY_ROWS)
        index = entries.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        block = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

        def task(a: pa.Table, b: pa.Table) -> pa.Table:
            return nearest(shared.value, a, b, k, radius)

        index, block = index.withColumn("shard", F.col("shard").cast("int")), block.withColumn("shard", F.col("shard").cast("int"))
        found = index.groupBy("shard", "block").cogroup(block.groupBy("shard", "block")).applyInArrow(task, schema)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = staged(run(asked, n_asked, model["radius"]), "op1-found")
    few = asked.join(found.filter(F.col("rank") == k).select(F.col("query_id").alias("id")), "id", "left_anti")
    n_few = few.count()
    if not n_few:
        return found
    few = staged(few, "op1-few")
    return found.join(few.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(run(few, n_few, 64 * (CODE_BITS // 64 + 1)))
