"""Operator 8: a uniform shuffle into shards of exact sizes, in DataFrame functions.

1. Rows fall by a hash of their content into input partitions, which are counted.
2. The driver draws the communication matrix, how many rows each partition sends
   to each shard, row by row from the multivariate hypergeometric law with the
   shard sizes as margins. It is small: partitions of about ``PARTITION_ROWS``
   rows times shards.
3. Each partition puts its rows in a random order and cuts it by its row of the
   matrix; the rows move to their shards.
4. Inside a shard rows are ordered by a second random key: its leading bits make
   sub-buckets, whose counts give where each starts, so that a shard is sorted
   by many tasks.

Random keys are hashes of the row's content and the seed: the same input gives
the same shards whatever its partitioning. Rows that agree in all columns given
are interchangeable, which is all that ties can swap.

Defined cases: nulls hash like any value; an empty table gives an empty result;
with fewer rows than shards some shards stay empty; the input's columns keep
their names, but one named like a result column is replaced.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import staged

PARTITION_ROWS = 250_000
MIN_PARTITIONS = 64
BUCKET_ROWS = 250_000
MIN_BUCKETS = 8
SEED = 20240301


def communication_matrix(counts: list[int], n_shards: int, seed: int = SEED) -> list[list[int]]:
    """Rows each partition sends to each shard: exact margins, every assignment of rows equally likely."""
    total = sum(counts)
    left = np.array([total // n_shards + (j < total % n_shards) for j in range(n_shards)], dtype=np.int64)
    rng = np.random.Generator(np.random.PCG64(seed))
    out = []
    for n in counts:
        row, rest, pool = [], n, int(left.sum())
        for j in range(n_shards):
            pool -= int(left[j])
            row.append(_hypergeometric(rng, int(left[j]), pool, rest))
            rest -= row[-1]
        left -= np.array(row)
        out.append(row)
    return out


def _hypergeometric(rng, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn from ``good`` and ``bad`` are good, for populations of any size.

    The weights follow from the mode by the law's exact ratios, and the draw
    inverts their sum. What lies beyond 14 standard deviations (and 60 places) of
    the mode weighs less than a double can tell.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    size = good + bad
    mode = min(max((n + 1) * (good + 1) // (size + 2), low), high)
    reach = 60 + int(14 * math.sqrt(n * (good / size) * (bad / size) * ((size - n) / max(size - 1, 1))))
    k = np.arange(max(low, mode - reach), min(high, mode + reach), dtype=np.float64)
    ratio = (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))  # of k + 1 to k
    below = k < mode
    weight = np.concatenate([np.cumprod(1 / ratio[below][::-1])[::-1], [1.0], np.cumprod(ratio[~below])])
    total = np.cumsum(weight)
    return max(low, mode - reach) + int(np.searchsorted(total, rng.random() * total[-1], "right"))


def shuffle_into_shards(rows: DataFrame, n_shards: int = 16, seed: int = SEED) -> DataFrame:
    """All rows with ``shard`` (0 to n_shards - 1, sizes at most one apart) and ``slot`` (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    rows = staged(rows.select(*columns), "op8-rows")
    total = rows.count()
    parts = max(MIN_PARTITIONS, -(-total // PARTITION_ROWS))
    buckets = max(MIN_BUCKETS, -(-total // (n_shards * BUCKET_ROWS)))
    first = F.xxhash64(*columns, F.lit(seed))
    keyed = rows.select(*columns, F.pmod(first, F.lit(parts)).cast("int").alias("_part"))
    counts = {r["_part"]: r["count"] for r in keyed.groupBy("_part").count().collect()}
    known = sorted(counts)
    matrix = communication_matrix([counts[p] for p in known], n_shards, seed)
    text = json.dumps([{"_part": p, "_sent": np.cumsum(m).tolist()} for p, m in zip(known, matrix)])
    sent = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<_part:int,_sent:array<bigint>>>")))

    local = Window.partitionBy("_part").orderBy(F.xxhash64(*columns, F.lit(seed + 1)), *columns)
    moved = (keyed.withColumn("_turn", F.row_number().over(local)).join(sent, "_part")
             .select(*columns, F.size(F.filter("_sent", lambda end: end < F.col("_turn"))).alias("shard")))

    second = F.xxhash64(*columns, F.lit(seed + 2))
    moved = staged(moved.withColumn("_bucket", F.pmod(F.shiftright(second, 32), F.lit(buckets)).cast("int")), "op8-moved")
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = (moved.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
             .select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_head")))
    inside = Window.partitionBy("shard", "_bucket").orderBy(second, *columns)
    return (moved.withColumn("_at", F.row_number().over(inside) - 1).join(heads, ["shard", "_bucket"])
            .select(*columns, F.col("shard").cast("int").alias("shard"), (F.col("_head") + F.col("_at")).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, n_shards: int = 16, seed: int = SEED, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row; the law is ``rows``."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"), F.crc32(value).alias("text_crc32"))
    return shuffle_into_shards(rows, n_shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
