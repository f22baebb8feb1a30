"""``rank(method='min')`` over ALL rows without a single-task window.

``rank().over(Window.orderBy(v))`` moves every row into one partition. Here:

1. count rows per distinct value (partial aggregation: a hot value is one row
   per map partition);
2. cut the value domain into ``buckets`` ranges with ``approxQuantile`` — the
   cut points are a list of ``buckets - 1`` values computed once, so the bucket
   of a value is deterministic on recompute (no sampling inside the plan);
3. per bucket, prefix-sum of counts (a window partitioned by bucket); bucket
   offsets are a prefix sum over ``buckets`` rows — a bounded side;
4. join the per-value rank back to the rows on the value (broadcast only the
   bucket offsets; the value table is joined by the planner's own choice).

The counts are written to the shared folder first, so building the plan runs
that job and the cut points.

NULL values keep a NULL rank (pandas' ``rank`` leaves NaN as NaN).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.session import written


def _bucket_of(v: Column, cuts: list) -> Column:
    """Index of the range holding v (= number of sorted cut points <= v) as a
    balanced binary-search CASE tree: log2(len(cuts)) compiled comparisons."""
    def search(lo: int, hi: int) -> Column:  # answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v < F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return search(0, len(cuts))


def default_buckets(df: DataFrame) -> int:
    """Twice the shuffle parallelism, 16 at least: each bucket's window then sorts
    about 1/buckets of the distinct values."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(16, 2 * parts)


def value_ranks(df: DataFrame, value: str, rank_col: str = "rank", buckets: int | None = None) -> DataFrame:
    """(value, ``_n`` rows that have it, min rank): one row per distinct value. The
    counts are written to the shared folder once, so ``df`` is evaluated once; cut
    points are good to a tenth of a bucket."""
    buckets = buckets or default_buckets(df)
    counts = written(df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(x for x in counts.approxQuantile(value, probs, 0.1 / buckets) if x is not None))
    b = counts.withColumn("_b", _bucket_of(F.col(value), cuts))
    w_in = Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_before", F.coalesce(F.sum("_n").over(w_in), F.lit(0)))
    # one row per bucket: a bounded side
    per_bucket = b.groupBy("_b").agg(F.sum("_n").alias("_bn"))
    w_all = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_bn").over(w_all), F.lit(0))).select("_b", "_off")
    return (local.join(F.broadcast(offsets), "_b")
            .select(value, "_n", (F.col("_off") + F.col("_before") + 1).cast("long").alias(rank_col)))


def min_rank(df: DataFrame, value: str, rank_col: str = "rank", buckets: int | None = None) -> DataFrame:
    """The min-rank of every row. NULL values are kept apart from the join."""
    ranks = value_ranks(df, value, rank_col, buckets).drop("_n")
    known = df.where(F.col(value).isNotNull()).join(ranks, on=[value])
    return known.unionByName(df.where(F.col(value).isNull()).withColumn(rank_col, F.lit(None).cast("long")))


def quantiles(df: DataFrame, value: str, probs: list[float]) -> DataFrame:
    """One row: ``quantiles`` (linear interpolation between order statistics, NULLs
    left out; NULL without any value), ``least``, ``rows``. The order statistics are
    looked up in the distributed ranks, so no task sorts all values."""
    ranks = value_ranks(df, value)
    n = ranks.agg(F.sum("_n")).scalar()
    at = [(n - 1) * F.lit(p) for p in probs]

    def at_rank(k: Column) -> Column:  # the value at 0-based position k
        return F.max(F.when((F.col("rank") - 1 <= k) & (k < F.col("rank") - 1 + F.col("_n")), F.col(value)))

    lows = [at_rank(F.floor(a)).alias(f"l{i}") for i, a in enumerate(at)]
    highs = [at_rank(F.ceil(a)).alias(f"h{i}") for i, a in enumerate(at)]
    one = ranks.agg(*lows, *highs, F.min(value).alias("least"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    share = [(F.col("rows") - 1) * F.lit(p) - F.floor((F.col("rows") - 1) * F.lit(p)) for p in probs]
    return one.select(F.array(*[F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * share[i] for i in range(len(probs))]).alias("quantiles"),
                      "least", "rows")
