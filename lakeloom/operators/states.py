"""Aggregate states kept beside a table's partitions and merged for the whole.

* Quality states: counts of a partition, its ids' range and a theta sketch of
  them, one row a partition. Adding a partition reads the new rows, and the ids
  of those older partitions only that may share one: their id ranges overlap and,
  where both sketches are exact (fewer ids than the sketch holds), they have an
  id in common. Repeats among the suspects are counted exactly, so the merged
  report equals a full recount.
* Quantile states: a KLL sketch a partition; the merged one answers quantiles with
  a rank error below ``KLL_ERROR``. The exact way is ``explore.quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

THETA_LG = 12  # a sketch holds 2 ** THETA_LG ids before it estimates
KLL_K, KLL_ERROR = 400, 0.0165


@dataclass(frozen=True)
class CheckedTable:
    """A table of partitions below ``base``/data, their quality states below ``base``/states.

    Partitions are numbered by arrival and added once; adding the newest again
    (a run that failed half-way) replaces it.
    """

    base: str
    schema: T.StructType
    critical: tuple[str, ...]
    id_col: str
    amount: str | None = None

    def _checks(self) -> dict[str, Column]:
        checks = {"row_count": F.count(F.lit(1))} | {f"null_{c}": F.count_if(F.col(c).isNull()) for c in self.critical}
        if self.amount:
            checks[f"negative_{self.amount}"] = F.count_if(F.col(self.amount).try_cast("double") < 0)
        return checks

    def states(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.base}/states")

    def rows(self, spark: SparkSession, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows of all partitions, or of some (only their folders are read)."""
        folders = [f"{self.base}/data"] if parts is None else [f"{self.base}/data/part={p}" for p in parts]
        return spark.read.schema(self.schema).option("basePath", f"{self.base}/data").parquet(*folders)

    def suspects(self, spark: SparkSession, state: DataFrame, part: int) -> list[int]:
        """Older partitions that may share an id with a new one's state."""
        if part == 0:
            return []
        old, new = self.states(spark).where(F.col("part") < part).alias("o"), state.alias("n")
        overlap = (F.col("o.min_id") <= F.col("n.max_id")) & (F.col("o.max_id") >= F.col("n.min_id"))
        exact = (F.col("o.ids") < 2**THETA_LG) & (F.col("n.ids") < 2**THETA_LG)
        common = F.theta_sketch_estimate(F.theta_intersection("o.sketch", "n.sketch")) > 0
        nulls = (F.col("o.null_ids") > 0) & (F.col("n.null_ids") > 0)
        # One new row: the join is a filter over the states, a row a partition.
        met = old.join(F.broadcast(new), F.coalesce(overlap & (~exact | common), F.lit(False)) | nulls)
        return sorted(r[0] for r in met.select("o.part").collect())

    def add(self, spark: SparkSession, rows: DataFrame, part: int) -> list[int]:
        """Write a partition and its state; returns the older partitions whose ids were read."""
        path = f"{self.base}/data/part={part}"
        rows.select(*[f.name for f in self.schema]).write.mode("overwrite").parquet(path)
        fresh = self.rows(spark, [part])
        checks = self._checks()
        per_id = fresh.groupBy(self.id_col).agg(*[e.alias(n) for n, e in checks.items()])
        key = F.col(self.id_col).cast("string")
        state = per_id.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in checks],
                           F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).cast("long").alias("repeats_inside"), F.count(key).alias("ids"),
                           F.count_if(key.isNull()).alias("null_ids"), F.min(key).alias("min_id"), F.max(key).alias("max_id"),
                           F.theta_sketch_agg(key, THETA_LG).alias("sketch"))
        staging = f"{self.base}/staging-{part}"
        state.write.mode("overwrite").parquet(staging)
        state = spark.read.parquet(staging)
        read = self.suspects(spark, state, part)
        again = F.lit(0).cast("long")
        if read:
            ids, known = fresh.select(self.id_col).distinct().alias("f"), self.rows(spark, read).select(self.id_col).alias("k")
            n = ids.join(known, F.col(f"f.{self.id_col}").eqNullSafe(F.col(f"k.{self.id_col}")), "left_semi").count()
            again = F.lit(n).cast("long")
        state.withColumn("repeats_before", again).write.mode("overwrite").parquet(f"{self.base}/states/part={part}")
        return read

    def report(self, spark: SparkSession) -> DataFrame:
        """``quality.dq_report`` of the whole table, from the states alone."""
        names = list(self._checks())
        return self.states(spark).agg(*[F.sum(n).alias(n) for n in names], F.sum(F.col("repeats_inside") + F.col("repeats_before")).alias(f"duplicate_{self.id_col}"))


def quantile_states(df: DataFrame, by: str, value: str, k: int = KLL_K) -> DataFrame:
    """A row for each value of ``by``: count and KLL sketch of its values (NULLs take no part)."""
    return df.where(F.col(value).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged_quantiles(states: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """probability, n, value: quantiles of all states together, from their merged sketch."""
    merged = states.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    asked = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probabilities])
    return merged.select("n", F.inline(asked)).select("probability", "n", "value")


def rank_errors(df: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """probability, value, error: how far each quantile's rank is from the one asked for, as a share of all rows; 0 inside ties."""
    asked = [(r.probability, r.value) for r in found.collect()]  # a row a probability
    v = F.col(column).cast("double")
    counts = df.where(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("n"), *[e for i, (_, q) in enumerate(asked) for e in (
        F.count_if(v < q).alias(f"below{i}"), F.count_if(v <= q).alias(f"upto{i}"))])
    rows = F.array(*[F.struct(F.lit(p).alias("probability"), F.lit(q).alias("value"),
                              F.greatest(F.col(f"below{i}") / F.col("n") - p, p - F.col(f"upto{i}") / F.col("n"), F.lit(0.0)).alias("error")) for i, (p, q) in enumerate(asked)])
    return counts.select(F.inline(rows))
