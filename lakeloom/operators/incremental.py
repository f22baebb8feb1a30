"""Incremental loads (J4, J5, F4) and versioned lookups.

Keys compare NULL-safe (``<=>``): CONTRACT_SOURCE_SYSTEM_ID is NULL for
unmatched claims and must still identify the row. Spark plans a NULL-safe
equality as an ordinary equi-join key, so these are shuffle (or broadcast)
hash/sort-merge joins, never nested loops.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TX_KEY = ("CONTRACT_SOURCE_SYSTEM", "CONTRACT_SOURCE_SYSTEM_ID", "NSE_ID")


def _key_cond(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    cond = None
    for k in key:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def new_rows(target: DataFrame, staging: DataFrame, key: Sequence[str] = TX_KEY) -> DataFrame:
    """Staging rows whose key is not yet in the target (left anti join)."""
    t = target.select(*key)
    return staging.join(t, _key_cond(staging, t, key), "left_anti")


def append_new(target: DataFrame, staging: DataFrame, batch_id: str, key: Sequence[str] = TX_KEY) -> DataFrame:
    """J4 + F4: target ∪ genuinely new rows stamped with ``BATCH_ID``."""
    fresh = new_rows(target, staging, key).withColumn("BATCH_ID", F.lit(batch_id))
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert(target: DataFrame, staging: DataFrame, key: Sequence[str] = TX_KEY) -> DataFrame:
    """Staged rows win (insert or update), target-only rows are kept;
    ``merge_action`` tells which. Full outer join on the NULL-safe key."""
    cols = [c for c in target.columns if c in staging.columns]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = staging.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_in_s"))
    cond = None
    for k in key:
        c = F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}"))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    changed = None
    for c in cols:
        if c in key:
            continue
        d = ~F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}"))
        changed = d if changed is None else changed | d
    action = (F.when(F.col("_in_s").isNull(), F.lit("keep"))
              .when(F.col("_in_t").isNull(), F.lit("insert"))
              .when(changed if changed is not None else F.lit(False), F.lit("update"))
              .otherwise(F.lit("unchanged")))
    return j.select(*[F.when(F.col("_in_s"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols],
                    action.alias("merge_action"))


def lookup_effective(facts: DataFrame, lookup: DataFrame, fact_key: Sequence[str], lookup_key: Sequence[str],
                     fact_date: str, value: str, out: str, default: Column) -> DataFrame:
    """Value valid at the fact's date — key equal, ``effective_from <= date``,
    ``effective_to`` NULL (open) or ``>= date``, ``active``; of versions that overlap
    the newest. A key's versions are one array, so a fact stays one row, and the
    planner broadcasts the lookup if its size allows. A lookup value wins over
    ``default``."""
    version = F.struct("effective_from", "effective_to", F.col(value).alias("value"))
    keys = [F.col(b).alias(f"_k{i}") for i, b in enumerate(lookup_key)]
    versions = lookup.where(F.coalesce("active", F.lit(True))).groupBy(*keys).agg(F.sort_array(F.collect_list(version), asc=False).alias("_versions"))
    cond = F.lit(True)
    for i, a in enumerate(fact_key):
        cond = cond & (facts[a] == versions[f"_k{i}"])
    date = F.col(fact_date)
    valid = F.filter("_versions", lambda v: (v["effective_from"] <= date) & (v["effective_to"].isNull() | (v["effective_to"] >= date)))
    return facts.join(versions, cond, "left").select(*facts.columns, F.coalesce(F.get(valid, F.lit(0))["value"], default).alias(out))


BIN_DAYS = 32


def lookup_intervals(facts: DataFrame, lookup: DataFrame, fact_key: Sequence[str], lookup_key: Sequence[str],
                     fact_date: str, value: str, out: str, default: Column, bin_days: int = BIN_DAYS) -> DataFrame:
    """J6 for keys of any number of versions: same rows as ``lookup_effective``, by an interval join on time bins.

    A version stands in each bin of ``bin_days`` days it reaches into (open ends
    stop at the facts' own range), so facts and versions meet by key and bin, an
    ordinary equi-join whose rows for one key fall over as many tasks as it has
    bins; the exact bounds are a filter on what meets. The newest of a fact's
    valid versions is an aggregate by fact.
    """
    span = facts.agg(F.unix_date(F.min(fact_date)).alias("lo"), F.unix_date(F.max(fact_date)).alias("hi")).first()
    lo, hi = (0, 0) if span.lo is None else (span.lo, span.hi)
    numbered = facts.withColumn("_fact", F.monotonically_increasing_id())
    dated = numbered.withColumn("_bin", F.floor(F.unix_date(F.col(fact_date)) / bin_days))
    first = F.greatest(F.unix_date("effective_from"), F.lit(lo))
    last = F.least(F.coalesce(F.unix_date("effective_to"), F.lit(hi)), F.lit(hi))
    versions = (lookup.where(F.coalesce("active", F.lit(True)) & (first <= last))
                .select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(lookup_key)], F.struct("effective_from", "effective_to", F.col(value).alias("value")).alias("_v"),
                        F.explode(F.sequence(F.floor(first / bin_days), F.floor(last / bin_days))).alias("_in")))
    cond = F.col("_bin") == F.col("_in")
    for i, a in enumerate(fact_key):
        cond = cond & (F.col(a) == F.col(f"_k{i}"))
    date = F.col(fact_date)
    cond = cond & (F.col("_v.effective_from") <= date) & (F.col("_v.effective_to").isNull() | (F.col("_v.effective_to") >= date))
    met = dated.join(versions, cond, "left")
    newest = met.groupBy("_fact").agg(*[F.first(c).alias(c) for c in facts.columns], F.max("_v").alias("_v"))
    return newest.select(*facts.columns, F.coalesce("_v.value", default).alias(out))
