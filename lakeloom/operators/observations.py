"""Observation-table operators: union (G7), priority merge (W1), filters (P16),
coverage and summaries (A14–A17).

Priority merge is an aggregate, not a window: ``min_by(row, order)`` per dedup
key combines map-side, so a key holding a third of the rows costs one partial
row per input partition instead of one giant sorted window partition.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions.columns import literal_map
from lakeloom.schemas import CANONICAL_SCHEMA


def to_canonical(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Missing canonical columns become typed NULLs; extras are dropped (unless kept)."""
    cols = []
    for f in CANONICAL_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *[c for c in keep if c in df.columns])


def union_aligned(frames: Iterable[DataFrame | None], keep: Sequence[str] = ()) -> DataFrame | None:
    """Align each frame to the canonical columns and union by name; None is skipped."""
    out = None
    for df in frames:
        if df is None:
            continue
        aligned = to_canonical(df, keep)
        out = aligned if out is None else out.unionByName(aligned, allowMissingColumns=True)
    return out


def source_rank(c: str | Column = "source_dataset") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(
        F.create_map(*[x for k, v in R.SOURCE_PRIORITY.items() for x in (F.lit(k), F.lit(v))]), col),
        F.lit(R.UNKNOWN_SOURCE_RANK))


VALUE = "obs_value"


def _least_values(df: DataFrame) -> DataFrame:
    """Of rows that differ in their value alone the first in the order of whole rows: the least,
    NULL before all. Values fit the buffers of a hash aggregate, so that the ``min_by``, which
    sorts its input, gets these rows only."""
    least = F.when(F.count_if(F.col(VALUE).isNull()) == 0, F.min(VALUE)).alias(VALUE)
    return df.groupBy(*[c for c in df.columns if c != VALUE]).agg(least).select(*df.columns)


def priority_merge(df: DataFrame, key: Sequence[str] = tuple(R.DEDUP_KEY),
                   tie: Sequence[str] = ("row_id",)) -> DataFrame:
    """One row per dedup key; the lowest source rank wins, ties by ``tie`` columns
    (the input order). NULL key parts compete with ``""`` and come out as ``""``;
    among them the non-NULL original sorts first, as in a NULL-last sort."""
    payload = [c for c in df.columns if c not in key]
    # without an input-order column, the whole row breaks ties (deterministic)
    tie = [t for t in tie if t in df.columns]
    if not tie:
        tie = payload
        if VALUE in payload:
            df = _least_values(df)
    order = F.struct(*[F.col(k).isNull().alias(f"_n{i}") for i, k in enumerate(key)],
                     source_rank().alias("_rank"), *[F.col(t) for t in tie])
    grouped = (df.groupBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in key])
               .agg(F.min_by(F.struct(*payload), order).alias("_w")))
    return grouped.select(*[F.col(f"_w.{c}").alias(c) if c not in key else F.col(c) for c in df.columns])


def obs_filter(df: DataFrame, year_start: int, year_end: int, gender: str | None = None,
               metric: str | None = None) -> DataFrame:
    """Inclusive year range on the numeric year (non-numeric / NULL dropped);
    gender ``All`` or empty means no gender filter; empty metric means no metric filter."""
    y = F.col("year").try_cast("int")
    out = df.where(y.between(year_start, year_end))
    if gender and gender != "All":
        out = out.where(F.col("gender") == gender)
    if metric:
        out = out.where(F.col("metric") == metric)
    return out


def coverage(df: DataFrame) -> DataFrame:
    """A14 + A15: per (source, ref_area) year range, non-NULL observation count, span."""
    y = F.col("year").try_cast("int")
    return (df.groupBy("source_dataset", "ref_area")
            .agg(F.min(y).alias("min_year"), F.max(y).alias("max_year"),
                 F.count("obs_value").alias("row_count"))
            .withColumn("span_years", F.col("max_year") - F.col("min_year") + 1))


def dimension_availability(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each group-by column, whether any value is non-NULL — one pass, one row."""
    present = [c for c in columns if c in df.columns]
    return df.agg(*[F.coalesce(F.max(F.col(c).isNotNull()), F.lit(False)).alias(f"has_{c}")
                    for c in present])


def source_summary(df: DataFrame) -> DataFrame:
    """Rows, year range and sorted distinct metrics per source."""
    y = F.col("year").try_cast("int")
    return (df.groupBy("source_dataset")
            .agg(F.count(F.lit(1)).alias("rows"), F.min(y).alias("min_year"), F.max(y).alias("max_year"),
                 F.array_sort(F.collect_set("metric")).alias("metrics")))


def sources_used(df: DataFrame) -> DataFrame:
    """Distinct sources present after a merge (N6's 'sources used' list)."""
    return df.select("source_dataset").distinct()


def province_iso(c: str | Column) -> Column:
    """Province name → ISO code, unchanged when unknown."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(literal_map(R.PROVINCE_ISO), col), col)
