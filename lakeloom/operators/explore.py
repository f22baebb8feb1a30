"""Aggregations, top-N, shares and pivots behind the chart and table views
(A1–A13, A18–A20, W3–W6, G1–G6).

All are grouped aggregates with partial (map-side) aggregation. Sums keep the
precision of their input and nothing is rounded here. Pivots take their columns
from the data (one distinct job, bounded by ``spark.sql.pivotMaxValues``) unless
a value list is declared; a value outside a declared list fails the job.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom import rules as R
from lakeloom.operators.ranking import quantiles

def total(c: str = "obs_value") -> Column:
    """Sum where an all-NULL group is 0 (the pandas convention), in the input's own type."""
    return F.coalesce(F.sum(c), F.lit(0))


def group_totals(df: DataFrame, keys: Sequence[str], value: str = "obs_value",
                 name: str = "obs_value") -> DataFrame:
    """Sum by key; NULL keys form their own group."""
    return df.groupBy(*keys).agg(total(value).alias(name))


def year_group_sum(df: DataFrame, group_col: str | None) -> DataFrame:
    """Sum by (year, group); by year only when the group column is absent."""
    keys = ["year", group_col] if group_col and group_col in df.columns else ["year"]
    return group_totals(df, keys)


def year_group_positive(df: DataFrame, group_col: str | None) -> DataFrame:
    """A10: A9 keeping positive totals."""
    return year_group_sum(df, group_col).where(F.col("obs_value") > 0)


def top_n_keys(df: DataFrame, group_col: str, n: int, keep_null: bool = False) -> DataFrame:
    """The N largest group totals, ties by group key. At most N rows."""
    return _largest(group_totals(df, [group_col]), group_col, n, keep_null)


def _largest(totals: DataFrame, group_col: str, n: int, keep_null: bool = False) -> DataFrame:
    src = totals if keep_null else totals.where(F.col(group_col).isNotNull())
    return (src
            .orderBy(F.col("obs_value").desc(), F.col(group_col).asc_nulls_first())
            .limit(n))


def top_n_groups(df: DataFrame, group_col: str, n: int) -> DataFrame:
    """A9 over the rows of the top-N groups (NULL group excluded). The rows are
    read once: groups are ranked from their (year, group) totals."""
    yearly = year_group_sum(df, group_col)
    top = _largest(group_totals(yearly, [group_col]), group_col, n).select(group_col)
    return yearly.join(top, group_col, "left_semi")


def top_n_share(df: DataFrame, group_col: str, n: int) -> DataFrame:
    """W4 + W5: top-N totals with the NULL group kept, positive only, and each
    slice's percent of the shown total (the window runs over at most N rows)."""
    top = top_n_keys(df, group_col, n, keep_null=True).where(F.col("obs_value") > 0)
    shown = F.sum("obs_value").over(Window.partitionBy())
    return top.withColumn("share_pct", F.col("obs_value").cast("double") * 100 / shown.cast("double"))


def origin_totals(df: DataFrame) -> DataFrame:
    """Totals per origin, aggregate codes left out, positive only."""
    return (group_totals(df, ["counterpart", "counterpart_name"])
            .where(~F.coalesce(F.col("counterpart"), F.lit("")).isin(R.AGGREGATE_COUNTERPARTS)
                   | F.col("counterpart").isNull())
            .where(F.col("obs_value") > 0))


def origin_scale_cap(df: DataFrame) -> DataFrame:
    """Colour cap = max(p95, 2·min) of the origin totals (linear quantile)."""
    o = origin_totals(df).select(F.col("obs_value").cast("double").alias("v"))
    return quantiles(o, "v", [0.95]).select(F.greatest(F.col("quantiles")[0], F.col("least") * 2).alias("cap"))


def heatmap_cap(df: DataFrame, group_col: str, top_n: int | None = None) -> DataFrame:
    """p95 of positive (group, year) cells if more than one, else their max; none → 1.0.
    With ``top_n`` only the cells of the N largest groups are shown and counted."""
    cells = year_group_sum(df, group_col) if top_n is None else top_n_groups(df, group_col, top_n)
    q = quantiles(cells.where(F.col("obs_value") > 0).select(F.col("obs_value").cast("double").alias("v")), "v", [0.95])
    return q.select(F.coalesce(F.col("quantiles")[0], F.lit(1.0)).alias("cap"))


def group_column(df: DataFrame, group_col: str, fallback: str = "counterpart_name") -> str:
    """The column to group by; ``fallback`` when the asked one is absent or all NULL (one short job)."""
    if group_col not in df.columns or df.where(F.col(group_col).isNotNull()).limit(1).count() == 0:
        return fallback
    return group_col


def _pivot(df: DataFrame, rows: Sequence[str], pivot_col: str, values: Sequence | None):
    if values is None:
        return df.groupBy(*rows).pivot(pivot_col)
    known = F.col(pivot_col).isin(list(values)) | F.col(pivot_col).isNull()
    checked = F.when(known, F.col(pivot_col)).otherwise(
        F.raise_error(F.concat(F.lit(f"{pivot_col} outside the declared list: "), F.col(pivot_col).cast("string"))))
    return df.withColumn(pivot_col, checked).groupBy(*rows).pivot(pivot_col, list(values))


def _filled(p: DataFrame, rows: Sequence[str], fill) -> DataFrame:
    return p if fill is None else p.na.fill(fill, subset=[c for c in p.columns if c not in rows])


def pivot_sum(df: DataFrame, row_col: str | Sequence[str], pivot_col: str, values: Sequence | None = None,
              value: str = "obs_value", fill: float | None = 0) -> DataFrame:
    """Sums per (row, pivot value), one column per pivot value, missing → fill."""
    rows = [row_col] if isinstance(row_col, str) else list(row_col)
    return _filled(_pivot(df, rows, pivot_col, values).agg(F.sum(value)), rows, fill)


def pivot_table(df: DataFrame, rows: str, cols: str, values: Sequence | None = None, agg: str = "sum") -> DataFrame:
    """Rows with NULL row key, column key or value dropped; aggregate; fill 0."""
    clean = df.dropna(subset=[rows, cols, "obs_value"])
    fn = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}[agg]
    return _filled(_pivot(clean, [rows], cols, values).agg(fn("obs_value")), [rows], 0)


def pivot_sparse(df: DataFrame, rows: str | Sequence[str], pivot_col: str, value: str = "obs_value", name: str = "cells") -> DataFrame:
    """G5 without a column limit: one row per row key with a map of pivot value (as text, in order) to sum.

    Cells are summed first, by key and value, so a hot row's observations are
    combined map-side; there is no job for the distinct values. Cells without a
    pivot value are left out, as in a pivot. ``widen`` gives columns to a reader.
    """
    rows = [rows] if isinstance(rows, str) else list(rows)
    cells = df.groupBy(*rows, F.col(pivot_col).cast("string").alias("_c")).agg(F.sum(value).alias("_v"))
    pairs = F.sort_array(F.collect_list(F.when(F.col("_c").isNotNull(), F.struct("_c", "_v"))))
    return cells.groupBy(*rows).agg(F.map_from_entries(pairs).alias(name))


def widen(sparse: DataFrame, columns: Sequence, name: str = "cells", fill: float | None = 0) -> DataFrame:
    """The asked columns of a sparse pivot; missing cells → ``fill``."""
    cell = lambda c: F.try_element_at(F.col(name), F.lit(str(c)))
    return sparse.select(*[c for c in sparse.columns if c != name], *[(cell(c) if fill is None else F.coalesce(cell(c), F.lit(fill))).alias(str(c)) for c in columns])


def thousands(c: str | Column) -> Column:
    """Truncate to an integer and group thousands with commas."""
    col = F.col(c) if isinstance(c, str) else c
    return F.format_number(col.cast("long"), 0)


def formatted(df: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    return df.select(*[thousands(c).alias(c) if c in value_cols else F.col(c) for c in df.columns])


def pivot_centered(pivot: DataFrame, row_col: str, row_value: str, year_col: str) -> DataFrame:
    """Every cell minus the reference cell (row_value, year_col), a scalar subquery."""
    ref = pivot.where(F.col(row_col) == row_value).agg(F.first(F.col(year_col), ignorenulls=True)).scalar()
    return pivot.select(row_col, *[(F.col(c) - ref).alias(c) for c in pivot.columns if c != row_col])


def order_limit(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Sort + limit (planned as a per-partition top-N merged once)."""
    return df.orderBy(*order).limit(n)


LIST_PARTS = 64


def group_to_list(df: DataFrame, keys: Sequence[str], value: str, name: str = "values", parts: int = LIST_PARTS) -> DataFrame:
    """A5: one row per key with the sorted list of its values. A key's values are
    collected and sorted in ``parts`` tasks first; the list itself, which is what is
    asked for, is one row and so bounded by what a row can hold."""
    part = F.pmod(F.xxhash64(value), F.lit(parts)).alias("_part")
    some = df.groupBy(*keys, part).agg(F.array_sort(F.collect_list(value)).alias("_some"))
    return some.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_some"))).alias(name))


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, stddev, min, max in one aggregate."""
    v = F.col(value)
    return df.agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"),
                  F.min(v).alias("min"), F.max(v).alias("max"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Contingency counts, one column per value, named like ``crosstab``."""
    p = _filled(_pivot(df, [row], col, values).agg(F.count(F.lit(1))), [row], 0)
    return p.withColumnRenamed(row, f"{row}_{col}")


def quantile_classes(df: DataFrame, value: str, k: int = 5, name: str = "class") -> DataFrame:
    """Class 0..k-1 = number of interior quantile breaks below the value (a scalar subquery)."""
    breaks = quantiles(df.select(F.col(value).cast("double").alias("v")), "v", [i / k for i in range(1, k)]).select("quantiles").scalar()
    return df.withColumn("_br", breaks).select(*df.columns, F.size(F.filter("_br", lambda b: b < F.col(value))).alias(name))
