"""Queries over the observation table: merge, filters, chart data, pivots, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.operators import explore as X
from lakeloom.operators import observations as O
from lakeloom.operators import states as ST
from lakeloom.plans.catalog import register
from lakeloom.plans.sqltext import PIVOT_VALUES, case_map, in_list
from lakeloom.plans.standins import OBS_V_SQL, obs_v, with_ctes
from lakeloom.session import written

CANON = ", ".join(R.CANONICAL_COLUMNS)
RANK_SQL = (f"COALESCE(CAST({case_map('source_dataset', {k: str(v) for k, v in R.SOURCE_PRIORITY.items()})} "
            f"AS INTEGER), {R.UNKNOWN_SOURCE_RANK})")


def _obs(body: str, **extra) -> str:
    return with_ctes(body, obs=OBS_V_SQL, **extra)


MERGE_SQL = f"""
SELECT {', '.join(f"COALESCE({c}, '') AS {c}" if c in R.DEDUP_KEY else c for c in R.CANONICAL_COLUMNS)}
FROM (SELECT *, row_number() OVER (
        PARTITION BY {', '.join(f"COALESCE({k}, '')" for k in R.DEDUP_KEY)}
        ORDER BY {', '.join(f"{k} IS NULL" for k in R.DEDUP_KEY)}, {RANK_SQL}, row_id) AS rn
      FROM obs) WHERE rn = 1
"""


@register("priority_merge", _obs(MERGE_SQL))
def q_priority_merge(spark, sf_dir):
    """One row per (ref_area, counterpart, time_period, var_code, sex), best source wins."""
    return O.priority_merge(obs_v(spark, sf_dir)).select(*R.CANONICAL_COLUMNS)


@register("union_aligned", _obs(f"SELECT {CANON} FROM obs"))
def q_union_aligned(spark, sf_dir):
    """Sources with different column sets aligned to the canonical 19 and unioned."""
    o = obs_v(spark, sf_dir)
    first = o.where(F.col("source_dataset").isin("OECD_MIG", "EUROSTAT")).drop("quarter", "province")
    second = o.where(~F.col("source_dataset").isin("OECD_MIG", "EUROSTAT")).withColumn("extra", F.lit(1))
    return O.union_aligned([first, None, second])


@register("obs_filter", _obs(f"""
SELECT {CANON} FROM obs
WHERE TRY_CAST(year AS INTEGER) BETWEEN 1996 AND 2000 AND gender = 'Female' AND metric = 'Metric B11'
"""))
def q_obs_filter(spark, sf_dir):
    """Inclusive year range + gender + metric."""
    return O.obs_filter(obs_v(spark, sf_dir), 1996, 2000, "Female", "Metric B11").select(*R.CANONICAL_COLUMNS)


@register("obs_filter_all_gender", _obs(f"""
SELECT {CANON} FROM obs WHERE TRY_CAST(year AS INTEGER) BETWEEN 1997 AND 1998
"""))
def q_obs_filter_all(spark, sf_dir):
    """P16 with gender 'All' and no metric: only the year range applies."""
    return O.obs_filter(obs_v(spark, sf_dir), 1997, 1998, "All", None).select(*R.CANONICAL_COLUMNS)


def _sum_sql(keys: str, having: str = "") -> str:
    return _obs(f"SELECT {keys}, COALESCE(sum(obs_value), 0) AS obs_value "
                f"FROM obs GROUP BY {keys} {having}")


@register("year_group_sum", _sum_sql("year, reg_name"))
def q_year_group_sum(spark, sf_dir):
    """Sum by (year, group)."""
    return X.year_group_sum(obs_v(spark, sf_dir), "reg_name")


@register("year_group_positive", _sum_sql("year, area_name", "HAVING COALESCE(sum(obs_value), 0) > 0"))
def q_year_group_positive(spark, sf_dir):
    """A10: positive (year, group) totals; the NULL group is kept."""
    return X.year_group_positive(obs_v(spark, sf_dir), "area_name")


ORIGIN_SQL = f"""
SELECT counterpart, counterpart_name, COALESCE(sum(obs_value), 0) AS obs_value
FROM obs GROUP BY counterpart, counterpart_name
HAVING (counterpart IS NULL OR counterpart NOT IN {in_list(R.AGGREGATE_COUNTERPARTS)})
   AND COALESCE(sum(obs_value), 0) > 0
"""


@register("origin_totals", _obs(ORIGIN_SQL))
def q_origin_totals(spark, sf_dir):
    """Per-origin totals without aggregate codes (UNK drops out)."""
    return X.origin_totals(obs_v(spark, sf_dir))


@register("origin_scale_cap", _obs(f"""
SELECT round(greatest(quantile_cont(CAST(obs_value AS DOUBLE), 0.95), min(CAST(obs_value AS DOUBLE)) * 2), 4) AS cap
FROM ({ORIGIN_SQL})
"""))
def q_origin_scale_cap(spark, sf_dir):
    """max(p95, 2·min) of origin totals (rounded here, for the compare)."""
    return X.origin_scale_cap(obs_v(spark, sf_dir)).select(F.round("cap", 4).alias("cap"))


@register("heatmap_cap", _obs("""
SELECT round(CASE WHEN count(*) > 1 THEN quantile_cont(CAST(v AS DOUBLE), 0.95)
                  WHEN count(*) = 1 THEN max(CAST(v AS DOUBLE)) ELSE 1.0 END, 4) AS cap
FROM (SELECT counterpart_name, year, COALESCE(sum(obs_value), 0) AS v FROM obs
      WHERE counterpart_name IN (SELECT counterpart_name FROM obs WHERE counterpart_name IS NOT NULL GROUP BY counterpart_name
                                 ORDER BY COALESCE(sum(obs_value), 0) DESC, counterpart_name ASC LIMIT 15)
      GROUP BY counterpart_name, year HAVING COALESCE(sum(obs_value), 0) > 0)
"""))
def q_heatmap_cap(spark, sf_dir):
    """p95 of the positive heatmap cells of the 15 largest origins."""
    return X.heatmap_cap(obs_v(spark, sf_dir), "counterpart_name", 15).select(F.round("cap", 4).alias("cap"))


@register("group_fallback", _sum_sql("year, counterpart_name"))
def q_group_fallback(spark, sf_dir):
    """An all-NULL group column (imm_category here) gives way to counterpart_name."""
    o = obs_v(spark, sf_dir)
    return X.year_group_sum(o, X.group_column(o, "imm_category"))


@register("top_n_groups", _obs(f"""
SELECT year, counterpart_name, COALESCE(sum(obs_value), 0) AS obs_value
FROM obs WHERE counterpart_name IN (
  SELECT counterpart_name FROM obs WHERE counterpart_name IS NOT NULL GROUP BY counterpart_name
  ORDER BY COALESCE(sum(obs_value), 0) DESC, counterpart_name ASC LIMIT 5)
GROUP BY year, counterpart_name
"""))
def q_top_n_groups(spark, sf_dir):
    """The 5 largest origins, summed by year."""
    return X.top_n_groups(obs_v(spark, sf_dir), "counterpart_name", 5)


@register("top_n_share", _obs(f"""
SELECT area_name, obs_value, round(CAST(obs_value AS DOUBLE) * 100 / CAST(sum(obs_value) OVER () AS DOUBLE), 6) AS share_pct
FROM (SELECT area_name, COALESCE(sum(obs_value), 0) AS obs_value FROM obs GROUP BY area_name
      ORDER BY obs_value DESC, area_name ASC NULLS FIRST LIMIT 3) WHERE obs_value > 0
"""))
def q_top_n_share(spark, sf_dir):
    """W4 + W5: top-3 areas (NULL area kept) with their share of the shown total."""
    return X.top_n_share(obs_v(spark, sf_dir), "area_name", 3).withColumn("share_pct", F.round("share_pct", 6))


@register("coverage", _obs("""
SELECT source_dataset, ref_area, min(TRY_CAST(year AS INTEGER)) AS min_year, max(TRY_CAST(year AS INTEGER)) AS max_year,
       count(obs_value) AS row_count,
       max(TRY_CAST(year AS INTEGER)) - min(TRY_CAST(year AS INTEGER)) + 1 AS span_years
FROM obs GROUP BY source_dataset, ref_area
"""))
def q_coverage(spark, sf_dir):
    """A14 + A15: per (source, ref_area) year range, non-NULL count and span."""
    return O.coverage(obs_v(spark, sf_dir))


AVAIL_COLS = [c for c in R.PIVOT_DIMENSIONS if c != "year"] + ["source_dataset"]


@register("dimension_availability", _obs(
    "SELECT " + ", ".join(f"COALESCE(bool_or({c} IS NOT NULL), false) AS has_{c}" for c in AVAIL_COLS) + " FROM obs"))
def q_dimension_availability(spark, sf_dir):
    """Which group-by dimensions carry any data."""
    return O.dimension_availability(obs_v(spark, sf_dir), AVAIL_COLS)


@register("source_summary", _obs("""
SELECT source_dataset, count(*) AS rows, min(TRY_CAST(year AS INTEGER)) AS min_year,
       max(TRY_CAST(year AS INTEGER)) AS max_year, list_sort(list(DISTINCT metric)) AS metrics
FROM obs GROUP BY source_dataset
"""))
def q_source_summary(spark, sf_dir):
    """Rows, year range, distinct metrics per source."""
    return O.source_summary(obs_v(spark, sf_dir))


def _pivot_sql(row: str, col: str, cell: str = "COALESCE({}, 0)", where: str = "") -> str:
    cells = cell.format(f"COLUMNS(* EXCLUDE {row})")
    return _obs(f"SELECT {row}, {cells} FROM (PIVOT (SELECT {row}, {col}, obs_value FROM obs {where}) ON {col} IN {PIVOT_VALUES[col]} USING sum(obs_value) GROUP BY {row})")


@register("pivot_sum", _pivot_sql("counterpart_name", "year"))
def q_pivot_sum(spark, sf_dir):
    """Origin × year sums, a column for each year in the data, missing cells 0."""
    return X.pivot_sum(obs_v(spark, sf_dir), "counterpart_name", "year")


PT_WHERE = "WHERE reg_name IS NOT NULL AND gender IS NOT NULL AND obs_value IS NOT NULL"


@register("pivot_table", _pivot_sql("reg_name", "gender", where=PT_WHERE))
def q_pivot_table(spark, sf_dir):
    """Generic pivot (region × gender, sum, fill 0)."""
    return X.pivot_table(obs_v(spark, sf_dir), "reg_name", "gender")


@register("pivot_table_mean", _obs(f"""
SELECT reg_name, round(COALESCE(COLUMNS(* EXCLUDE reg_name), 0), 4)
FROM (PIVOT (SELECT reg_name, source_dataset, CAST(obs_value AS DOUBLE) AS v FROM obs {PT_WHERE}) ON source_dataset IN {PIVOT_VALUES["source_dataset"]} USING avg(v) GROUP BY reg_name)
"""))
def q_pivot_table_mean(spark, sf_dir):
    """Another two dimensions, by mean (rounded here, for the compare)."""
    p = X.pivot_table(obs_v(spark, sf_dir).withColumn("obs_value", F.col("obs_value").cast("double")), "reg_name", "source_dataset", agg="mean")
    return p.select("reg_name", *[F.round(c, 4).alias(c) for c in p.columns if c != "reg_name"])


@register("pivot_formatted", _pivot_sql("reg_name", "gender", "format('{{:,}}', CAST(trunc(COALESCE({}, 0)) AS BIGINT))", PT_WHERE))
def q_pivot_formatted(spark, sf_dir):
    """The pivot with thousands separators."""
    p = X.pivot_table(obs_v(spark, sf_dir), "reg_name", "gender")
    return X.formatted(p, [c for c in p.columns if c != "reg_name"])


@register("pivot_centered", _pivot_sql("area_name", "year", "COALESCE({}, 0) - "
                                       "(SELECT COALESCE(sum(obs_value), 0) FROM obs WHERE area_name = 'EUROPE' AND year = 2000)"))
def q_pivot_centered(spark, sf_dir):
    """Area × year pivot centred on the (EUROPE, 2000) cell."""
    return X.pivot_centered(X.pivot_sum(obs_v(spark, sf_dir), "area_name", "year"), "area_name", "EUROPE", "2000")


@register("pivot_sparse", _obs("""
SELECT counterpart_name, count(*) AS n_cells, md5(string_agg(c || '=' || CAST(v AS VARCHAR), ',' ORDER BY c)) AS cells_md5
FROM (SELECT counterpart_name, CAST(row_id AS VARCHAR) AS c, sum(obs_value) AS v FROM obs GROUP BY ALL) GROUP BY counterpart_name
"""))
def q_pivot_sparse(spark, sf_dir):
    """Origin × observation, more columns than a wide pivot may have, as sparse rows."""
    p = X.pivot_sparse(obs_v(spark, sf_dir), "counterpart_name", "row_id")
    cells = F.transform(F.map_entries("cells"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return p.select("counterpart_name", F.size("cells").cast("long").alias("n_cells"), F.md5(F.array_join(cells, ",")).alias("cells_md5"))


QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.9, 0.95)


@register("quantile_states", _obs(f"""
SELECT p.probability, (SELECT count(obs_value) FROM obs) AS n, true AS within_bound
FROM (VALUES {", ".join(f"(CAST({q} AS DOUBLE))" for q in QUANTILES)}) p(probability)
"""))
def q_quantile_states(spark, sf_dir):
    """A sketch a year, merged; each quantile's rank, counted exactly, lies within the sketch's bound."""
    obs = obs_v(spark, sf_dir).select("year", "obs_value")
    found = written(ST.merged_quantiles(written(ST.quantile_states(obs, "year", "obs_value"), "quantile-states"), QUANTILES), "quantiles")
    errors = ST.rank_errors(obs, "obs_value", found)
    return found.join(errors, "probability").select("probability", "n", (F.col("error") <= ST.KLL_ERROR).alias("within_bound"))
