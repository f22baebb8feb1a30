"""Round-trip queries for source normalisation.

Spark writes each format from the observation table, the normaliser reads it
back; the oracle computes the expected canonical rows straight from the tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.operators import normalise as N
from lakeloom.operators.cells import norm_jsonstat_cells, norm_sdmx_cells
from lakeloom.operators.observations import sources_used
from lakeloom.operators.reshape import iso3_lookup
from lakeloom.plans import docbuild as D
from lakeloom.plans.catalog import register
from lakeloom.plans.sqltext import case_map, in_list, values_table
from lakeloom.plans.standins import OBS_V_SQL, migration_lines, obs_v, with_ctes
from lakeloom.session import written
from lakeloom.sources.text import parse_positional

FETCH_TS = _dt.datetime(2024, 1, 1)
FETCH_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
SUMT = "DECIMAL(38,4)"
CH = D.CHUNK


def _out(df):
    """Canonical columns; obs_value as exact decimal for the comparison."""
    return df.select(*[F.col(c).cast(SUMT).alias(c) if c == "obs_value" else F.col(c)
                       for c in R.CANONICAL_COLUMNS])


def _canon_sql(**cols) -> str:
    """SELECT list of the 19 canonical columns, NULL where not given."""
    parts = []
    for c in R.CANONICAL_COLUMNS:
        if c in cols:
            parts.append(f"{cols[c]} AS {c}")
        elif c == "year":
            parts.append("CAST(NULL AS INTEGER) AS year")
        elif c == "fetch_ts":
            parts.append(f"{FETCH_SQL} AS fetch_ts")
        else:
            parts.append(f"CAST(NULL AS VARCHAR) AS {c}")
    return ", ".join(parts)


METRIC_SQL = case_map("var_code", R.VAR_TO_METRIC)
SDMX_CELLS = f"""
SELECT CAST(floor(row_id / {CH}) AS BIGINT) AS doc_id, {{ra}} AS ref_area, var_code,
       CASE WHEN sex = 'T' THEN '_T' ELSE sex END AS sx, counterpart, counterpart_name, time_period,
       CAST(sum(obs_value) AS {SUMT}) AS v
FROM obs GROUP BY ALL
"""


def _sdmx_select(sex_out: str) -> str:
    return _canon_sql(
        ref_area="ref_area", ref_area_name=f"COALESCE({case_map('ref_area', N.AREA_TO_NAME)}, ref_area)",
        counterpart="counterpart", counterpart_name="counterpart_name", time_period="time_period",
        year="TRY_CAST(time_period AS INTEGER)", var_code="var_code", metric=f"COALESCE({METRIC_SQL}, var_code)",
        sex=sex_out, gender=f"COALESCE({case_map('sx', N.SEX_TO_GENDER)}, 'Total')", obs_value="v",
        obs_status="'A'", source_dataset="'OECD_MIG'")


@register("norm_sdmx", with_ctes(f"SELECT {_sdmx_select('sx')} FROM cells",
                                 obs=OBS_V_SQL, cells=SDMX_CELLS.format(ra="ref_area")))
def q_norm_sdmx(spark, sf_dir):
    """SDMX-JSON series documents → canonical rows (no filters: everything decoded)."""
    docs = D.sdmx_docs(obs_v(spark, sf_dir))
    return _out(N.norm_sdmx(docs, fetch_ts=FETCH_TS))


@register("norm_sdmx_filtered", with_ctes(f"""
SELECT {_sdmx_select("'_T'")} FROM cells c
WHERE ref_area = 'AME' AND var_code = 'B11'
  AND (sx = '_T' OR NOT EXISTS (SELECT 1 FROM cells d WHERE d.doc_id = c.doc_id AND d.sx = '_T'))
""", obs=OBS_V_SQL, cells=SDMX_CELLS.format(ra="ref_area")))
def q_norm_sdmx_filtered(spark, sf_dir):
    """N3 with country / measure / sex filters (sex applies only where the code exists)."""
    docs = D.sdmx_docs(obs_v(spark, sf_dir))
    return _out(N.norm_sdmx(docs, ref_area="AME", var_code="B11", sex="T", fetch_ts=FETCH_TS))


LARGE = 1 << 14  # observations of a document


@register("norm_sdmx_cells", with_ctes(f"SELECT {_sdmx_select('sx')} FROM cells", obs=OBS_V_SQL,
                                       cells=SDMX_CELLS.format(ra="ref_area").replace(f"row_id / {CH}", f"row_id / {LARGE}")))
def q_norm_sdmx_cells(spark, sf_dir):
    """SDMX-JSON documents of 16,384 observations each → canonical rows; cells are rows before they are decoded."""
    docs = written(D.sdmx_docs(obs_v(spark, sf_dir), LARGE), "sdmx-large")
    return _out(norm_sdmx_cells(docs, fetch_ts=FETCH_TS))


JSTAT_CELLS = f"""
SELECT CAST(floor(row_id / {CH}) AS BIGINT) AS doc_id, counterpart, counterpart_name, sex, time_period,
       CAST(sum(obs_value) AS {SUMT}) AS v
FROM obs GROUP BY ALL
"""
JSTAT_SELECT = _canon_sql(
    ref_area="'ITA'", ref_area_name="'Italy'", counterpart="counterpart", counterpart_name="counterpart_name",
    time_period="time_period", year="TRY_CAST(time_period AS INTEGER)", var_code="'B11'",
    metric="'Inflows of Foreign Population'", sex="sex",
    gender="CASE sex WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'Total' END", obs_value="v",
    source_dataset="'EUROSTAT'")


@register("norm_jsonstat", with_ctes(f"SELECT {JSTAT_SELECT} FROM cells", obs=OBS_V_SQL, cells=JSTAT_CELLS))
def q_norm_jsonstat(spark, sf_dir):
    """JSON-stat documents → canonical rows of every sex (flat keys decoded by strides)."""
    docs = D.jsonstat_docs(obs_v(spark, sf_dir))
    return _out(N.norm_jsonstat(docs, sex=None, fetch_ts=FETCH_TS))


@register("norm_jsonstat_sex", with_ctes(f"SELECT {JSTAT_SELECT} FROM cells WHERE sex = 'F'", obs=OBS_V_SQL, cells=JSTAT_CELLS))
def q_norm_jsonstat_sex(spark, sf_dir):
    """The cells of one sex."""
    docs = D.jsonstat_docs(obs_v(spark, sf_dir))
    return _out(N.norm_jsonstat(docs, sex="F", fetch_ts=FETCH_TS))


@register("norm_jsonstat_cells", with_ctes(f"SELECT {JSTAT_SELECT} FROM cells", obs=OBS_V_SQL, cells=JSTAT_CELLS.replace(f"row_id / {CH}", f"row_id / {LARGE}")))
def q_norm_jsonstat_cells(spark, sf_dir):
    """JSON-stat documents of 16,384 observations each → canonical rows of every sex; cells are rows before they are decoded."""
    docs = written(D.jsonstat_docs(obs_v(spark, sf_dir), LARGE), "jsonstat-large")
    return _out(norm_jsonstat_cells(docs, sex=None, fetch_ts=FETCH_TS))


# Sheets name origins and provinces that the fixed lookups hold, and some that they don't.
SHEET_NAMES = [name for name, _ in sorted(R.COUNTRY_ISO3.items())][::5] + ["Atlantis"]
SHEET_PLACES = sorted(R.PROVINCE_ISO) + ["Nowhere"]
_NUMBER_SQL = "COALESCE(TRY_CAST(regexp_extract(counterpart, '[0-9]+') AS INTEGER), 24)"


def _sheet_cells(names: list[str]) -> str:
    listed = "[" + in_list(names)[1:-1] + "]"
    return f"""
SELECT CAST(floor(row_id / {CH}) AS BIGINT) AS doc_id, {listed}[{_NUMBER_SQL} % {len(names)} + 1] AS name, year,
       CAST(sum(obs_value) AS {SUMT}) AS v
FROM obs GROUP BY ALL HAVING sum(obs_value) > 0
"""


def _named_obs(spark, sf_dir, names: list[str]):
    number = F.coalesce(F.nullif(F.regexp_extract("counterpart", "[0-9]+", 0), F.lit("")).cast("int"), F.lit(24))
    return obs_v(spark, sf_dir).withColumn("counterpart_name", F.element_at(F.array(*map(F.lit, names)), F.pmod(number, F.lit(len(names))) + 1))
ISO_JOIN = values_table(sorted(R.COUNTRY_ISO3.items()), ["lk_name", "lk_code"], "lk")


@register("norm_sheet", with_ctes(f"""
SELECT {_canon_sql(ref_area="'CAN'", ref_area_name="'Canada'",
                   counterpart="COALESCE(lk_code, CASE WHEN length(trim(name)) >= 3 THEN upper(substr(trim(name), 1, 3)) ELSE trim(name) END)",
                   counterpart_name="trim(name)", time_period="CAST(year AS VARCHAR)", year="year",
                   var_code="'PR'", metric="'Permanent Residents'", sex="'_T'", gender="'Total'",
                   obs_value="v", source_dataset="'IRCC'")}
FROM cells LEFT JOIN {ISO_JOIN} ON trim(name) = lk_name
""", obs=OBS_V_SQL, cells=_sheet_cells(SHEET_NAMES)))
def q_norm_sheet(spark, sf_dir):
    """S10 + N5: multi-header sheets → annual columns → canonical rows (citizenship mode)."""
    rows = N.sheet_rows(written(D.sheet_docs(_named_obs(spark, sf_dir, SHEET_NAMES)), "sheets"))
    return _out(N.norm_sheet(rows, "citizenship", iso3_lookup(spark), fetch_ts=FETCH_TS))


@register("norm_sheet_province", with_ctes(f"""
SELECT {_canon_sql(ref_area="'CAN'", ref_area_name="'Canada'", counterpart="'_T'",
                   counterpart_name="'All Countries'", time_period="CAST(year AS VARCHAR)", year="year",
                   var_code="'PR'", metric="'Permanent Residents'", sex="'_T'", gender="'Total'",
                   province=f"COALESCE({case_map('trim(name)', R.PROVINCE_ISO)}, trim(name))",
                   obs_value="v", source_dataset="'IRCC'")}
FROM cells
""", obs=OBS_V_SQL, cells=_sheet_cells(SHEET_PLACES)))
def q_norm_sheet_province(spark, sf_dir):
    """N5 province mode: ids are provinces, mapped to ISO codes (unknown kept)."""
    rows = N.sheet_rows(written(D.sheet_docs(_named_obs(spark, sf_dir, SHEET_PLACES)), "sheets"))
    return _out(N.norm_sheet(rows, "province", fetch_ts=FETCH_TS))


CSV_SELECT = _canon_sql(
    ref_area="'ITA'", ref_area_name="'Italy'", counterpart="trim(counterpart)",
    counterpart_name="trim(counterpart_name)", time_period="CAST(year AS VARCHAR)", year="CAST(year AS INTEGER)",
    var_code="trim(var_code)", metric=f"COALESCE({METRIC_SQL}, metric)", sex="sex",
    gender="CASE sex WHEN 'T' THEN 'Total' WHEN 'M' THEN 'Male' ELSE 'Female' END",
    obs_value=f"CAST(floor(obs_value) AS {SUMT})", source_dataset="'FALLBACK_CSV'")


def _csv_records(spark, sf_dir, obs=None):
    return parse_positional(migration_lines(spark, sf_dir, obs), casts={}, keep=["line_no"])


@register("norm_csv", with_ctes(f"SELECT {CSV_SELECT} FROM obs", obs=OBS_V_SQL))
def q_norm_csv(spark, sf_dir):
    """S6 + N1: headerless 11-field records → canonical rows (codes trimmed and labelled)."""
    return _out(N.norm_csv(_csv_records(spark, sf_dir), fetch_ts=FETCH_TS))


def _assembled(spark, sf_dir):
    o = written(obs_v(spark, sf_dir), "observations")  # the three sources are made of one read
    return N.assemble_country("ITA", {
        "OECD_MIG": N.norm_sdmx(D.sdmx_docs(o, ref_area="ITA"), fetch_ts=FETCH_TS),
        "EUROSTAT": N.norm_jsonstat(D.jsonstat_docs(o), fetch_ts=FETCH_TS),
        "FALLBACK_CSV": N.norm_csv(_csv_records(spark, sf_dir, o), fetch_ts=FETCH_TS)})


RANK_SQL = (f"COALESCE(CAST({case_map('source_dataset', {k: str(v) for k, v in R.SOURCE_PRIORITY.items()})} "
            f"AS INTEGER), {R.UNKNOWN_SOURCE_RANK})")
ASSEMBLY_KEY = list(R.DEDUP_KEY) + ["province"]  # province kept in the key (the fixed behaviour)
PAYLOAD = [c for c in R.CANONICAL_COLUMNS if c not in ASSEMBLY_KEY]
ASSEMBLY_SQL = with_ctes(f"""
SELECT {', '.join(f"COALESCE({c}, '') AS {c}" if c in ASSEMBLY_KEY else c for c in R.CANONICAL_COLUMNS)}
FROM (SELECT *, row_number() OVER (
        PARTITION BY {', '.join(f"COALESCE({k}, '')" for k in ASSEMBLY_KEY)}
        ORDER BY {', '.join(f"{k} IS NULL" for k in ASSEMBLY_KEY)}, {RANK_SQL},
                 {', '.join(f"{c} ASC NULLS FIRST" for c in PAYLOAD)}) AS rn
      FROM u) WHERE rn = 1
""", obs=OBS_V_SQL, cells=SDMX_CELLS.format(ra="'ITA'"), jcells=JSTAT_CELLS, u=f"""
SELECT {', '.join(f"CASE WHEN sex = '_T' THEN 'T' ELSE sex END AS sex" if c == 'sex' else c for c in R.CANONICAL_COLUMNS)} FROM (
  SELECT {_sdmx_select('sx')} FROM cells WHERE var_code IN ('B11', 'B12', 'B16')
  UNION ALL SELECT {JSTAT_SELECT} FROM jcells WHERE sex = 'T'
  UNION ALL SELECT {CSV_SELECT} FROM obs WHERE var_code IN ('B11', 'B12', 'B16'))
""")


@register("country_assembly", ASSEMBLY_SQL)
def q_country_assembly(spark, sf_dir):
    """Available sources (SDMX, JSON-stat, CSV) → union → one code for total sex → priority merge."""
    return _out(_assembled(spark, sf_dir))


@register("sources_used", with_ctes("SELECT DISTINCT source_dataset FROM a", a=ASSEMBLY_SQL))
def q_sources_used(spark, sf_dir):
    """The list of sources that supplied rows after the merge."""
    return sources_used(_assembled(spark, sf_dir))
