"""Exploration queries over the positional migration file and the text tables
(S5, S19, P1–P2, P12–P15, P17–P25, A1–A8, A18–A20, W2, W6, G1, G2, J3, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions import columns as C
from lakeloom.operators import explore as X
from lakeloom.operators import ranking
from lakeloom.operators import reshape as G
from lakeloom.plans.catalog import register
from lakeloom.plans.sqltext import YEARS_SQL, case_map, in_list, values_table
from lakeloom.plans.standins import MIGRATION_V_SQL, OBS_V_SQL, migration_lines, migration_v, with_ctes
from lakeloom.sources import text as TXT
from lakeloom.sources.tables import table

MIG_COLS = ["line_no"] + R.MIGRATION_FILE_COLUMNS


def _mig(body: str, **extra) -> str:
    return with_ctes(body, obs=OBS_V_SQL, mig=MIGRATION_V_SQL, **extra)


@register("parse_positional", _mig(f"SELECT {', '.join(MIG_COLS)} FROM mig"))
def q_parse_positional(spark, sf_dir):
    """S4 + S5: headerless comma lines → 11 named fields, Year int, Value long."""
    return migration_v(spark, sf_dir).select(*MIG_COLS)


@register("parse_positional_rejects", _mig("""
SELECT line_no, CASE WHEN line_no % 7 IN (0, 1) THEN NULL ELSE Value END AS Value, CASE WHEN line_no % 7 = 2 THEN NULL ELSE Year END AS Year,
       CASE WHEN line_no % 7 IN (0, 2) THEN 1 ELSE 0 END AS bad_fields
FROM mig WHERE line_no % 7 IN (0, 1, 2)
"""))
def q_parse_positional_rejects(spark, sf_dir):
    """S5 lenient mode: text instead of a value, a line that ends early, text instead of a
    year; typed fields that failed are counted."""
    kind = F.pmod("line_no", F.lit(7))
    lines = migration_lines(spark, sf_dir).withColumn("value", F.when(kind == 0, F.regexp_replace("value", "[^,]*$", "n/a"))
                                                      .when(kind == 1, F.regexp_replace("value", ",[^,]*$", ""))
                                                      .when(kind == 2, F.regexp_replace("value", "[^,]*,([^,]*)$", "MM,$1")).otherwise(F.col("value")))
    p = TXT.parse_positional(lines, casts={"Year": "int", "Value": "long"}, keep=["line_no"])
    return p.where(kind.isin(0, 1, 2)).select("line_no", "Value", "Year", F.col("_bad_fields").alias("bad_fields"))


@register("sql_view", _mig("SELECT Country, Year, Value FROM mig WHERE Value < 5000 AND Year >= 1999"))
def q_sql_view(spark, sf_dir):
    """SQL over a DataFrame with WHERE (order is not part of a set compare); the view lives for the call."""
    return spark.sql("SELECT Country, Year, Value FROM {mig} WHERE Value < 5000 AND Year >= 1999 ORDER BY Value",
                     mig=migration_v(spark, sf_dir))


@register("select_drop", _mig("SELECT line_no, Country, Value, CAST(Value AS DOUBLE) / 2.0 AS Value_new FROM mig"))
def q_select_drop(spark, sf_dir):
    """P1 + P2: project, derive Value/2, drop the rest."""
    m = migration_v(spark, sf_dir)
    keep = m.select("line_no", "Country", "Value").withColumn("Value_new", F.col("Value") / 2.0)
    return keep.drop("Variable")


@register("filter_count", _mig("SELECT count(*) AS n FROM mig WHERE Country = 'NATION_3'"))
def q_filter_count(spark, sf_dir):
    """Equality filter + count."""
    return migration_v(spark, sf_dir).where(F.col("Country") == "NATION_3").agg(F.count(F.lit(1)).alias("n"))


@register("filter_in", _mig("""
SELECT line_no, Country, Year, Value FROM mig
WHERE Country IN ('NATION_1', 'NATION_2', 'NATION_3') AND Variable = 'Metric B11' AND Year = 1999 AND Value < 200000
"""))
def q_filter_in(spark, sf_dir):
    """P13 + P14 + P15: membership, conjunction and comparison filters."""
    m = migration_v(spark, sf_dir)
    return (m.where(F.col("Country").isin("NATION_1", "NATION_2", "NATION_3")
                    & (F.col("Variable") == "Metric B11") & (F.col("Year") == 1999)
                    & (F.col("Value") < 200000))
            .select("line_no", "Country", "Year", "Value"))


@register("sum_by_key", _mig("SELECT Country, CAST(sum(Value) AS BIGINT) AS Value FROM mig GROUP BY Country"))
def q_sum_by_key(spark, sf_dir):
    """A1 / A4: reduceByKey as a grouped sum (dict-style agg)."""
    return migration_v(spark, sf_dir).groupBy("Country").agg({"Value": "sum"}).withColumnRenamed(
        "sum(Value)", "Value")


@register("having_threshold", _mig("SELECT Country, CAST(sum(Value) AS BIGINT) AS total FROM mig GROUP BY Country "
                                   "HAVING sum(Value) > 100000000"))
def q_having_threshold(spark, sf_dir):
    """A2 + W7: totals above a threshold, ascending."""
    return (migration_v(spark, sf_dir).groupBy("Country").agg(F.sum("Value").alias("total"))
            .where(F.col("total") > 100_000_000).orderBy("total"))


@register("total_for_key", _mig("SELECT CAST(sum(Value) AS BIGINT) AS total FROM mig WHERE Country = 'NATION_7'"))
def q_total_for_key(spark, sf_dir):
    """A3: keyed map + reduce for one country."""
    return migration_v(spark, sf_dir).where(F.col("Country") == "NATION_7").agg(F.sum("Value").alias("total"))


@register("total_for_missing_key", _mig("SELECT CAST(sum(Value) AS BIGINT) AS total FROM mig WHERE Country = 'Atlantis'"))
def q_total_for_missing_key(spark, sf_dir):
    """A3 with no matching rows: one row, NULL total (the reference raised)."""
    return migration_v(spark, sf_dir).where(F.col("Country") == "Atlantis").agg(F.sum("Value").alias("total"))


@register("group_to_list", _mig("SELECT Country, list_sort(list(Value)) AS values FROM mig GROUP BY Country"))
def q_group_to_list(spark, sf_dir):
    """A5: groupByKey of values per country, one sorted list per country."""
    return X.group_to_list(migration_v(spark, sf_dir), ["Country"], "Value", "values")


@register("distinct_values", _mig("SELECT DISTINCT Variable FROM mig"))
def q_distinct_values(spark, sf_dir):
    """Distinct / dropDuplicates."""
    return migration_v(spark, sf_dir).select("Variable").dropDuplicates()


@register("describe_value", _mig("""
SELECT count(Value) AS count, CAST(round(avg(Value), 4) AS DECIMAL(38,4)) AS mean,
       CAST(round(stddev_samp(Value), 4) AS DECIMAL(38,4)) AS stddev, min(Value) AS min, max(Value) AS max
FROM mig
"""))
def q_describe_value(spark, sf_dir):
    """Count, mean, stddev, min, max in one aggregate (rounded here, for the compare)."""
    d = X.describe(migration_v(spark, sf_dir), "Value")
    return d.select("count", *[F.round(c, 4).cast("decimal(38,4)").alias(c) for c in ("mean", "stddev")], "min", "max")


@register("crosstab_counts", _mig(
    "SELECT Country AS Country_Year, COALESCE(COLUMNS(* EXCLUDE Country), 0) "
    f"FROM (PIVOT (SELECT Country, Year FROM mig) ON Year IN {YEARS_SQL} USING count(*) GROUP BY Country)"))
def q_crosstab_counts(spark, sf_dir):
    """Country × Year counts, a column for each year in the data."""
    return X.crosstab(migration_v(spark, sf_dir), "Country", "Year")


@register("yearly_sum_by_variable", _mig("SELECT Variable, CAST(sum(Value) AS BIGINT) AS Value FROM mig WHERE Year = 1999 GROUP BY Variable"))
def q_yearly_sum_by_variable(spark, sf_dir):
    """One year's totals by variable."""
    m = migration_v(spark, sf_dir)
    return m.where(F.col("Year") == 1999).groupBy("Variable").agg(F.sum("Value").alias("Value"))


@register("year_series_mean", _mig("""
SELECT Year, Country, CAST(round(avg(Value), 4) AS DECIMAL(38,4)) AS mean_value FROM mig GROUP BY Year, Country
"""))
def q_year_series_mean(spark, sf_dir):
    """Mean per (year, series) — what a line plot shows for repeated x."""
    return (migration_v(spark, sf_dir).groupBy("Year", "Country")
            .agg(F.round(F.avg("Value"), 4).cast("decimal(38,4)").alias("mean_value")))


@register("quantile_class", _mig("""
SELECT Country, total, CAST(len(list_filter(br, lambda x: x < total)) AS INTEGER) AS class FROM t, b
""", t="SELECT Country, CAST(sum(Value) AS BIGINT) AS total FROM mig WHERE Year = 2000 GROUP BY Country",
    b="SELECT quantile_cont(CAST(total AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS br FROM t"))
def q_quantile_class(spark, sf_dir):
    """Five quantile classes of per-country totals for one year (map legend)."""
    t = (migration_v(spark, sf_dir).where(F.col("Year") == 2000)
         .groupBy("Country").agg(F.sum("Value").alias("total")))
    return X.quantile_classes(t, "total", 5)


@register("value_rank", _mig("SELECT line_no, Value, rank() OVER (ORDER BY Value) AS rank FROM mig"))
def q_value_rank(spark, sf_dir):
    """Min-rank of every row by Value, without a single-partition window."""
    return ranking.min_rank(migration_v(spark, sf_dir).select("line_no", "Value"), "Value")


@register("order_limit", _mig("SELECT line_no, Country, Year, Value FROM mig ORDER BY Year DESC, Value DESC, line_no LIMIT 5"))
def q_order_limit(spark, sf_dir):
    """Sort descending + limit (top-k is the feature)."""
    m = migration_v(spark, sf_dir).select("line_no", "Country", "Year", "Value")
    return X.order_limit(m, [F.col("Year").desc(), F.col("Value").desc(), F.col("line_no")], 5)


WIDE_IDS = ["area_name", "reg_name", "counterpart_name"]
IDS = ', '.join(WIDE_IDS)


def _wide(spark, sf_dir):
    """wide_v: one column per year of the data (missing → NULL), as a year-per-column sheet."""
    from lakeloom.plans.standins import obs_v
    return X.pivot_sum(obs_v(spark, sf_dir), WIDE_IDS, "year", fill=None)


@register("unpivot_years", _mig(f"""
SELECT {', '.join(f'i.{c}' for c in WIDE_IDS)}, y.year AS DateYear, COALESCE(CAST(s.v AS DOUBLE), 0) AS PeopleQtd
FROM (SELECT DISTINCT {IDS} FROM obs) i CROSS JOIN (SELECT DISTINCT year FROM obs) y
LEFT JOIN (SELECT {IDS}, year, sum(obs_value) AS v FROM obs GROUP BY {IDS}, year) s
  ON {' AND '.join(f'i.{c} IS NOT DISTINCT FROM s.{c}' for c in WIDE_IDS)} AND y.year = s.year"""))
def q_unpivot_years(spark, sf_dir):
    """Year columns → (DateYear, PeopleQtd), coerced numeric, missing → 0."""
    wide = _wide(spark, sf_dir)
    return G.unpivot_years(wide, WIDE_IDS, [c for c in wide.columns if c not in WIDE_IDS])


@register("pivot_unique", _mig(
    "SELECT * FROM (PIVOT (SELECT area_name, year, sum(obs_value) AS v FROM obs GROUP BY area_name, year) "
    f"ON year IN {YEARS_SQL} USING first(v) GROUP BY area_name)"))
def q_pivot_unique(spark, sf_dir):
    """Long (area, year, value) with one value per cell → pivot by first(); a
    duplicated cell raises inside the job."""
    from lakeloom.plans.standins import obs_v
    return G.pivot_unique(X.group_totals(obs_v(spark, sf_dir), ["area_name", "year"]), "area_name", "year", "obs_value")


@register("outer_fill", _mig(f"""
SELECT COALESCE(s.name, t.Country) AS name, s.region, COALESCE(t.total, 0) AS total
FROM (SELECT n_name AS name, n_regionkey AS region FROM nation) s
FULL OUTER JOIN (SELECT Country, CAST(sum(Value) AS BIGINT) AS total FROM mig WHERE Year = 2000 GROUP BY Country
                 UNION ALL SELECT 'Atlantis', 1) t ON s.name = t.Country
"""))
def q_outer_fill(spark, sf_dir):
    """Shapes ⟗ one year of totals on name, missing totals → 0."""
    shapes = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    m = migration_v(spark, sf_dir)
    totals = (m.where(F.col("Year") == 2000).groupBy("Country").agg(F.sum("Value").alias("total"))
              .unionByName(spark.range(1).select(F.lit("Atlantis").alias("Country"), F.lit(1).cast("long").alias("total"))))
    return G.outer_fill(shapes, totals, "name", "Country", {"total": 0})


@register("null_split", with_ctes("""
SELECT area_name IS NULL AS is_total, count(*) AS n, sum(obs_value) AS total FROM obs GROUP BY 1
""", obs=OBS_V_SQL))
def q_null_split(spark, sf_dir):
    """NULL region rows vs the rest, summarised per side in one pass."""
    from lakeloom.plans.standins import obs_v
    return (obs_v(spark, sf_dir).groupBy(F.col("area_name").isNull().alias("is_total"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("obs_value").alias("total")))


@register("null_split_rows", with_ctes("""
SELECT 'area_total' AS part, row_id FROM obs WHERE area_name IS NULL
UNION ALL SELECT 'flow', row_id FROM obs WHERE area_name IS NOT NULL
""", obs=OBS_V_SQL))
def q_null_split_rows(spark, sf_dir):
    """The two sides as rows."""
    from lakeloom.plans.standins import obs_v
    totals, flows = G.null_split(obs_v(spark, sf_dir).select("row_id", "area_name"), "area_name")
    return (totals.select(F.lit("area_total").alias("part"), "row_id")
            .unionByName(flows.select(F.lit("flow").alias("part"), "row_id")))


@register("null_fill", _mig(f"""
SELECT {IDS}, COALESCE(COLUMNS(* EXCLUDE ({IDS})), 0)
FROM (PIVOT (SELECT {IDS}, year, obs_value FROM obs) ON year IN {YEARS_SQL} USING sum(obs_value) GROUP BY {IDS})"""))
def q_null_fill(spark, sf_dir):
    """Numeric NULLs → 0 (string NULLs untouched)."""
    return _wide(spark, sf_dir).na.fill(0)


@register("coerce_numeric", with_ctes("""
SELECT event_id,
       TRY_CAST(regexp_extract(props, ':\\s*([^}]*)', 1) AS DOUBLE) AS k_value,
       TRY_CAST(event_type AS DOUBLE) AS type_as_number
FROM events
"""))
def q_coerce_numeric(spark, sf_dir):
    """P20: text → number, non-numeric → NULL."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id",
                    C.coerce_numeric(F.regexp_extract("props", r":\s*([^}]*)", 1)).alias("k_value"),
                    C.coerce_numeric("event_type").alias("type_as_number"))


ISO_ROWS = sorted(R.COUNTRY_ISO3.items())


NAMES = [name for name, _ in ISO_ROWS][::4] + ["Atlantis", "Oz", " Peru "]
PROVINCES = sorted(R.PROVINCE_ISO)[::2] + ["Nowhere"]
PEOPLE_SQL = f"""SELECT c_custkey, {in_list(NAMES).replace('(', '[', 1)[:-1]}][c_custkey % {len(NAMES)} + 1] AS name,
  {in_list(PROVINCES).replace('(', '[', 1)[:-1]}][c_custkey % {len(PROVINCES)} + 1] AS place FROM customer"""


@register("name_to_code", with_ctes(f"""
SELECT c.c_custkey, c.name,
       COALESCE(l.code, CASE WHEN length(trim(c.name)) >= 3 THEN upper(substr(trim(c.name), 1, 3)) ELSE trim(c.name) END) AS code,
       COALESCE(p.iso, c.place) AS province
FROM people c
LEFT JOIN {values_table(ISO_ROWS, ['name', 'code'], 'l')} ON trim(c.name) = l.name
LEFT JOIN {values_table(sorted(R.PROVINCE_ISO.items()), ['pname', 'iso'], 'p')} ON c.place = p.pname
""", people=PEOPLE_SQL))
def q_name_to_code(spark, sf_dir):
    """P21 + P22: names → ISO3 via a fixed lookup (broadcast: bounded by the rule
    table), else the upper-cased first three letters; province codes likewise. Names
    and provinces are dealt to the customers from the lookups, with some unknown."""
    from lakeloom.operators.observations import province_iso

    def dealt(values):
        return F.element_at(F.array(*map(F.lit, values)), (F.pmod("c_custkey", F.lit(len(values))) + 1).cast("int"))
    people = table(spark, sf_dir, "customer").select("c_custkey", dealt(NAMES).alias("name"), dealt(PROVINCES).alias("place"))
    return G.name_to_code(people, "name", spark).select("c_custkey", "name", "code", province_iso("place").alias("province"))


@register("code_labels", _mig(f"""
SELECT line_no,
       COALESCE({case_map('VAR', R.VAR_TO_METRIC)}, Variable) AS metric,
       CASE WHEN trim(GEN) IN ('TOT', 'T') THEN 'T' WHEN trim(GEN) IN ('MAS', 'M') THEN 'M' ELSE 'F' END AS sex,
       COALESCE({case_map('trim(GEN)', R.GEN_TO_GENDER)}, 'Total') AS gender
FROM mig
"""))
def q_code_labels(spark, sf_dir):
    """Code → label for metric (falls back to the Variable text), sex, gender."""
    m = migration_v(spark, sf_dir)
    return m.select("line_no",
                    F.coalesce(F.try_element_at(C.literal_map(R.VAR_TO_METRIC), F.col("VAR")), F.col("Variable")).alias("metric"),
                    C.sex_code("GEN").alias("sex"),
                    F.coalesce(F.try_element_at(C.literal_map(R.GEN_TO_GENDER), F.trim("GEN")), F.lit("Total")).alias("gender"))


@register("year_of_period", with_ctes("""
SELECT o_orderkey, period,
       TRY_CAST(CASE WHEN contains(period, '-Q') THEN split_part(period, '-', 1) ELSE period END AS INTEGER) AS year
FROM (SELECT o_orderkey,
        CASE o_orderkey % 3 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR)
                            WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE o_orderpriority END AS period
      FROM orders)
"""))
def q_year_of_period(spark, sf_dir):
    """P24: '2023-Q1' → 2023, '2023' → 2023, other text → NULL."""
    o = table(spark, sf_dir, "orders")
    k = F.pmod("o_orderkey", F.lit(3))
    y = F.year("o_orderdate").cast("string")
    period = (F.when(k == 0, F.concat(y, F.lit("-Q"), F.quarter("o_orderdate").cast("string")))
              .when(k == 1, y).otherwise(F.col("o_orderpriority")))
    return o.select("o_orderkey", period.alias("period")).withColumn("year", C.year_of_period("period"))


@register("slugify", with_ctes("""
SELECT p_partkey, regexp_replace(regexp_replace(p_name || ' / ' || p_type || ' (' || p_brand || ')', '[^0-9a-zA-Z]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug
FROM part
"""))
def q_slugify(spark, sf_dir):
    """P25: descriptions → safe column names."""
    p = table(spark, sf_dir, "part")
    desc = F.concat_ws("", "p_name", F.lit(" / "), "p_type", F.lit(" ("), "p_brand", F.lit(")"))
    return p.select("p_partkey", C.slugify(desc).alias("slug"))


@register("char_explode", with_ctes("""
SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) GROUP BY ch
"""))
def q_char_explode(spark, sf_dir):
    """flatMap over whole texts yields characters; counted per character."""
    d = table(spark, sf_dir, "documents").select("text")
    return d.select(TXT.characters(F.col("text")).alias("ch")).groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
