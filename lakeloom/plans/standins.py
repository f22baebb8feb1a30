"""Business-shaped inputs derived by Spark from the given tables.

* ``claims_v`` / ``contracts_v`` — claim and contract files (all-string
  columns) from ``orders`` / ``customer``.
* ``obs_v`` — the 19-column observation table from orders ⋈ customer ⋈ nation ⋈ region,
  with four source labels competing for the same dedup key.

They grow with the tables, so every query built on them scales with the data.
Small dimension tables (nation, region: fixed by the schema) may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.sources.tables import table


def _status_prefix(c):
    return (F.when(c == "F", F.lit("CL")).when(c == "O", F.lit("RX")).otherwise(F.lit("CX")))


def region_of(orderkey_col) -> F.Column:
    """Region label that splits the claims into three input folders (every row kept)."""
    idx = F.pmod(orderkey_col, F.lit(3))
    expr = None
    for i, (name, _, _) in enumerate(R.REGION_FORMATS):
        expr = F.when(idx == i, F.lit(name)) if expr is None else expr.when(idx == i, F.lit(name))
    return expr


def claims_v(spark: SparkSession, sf_dir: str, per_region_formats: bool = False) -> DataFrame:
    """Claims as all-string columns. With ``per_region_formats`` each row's dates are
    written in its region's pattern and a ``REGION`` column is added."""
    o = table(spark, sf_dir, "orders")
    prio = F.substring("o_orderpriority", 1, 1)
    if per_region_formats:
        region = region_of(F.col("o_orderkey"))
        date_txt = None
        ts_txt = None
        for name, d, t in R.REGION_FORMATS:
            dcase = F.date_format("o_orderdate", d)
            tcase = F.date_format("o_orderdate", t)
            date_txt = (F.when(region == name, dcase) if date_txt is None
                        else date_txt.when(region == name, dcase))
            ts_txt = (F.when(region == name, tcase) if ts_txt is None
                      else ts_txt.when(region == name, tcase))
        extra = [region.alias("REGION")]
    else:
        _, d, t = R.REGION_FORMATS[0]
        date_txt = F.date_format("o_orderdate", d)
        ts_txt = F.date_format("o_orderdate", t)
        extra = []
    return o.select(
        F.lit("CLAIMS_SRC").alias("SOURCE_SYSTEM"),
        F.concat(_status_prefix(F.col("o_orderstatus")), F.lit("_"),
                 F.col("o_orderkey").cast("string")).alias("CLAIM_ID"),
        F.lit("SRC").alias("CONTRACT_SOURCE_SYSTEM"),
        F.col("o_custkey").cast("string").alias("CONTRACT_ID"),
        F.when(prio == "5", F.lit(None).cast("string")).otherwise(prio).alias("CLAIM_TYPE"),
        date_txt.alias("DATE_OF_LOSS"),
        (F.col("o_totalprice").cast("decimal(16,2)") - F.lit(50000)).cast("string").alias("AMOUNT"),
        ts_txt.alias("CREATION_DATE"),
        *extra,
    )


def contracts_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # One segment's contracts have keys that no claim names, so that some claims match nothing.
    key = F.col("c_custkey").cast("string")
    return c.select(F.lit("SRC").alias("SOURCE_SYSTEM"),
                    F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("B"), key)).otherwise(key).alias("CONTRACT_ID"),
                    F.col("c_mktsegment").alias("CONTRACT_TYPE"))


def claims_dirty_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``claims_v`` with one kind of fault in each of ten residues of the order key."""
    fault = F.pmod(F.element_at(F.split("CLAIM_ID", "_"), -1).cast("long"), F.lit(50))
    number = F.element_at(F.split("CLAIM_ID", "_"), -1)
    c = claims_v(spark, sf_dir).withColumn("_f", fault).withColumn("_n", number)
    on = lambda k, value, column: F.when(F.col("_f") == k, value).otherwise(F.col(column))
    none = F.lit(None).cast("string")
    return (c.withColumn("AMOUNT", F.when(F.col("_f") == 3, none).when(F.col("_f").isin(4, 10), F.lit("n/a")).otherwise(F.col("AMOUNT")))
            .withColumn("DATE_OF_LOSS", on(5, F.lit("31.02.2020"), "DATE_OF_LOSS"))
            .withColumn("CREATION_DATE", F.when(F.col("_f").isin(6, 10), F.lit("soon")).otherwise(F.col("CREATION_DATE")))
            .withColumn("CLAIM_TYPE", on(7, F.lit("9"), "CLAIM_TYPE"))
            .withColumn("CLAIM_ID", F.when(F.col("_f") == 1, none).when(F.col("_f") == 2, F.concat(F.lit("claim "), "_n"))
                        .when(F.col("_f") == 8, F.concat(F.lit("CL_3000000"), "_n")).when(F.col("_f") == 9, F.lit("CL_7"))
                        .otherwise(F.col("CLAIM_ID"))).drop("_f", "_n"))


SOURCE_BY_MOD4 = ["OECD_MIG", "EUROSTAT", "IRCC", "OTHER"]


def obs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical 19-column observation table plus ``row_id`` (input order)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: safe to broadcast.
    n = F.broadcast(table(spark, sf_dir, "nation"))
    r = F.broadcast(table(spark, sf_dir, "region"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))
    year = F.year("o_orderdate")
    sex = (F.when(F.col("o_orderstatus") == "F", F.lit("F"))
           .when(F.col("o_orderstatus") == "O", F.lit("M")).otherwise(F.lit("T")))
    gender = (F.when(sex == "F", F.lit("Female")).when(sex == "M", F.lit("Male"))
              .otherwise(F.lit("Total")))
    src_idx = F.pmod(F.col("o_orderkey"), F.lit(4))
    src = (F.when(src_idx == 0, F.lit(SOURCE_BY_MOD4[0])).when(src_idx == 1, F.lit(SOURCE_BY_MOD4[1]))
           .when(src_idx == 2, F.lit(SOURCE_BY_MOD4[2])).otherwise(F.lit(SOURCE_BY_MOD4[3])))
    var_code = F.concat(F.lit("B1"), F.substring("o_orderpriority", 1, 1))
    return j.select(
        F.col("o_orderkey").alias("row_id"),
        F.substring("r_name", 1, 3).alias("ref_area"),
        F.col("r_name").alias("ref_area_name"),
        F.when(F.col("n_nationkey") == 24, F.lit("UNK"))
         .otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("counterpart"),
        F.col("n_name").alias("counterpart_name"),
        year.cast("string").alias("time_period"),
        year.alias("year"),
        F.lit(None).cast("string").alias("quarter"),
        var_code.alias("var_code"),
        F.concat(F.lit("Metric "), var_code).alias("metric"),
        sex.alias("sex"),
        gender.alias("gender"),
        F.when(F.col("r_name") == "ASIA", F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("area_name"),
        F.col("c_mktsegment").alias("reg_name"),
        F.lit(None).cast("string").alias("province"),
        F.lit(None).cast("string").alias("imm_category"),
        # four decimals, so that a sum cut to cents shows
        F.expr("CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(o_orderkey % 97 AS DECIMAL(9,0)) * 0.0001BD AS DECIMAL(18,4))")
        .alias("obs_value"),
        F.lit(None).cast("string").alias("obs_status"),
        src.alias("source_dataset"),
        F.col("o_orderdate").alias("fetch_ts"),
    )


# DuckDB twins of the stand-ins, used as CTEs by the oracle SQL.
CLAIMS_V_SQL = """
SELECT 'CLAIMS_SRC' AS SOURCE_SYSTEM,
       (CASE o_orderstatus WHEN 'F' THEN 'CL' WHEN 'O' THEN 'RX' ELSE 'CX' END) || '_' || CAST(o_orderkey AS VARCHAR) AS CLAIM_ID,
       'SRC' AS CONTRACT_SOURCE_SYSTEM,
       CAST(o_custkey AS VARCHAR) AS CONTRACT_ID,
       CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS CLAIM_TYPE,
       strftime(o_orderdate, '%d.%m.%Y') AS DATE_OF_LOSS,
       CAST(CAST(o_totalprice AS DECIMAL(16,2)) - 50000 AS VARCHAR) AS AMOUNT,
       strftime(o_orderdate, '%d.%m.%Y %H:%M') AS CREATION_DATE,
       o_orderkey
FROM orders
"""

CONTRACTS_V_SQL = """
SELECT 'SRC' AS SOURCE_SYSTEM, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE '' END || CAST(c_custkey AS VARCHAR) AS CONTRACT_ID,
       c_mktsegment AS CONTRACT_TYPE
FROM customer
"""

CLAIMS_DIRTY_V_SQL = """
SELECT SOURCE_SYSTEM,
       CASE o_orderkey % 50 WHEN 1 THEN NULL WHEN 2 THEN 'claim ' || o_orderkey WHEN 8 THEN 'CL_3000000' || o_orderkey WHEN 9 THEN 'CL_7' ELSE CLAIM_ID END AS CLAIM_ID,
       CONTRACT_SOURCE_SYSTEM, CONTRACT_ID,
       CASE o_orderkey % 50 WHEN 7 THEN '9' ELSE CLAIM_TYPE END AS CLAIM_TYPE,
       CASE o_orderkey % 50 WHEN 5 THEN '31.02.2020' ELSE DATE_OF_LOSS END AS DATE_OF_LOSS,
       CASE o_orderkey % 50 WHEN 3 THEN NULL WHEN 4 THEN 'n/a' WHEN 10 THEN 'n/a' ELSE AMOUNT END AS AMOUNT,
       CASE o_orderkey % 50 WHEN 6 THEN 'soon' WHEN 10 THEN 'soon' ELSE CREATION_DATE END AS CREATION_DATE,
       o_orderkey
FROM claims_clean_v
"""

OBS_V_SQL = """
SELECT o_orderkey AS row_id,
       substr(r_name, 1, 3) AS ref_area,
       r_name AS ref_area_name,
       CASE WHEN n_nationkey = 24 THEN 'UNK' ELSE 'N' || CAST(n_nationkey AS VARCHAR) END AS counterpart,
       n_name AS counterpart_name,
       CAST(year(o_orderdate) AS VARCHAR) AS time_period,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(NULL AS VARCHAR) AS quarter,
       'B1' || substr(o_orderpriority, 1, 1) AS var_code,
       'Metric B1' || substr(o_orderpriority, 1, 1) AS metric,
       CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'T' END AS sex,
       CASE o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'Total' END AS gender,
       CASE WHEN r_name = 'ASIA' THEN NULL ELSE r_name END AS area_name,
       c_mktsegment AS reg_name,
       CAST(NULL AS VARCHAR) AS province,
       CAST(NULL AS VARCHAR) AS imm_category,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(o_orderkey % 97 AS DECIMAL(9,0)) * 0.0001 AS DECIMAL(18,4)) AS obs_value,
       CAST(NULL AS VARCHAR) AS obs_status,
       CASE o_orderkey % 4 WHEN 0 THEN 'OECD_MIG' WHEN 1 THEN 'EUROSTAT' WHEN 2 THEN 'IRCC' ELSE 'OTHER' END AS source_dataset,
       o_orderdate AS fetch_ts
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


def with_ctes(body: str, **ctes: str) -> str:
    """``WITH name AS (sql), ...`` + body, for the DuckDB oracle."""
    if not ctes:
        return body
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def migration_lines(spark: SparkSession, sf_dir: str, obs: DataFrame | None = None) -> DataFrame:
    """The headerless 11-field migration file as text lines (``line_no``, ``value``),
    written by Spark from the observation table (``obs``, if it is at hand)."""
    o = obs_v(spark, sf_dir) if obs is None else obs
    gen = (F.when(F.col("sex") == "T", F.lit("TOT")).when(F.col("sex") == "M", F.lit("MAS"))
           .otherwise(F.lit("FEM")))
    return o.select(F.col("row_id").alias("line_no"), F.concat_ws(
        ",", "ref_area", "ref_area_name", "var_code", "metric", gen, "gender", "counterpart",
        "counterpart_name", F.col("year").cast("string"), F.col("year").cast("string"),
        F.floor("obs_value").cast("long").cast("string")).alias("value"))


def migration_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed migration records: 11 named fields, ``Year`` int, ``Value`` long."""
    from lakeloom.sources.text import parse_positional
    return parse_positional(migration_lines(spark, sf_dir), casts={"Year": "int", "Value": "long"},
                            keep=["line_no"]).drop("_bad_fields")


MIGRATION_V_SQL = """
SELECT row_id AS line_no, ref_area AS CO2, ref_area_name AS Country_Nationality, var_code AS VAR,
       metric AS Variable, CASE sex WHEN 'T' THEN 'TOT' WHEN 'M' THEN 'MAS' ELSE 'FEM' END AS GEN,
       gender AS Gender, counterpart AS COU, counterpart_name AS Country,
       CAST(year AS VARCHAR) AS YEA, CAST(year AS INTEGER) AS Year, CAST(floor(obs_value) AS BIGINT) AS Value
FROM obs
"""


CLAIMS_REGION_SQL = """
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'Europe 3' WHEN 1 THEN 'Asia Pacific 1' ELSE 'North America 2' END AS REGION,
       (CASE o_orderstatus WHEN 'F' THEN 'CL' WHEN 'O' THEN 'RX' ELSE 'CX' END) || '_' || CAST(o_orderkey AS VARCHAR) AS CLAIM_ID,
       'SRC' AS CONTRACT_SOURCE_SYSTEM, CAST(o_custkey AS VARCHAR) AS CONTRACT_ID,
       CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS CLAIM_TYPE,
       CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE strftime(o_orderdate, '%m/%d/%Y') END AS DATE_OF_LOSS,
       CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y %H:%M') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M')
            ELSE strftime(o_orderdate, '%m/%d/%Y %H:%M') END AS CREATION_DATE,
       CAST(CAST(o_totalprice AS DECIMAL(16,2)) - 50000 AS VARCHAR) AS AMOUNT,
       o_orderkey
FROM orders
"""
