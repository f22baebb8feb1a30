"""Queries of the claims → transactions flow."""

from __future__ import annotations

import datetime as _dt
import re
import uuid

from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions import columns as C
from lakeloom.operators import claims as CL
from lakeloom.operators import quality as Q
from lakeloom.plans.catalog import register
from lakeloom.plans.sqltext import case_map, case_prefix, in_list
from lakeloom.plans.standins import (CLAIMS_DIRTY_V_SQL, CLAIMS_V_SQL, CONTRACTS_V_SQL, claims_dirty_v, claims_v,
                                     contracts_v, with_ctes)
from lakeloom.session import scratch_path

# A fixed batch timestamp makes SYSTEM_TIMESTAMP reproducible between runs.
RUN_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)
RUN_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
EU = R.TransactionRules()

TYPE_SQL = case_map("c.CLAIM_TYPE", R.TRANSACTION_TYPE_MAPPING, R.TRANSACTION_TYPE_DEFAULT)
DIRECTION_SQL = case_prefix("c.CLAIM_ID", R.TRANSACTION_DIRECTION_MAPPING)
SSID_SQL = r"TRY_CAST(NULLIF(regexp_extract(c.CLAIM_ID, '_(\d+)$', 1), '') AS INTEGER)"
CV_SQL = "CAST(c.AMOUNT AS DECIMAL(16,5))"
BD_SQL = "CAST(strptime(c.DATE_OF_LOSS, '%d.%m.%Y') AS DATE)"
CD_SQL = "strptime(c.CREATION_DATE, '%d.%m.%Y %H:%M')"
CLAIMS_CTES = dict(claims_v=CLAIMS_V_SQL, contracts_v=CONTRACTS_V_SQL)
DIRTY_CTES = dict(claims_clean_v=CLAIMS_V_SQL, claims_v=CLAIMS_DIRTY_V_SQL)

def _transactions_sql(nse_id: str = "md5(c.CLAIM_ID)", lenient: bool = False, **ctes: str) -> str:
    value, day, at = (re.sub(r"\bCAST\(", "TRY_CAST(", x).replace("strptime", "try_strptime") if lenient else x for x in (CV_SQL, BD_SQL, CD_SQL))
    return with_ctes(f"""
SELECT 'Europe 3' AS CONTRACT_SOURCE_SYSTEM,
       CASE WHEN k.CONTRACT_ID IS NOT NULL THEN CAST(c.CONTRACT_ID AS BIGINT) END AS CONTRACT_SOURCE_SYSTEM_ID,
       {SSID_SQL} AS SOURCE_SYSTEM_ID,
       {TYPE_SQL} AS TRANSACTION_TYPE,
       {DIRECTION_SQL} AS TRANSACTION_DIRECTION,
       {value} AS CONFORMED_VALUE,
       {day} AS BUSINESS_DATE,
       {at} AS CREATION_DATE,
       {RUN_TS_SQL} AS SYSTEM_TIMESTAMP,
       {nse_id} AS NSE_ID,
       CASE WHEN {value} < 0 THEN 'REFUND' ELSE 'CHARGE' END AS TRANSACTION_CATEGORY
FROM claims_v c LEFT JOIN contracts_v k
  ON c.CONTRACT_SOURCE_SYSTEM = k.SOURCE_SYSTEM AND c.CONTRACT_ID = k.CONTRACT_ID
""", **ctes)


TRANSACTIONS_SQL = _transactions_sql(**CLAIMS_CTES)
DIRTY_TRANSACTIONS_SQL = _transactions_sql(lenient=True, contracts_v=CONTRACTS_V_SQL, **DIRTY_CTES)


def _md4_sql(source: str, column: str) -> str:
    """(text, md4) of a column of ASCII texts of up to 55 characters, one block each, by the 48 steps of RFC 1320."""
    def word(k: int) -> str:
        if k == 14:
            return f"length({column}) * 8"
        if k == 15:
            return "0"
        byte = lambda i: f"(CASE WHEN {i} <= length({column}) THEN ascii(substr({column}, {i}, 1)) WHEN {i} = length({column}) + 1 THEN 128 ELSE 0 END)"
        return " + ".join(f"CAST({byte(4 * k + j + 1)} AS BIGINT) * {1 << (8 * j)}" for j in range(4))
    mask = 0xFFFFFFFF
    start = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
    x = ", ".join(f"x{k}" for k in range(16))
    parts = [f"m0 AS (SELECT DISTINCT {column} AS t, {', '.join(f'{word(k)} AS x{k}' for k in range(16))}, "
             + ", ".join(f"CAST({v} AS BIGINT) AS {n}" for n, v in zip("abcd", start)) + f" FROM {source} WHERE {column} IS NOT NULL)"]
    rounds = [([*range(16)], (3, 7, 11, 19), 0, "(b & c) | (xor(b, {m}) & d)"),
              ([4 * (i % 4) + i // 4 for i in range(16)], (3, 5, 9, 13), 0x5A827999, "(b & c) | (b & d) | (c & d)"),
              ([int(f"{i:04b}"[::-1], 2) for i in range(16)], (3, 9, 11, 15), 0x6ED9EBA1, "xor(xor(b, c), d)")]
    n = 0
    for order, shifts, add, mixed in rounds:
        for i in range(16):
            s = shifts[i % 4]
            parts.append(f"m{n + 1} AS (SELECT t, {x}, d AS a, ((v << {s}) & {mask}) | (v >> {32 - s}) AS b, b AS c, c AS d FROM "
                         f"(SELECT *, (a + ({mixed.format(m=mask)}) + x{order[i]} + {add}) & {mask} AS v FROM m{n}))")
            n += 1
    swap = lambda v: f"format('{{:08x}}', (({v} & 255) << 24) | (({v} & 65280) << 8) | (({v} >> 8) & 65280) | ({v} >> 24))"
    digest = " || ".join(swap(f"(({n_} + {v}) & {mask})") for n_, v in zip("abcd", start))
    return ",\n".join(parts) + f",\nmd4 AS (SELECT t, {digest} AS h FROM m{n})"


def transactions_df(spark, sf_dir, hash_algorithm="md5"):
    return CL.build_transactions(claims_v(spark, sf_dir), contracts_v(spark, sf_dir), EU,
                                 run_ts=RUN_TS, hash_algorithm=hash_algorithm)


@register("transactions", TRANSACTIONS_SQL)
def q_transactions(spark, sf_dir):
    """F1 flagship: claims ⟕ contracts → the 11 transaction columns (md5 id hash)."""
    return transactions_df(spark, sf_dir)


def _transactions_md4_sql() -> str:
    body = _transactions_sql("(SELECT h FROM md4 WHERE md4.t = c.CLAIM_ID)")
    return f"WITH claims_v AS ({CLAIMS_V_SQL}),\ncontracts_v AS ({CONTRACTS_V_SQL}),\n{_md4_sql('claims_v', 'CLAIM_ID')}\n{body}"


@register("transactions_md4", _transactions_md4_sql())
def q_transactions_md4(spark, sf_dir):
    """F1 with MD4 ids (Arrow-batched numpy MD4)."""
    return transactions_df(spark, sf_dir, hash_algorithm="md4")


@register("join_contracts", with_ctes("""
SELECT c.CLAIM_ID, c.CONTRACT_ID,
       CASE WHEN k.CONTRACT_ID IS NOT NULL THEN CAST(c.CONTRACT_ID AS BIGINT) END AS CONTRACT_SOURCE_SYSTEM_ID
FROM claims_v c LEFT JOIN contracts_v k
  ON c.CONTRACT_SOURCE_SYSTEM = k.SOURCE_SYSTEM AND c.CONTRACT_ID = k.CONTRACT_ID
""", **CLAIMS_CTES))
def q_join_contracts(spark, sf_dir):
    j = CL.join_contracts(claims_v(spark, sf_dir), contracts_v(spark, sf_dir))
    return j.select("CLAIM_ID", "CONTRACT_ID", "CONTRACT_SOURCE_SYSTEM_ID")


HOT_SQL = CLAIMS_V_SQL.replace("CAST(o_custkey AS VARCHAR) AS CONTRACT_ID", "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS VARCHAR) AS CONTRACT_ID")


@register("join_contracts_skewed", with_ctes("""
SELECT c.CLAIM_ID, c.CONTRACT_ID,
       CASE WHEN k.CONTRACT_ID IS NOT NULL THEN CAST(c.CONTRACT_ID AS BIGINT) END AS CONTRACT_SOURCE_SYSTEM_ID
FROM claims_v c LEFT JOIN contracts_v k
  ON c.CONTRACT_SOURCE_SYSTEM = k.SOURCE_SYSTEM AND c.CONTRACT_ID = k.CONTRACT_ID
""", claims_v=HOT_SQL, contracts_v=CONTRACTS_V_SQL))
def q_join_contracts_skewed(spark, sf_dir):
    """A third of the claims name one contract; its claims are spread over the join's tasks."""
    number = F.element_at(F.split("CLAIM_ID", "_"), -1).cast("long")
    claims = claims_v(spark, sf_dir).withColumn("CONTRACT_ID", F.when(number % 3 == 0, F.lit("7")).otherwise(F.col("CONTRACT_ID")))
    return CL.join_contracts_spread(claims, contracts_v(spark, sf_dir)).select("CLAIM_ID", "CONTRACT_ID", "CONTRACT_SOURCE_SYSTEM_ID")


@register("join_stats", with_ctes("""
SELECT count(*) FILTER (WHERE k.CONTRACT_ID IS NOT NULL) AS matched,
       count(*) FILTER (WHERE k.CONTRACT_ID IS NULL) AS unmatched
FROM claims_v c LEFT JOIN contracts_v k
  ON c.CONTRACT_SOURCE_SYSTEM = k.SOURCE_SYSTEM AND c.CONTRACT_ID = k.CONTRACT_ID
""", **CLAIMS_CTES))
def q_join_stats(spark, sf_dir):
    return CL.join_stats(CL.join_contracts(claims_v(spark, sf_dir), contracts_v(spark, sf_dir)))


def _claims_rule(name, spark_expr, sql_expr, inputs):
    cols_sql = "".join(f"c.{c}, " for c in inputs)

    @register(name, with_ctes(f"SELECT c.CLAIM_ID, {cols_sql}{sql_expr} AS {name.upper()} FROM claims_v c",
                              claims_v=CLAIMS_V_SQL))
    def _q(spark, sf_dir):
        return claims_v(spark, sf_dir).select("CLAIM_ID", *inputs, spark_expr().alias(name.upper()))
    _q.__name__ = f"q_{name}"
    return _q


_claims_rule("transaction_type",
             lambda: C.value_map("CLAIM_TYPE", R.TRANSACTION_TYPE_MAPPING, R.TRANSACTION_TYPE_DEFAULT),
             TYPE_SQL, ["CLAIM_TYPE"])
_claims_rule("transaction_direction",
             lambda: C.prefix_map("CLAIM_ID", R.TRANSACTION_DIRECTION_MAPPING), DIRECTION_SQL, [])
_claims_rule("source_system_id", lambda: C.trailing_int("CLAIM_ID"), SSID_SQL, [])
_claims_rule("conformed_value", lambda: C.to_decimal("AMOUNT"), CV_SQL, ["AMOUNT"])
_claims_rule("transaction_category", lambda: C.sign_category(C.to_decimal("AMOUNT")),
             f"CASE WHEN {CV_SQL} < 0 THEN 'REFUND' ELSE 'CHARGE' END", ["AMOUNT"])
_claims_rule("nse_id_md5", lambda: F.md5("CLAIM_ID"), "md5(c.CLAIM_ID)", [])


@register("parse_dates", with_ctes(f"""
SELECT c.CLAIM_ID, {BD_SQL} AS BUSINESS_DATE, {CD_SQL} AS CREATION_TS FROM claims_v c
""", claims_v=CLAIMS_V_SQL))
def q_parse_dates(spark, sf_dir):
    return claims_v(spark, sf_dir).select(
        "CLAIM_ID", C.parse_date("DATE_OF_LOSS", EU.date_format).alias("BUSINESS_DATE"),
        C.parse_timestamp("CREATION_DATE", EU.timestamp_format).alias("CREATION_TS"))


@register("dq_report", with_ctes(f"""
SELECT count(*) AS row_count,
       count(*) FILTER (WHERE NSE_ID IS NULL) AS null_NSE_ID,
       count(*) FILTER (WHERE CONFORMED_VALUE IS NULL) AS null_CONFORMED_VALUE,
       count(*) FILTER (WHERE TRANSACTION_TYPE IS NULL) AS null_TRANSACTION_TYPE,
       count(*) FILTER (WHERE TRY_CAST(CONFORMED_VALUE AS DOUBLE) < 0) AS negative_CONFORMED_VALUE,
       count(*) - (count(DISTINCT NSE_ID) + max(CASE WHEN NSE_ID IS NULL THEN 1 ELSE 0 END)) AS duplicate_NSE_ID
FROM tx
""", tx=TRANSACTIONS_SQL))
def q_dq_report(spark, sf_dir):
    """Q1–Q3 on the transactions output, one row."""
    return Q.dq_report(transactions_df(spark, sf_dir), ["NSE_ID", "CONFORMED_VALUE", "TRANSACTION_TYPE"],
                       amount_col="CONFORMED_VALUE", id_col="NSE_ID")


def _claims_expectations_sql() -> str:
    return with_ctes(f"""
SELECT s.row_count, s.not_null_CLAIM_ID, s.not_null_AMOUNT, s.regex_CLAIM_ID,
       COALESCE(u.unique_CLAIM_ID, 0) AS unique_CLAIM_ID
FROM (SELECT count(*) AS row_count,
             count(*) FILTER (WHERE CLAIM_ID IS NULL) AS not_null_CLAIM_ID,
             count(*) FILTER (WHERE AMOUNT IS NULL) AS not_null_AMOUNT,
             count(*) FILTER (WHERE CLAIM_ID IS NOT NULL AND NOT regexp_full_match(CLAIM_ID, '{R.CLAIM_ID_PATTERN.strip("^$")}')) AS regex_CLAIM_ID
      FROM claims_v) s,
     (SELECT CAST(sum(n) AS BIGINT) AS unique_CLAIM_ID
      FROM (SELECT CLAIM_ID, count(*) AS n FROM claims_v WHERE CLAIM_ID IS NOT NULL
            GROUP BY CLAIM_ID HAVING count(*) > 1)) u
""", **DIRTY_CTES)


@register("expectations", _claims_expectations_sql())
def q_expectations(spark, sf_dir):
    """Q5 claims-input suite as one row of unexpected counts, on claims with faults."""
    return Q.expectations_report(claims_dirty_v(spark, sf_dir), Q.CLAIMS_EXPECTATIONS)


@register("expectations_output", with_ctes(f"""
SELECT s.*, COALESCE(u.unique_NSE_ID, 0) AS unique_NSE_ID
FROM (SELECT count(*) AS row_count,
             count(*) FILTER (WHERE NSE_ID IS NULL) AS not_null_NSE_ID,
             count(*) FILTER (WHERE TRANSACTION_TYPE IS NOT NULL AND TRANSACTION_TYPE NOT IN {in_list(Q.TRANSACTIONS_EXPECTATIONS.in_set['TRANSACTION_TYPE'])}) AS in_set_TRANSACTION_TYPE,
             count(*) FILTER (WHERE TRANSACTION_DIRECTION IS NOT NULL AND TRANSACTION_DIRECTION NOT IN {in_list(Q.TRANSACTIONS_EXPECTATIONS.in_set['TRANSACTION_DIRECTION'])}) AS in_set_TRANSACTION_DIRECTION,
             count(*) FILTER (WHERE TRANSACTION_CATEGORY IS NOT NULL AND TRANSACTION_CATEGORY NOT IN {in_list(Q.TRANSACTIONS_EXPECTATIONS.in_set['TRANSACTION_CATEGORY'])}) AS in_set_TRANSACTION_CATEGORY
      FROM tx) s,
     (SELECT CAST(sum(n) AS BIGINT) AS unique_NSE_ID
      FROM (SELECT NSE_ID, count(*) AS n FROM tx WHERE NSE_ID IS NOT NULL GROUP BY NSE_ID HAVING count(*) > 1)) u
""", tx=DIRTY_TRANSACTIONS_SQL))
def q_expectations_output(spark, sf_dir):
    """Q5 transactions-output suite, on what the lenient rules make of claims with faults."""
    tx = CL.build_transactions(claims_dirty_v(spark, sf_dir), contracts_v(spark, sf_dir), EU, run_ts=RUN_TS, strict=False)
    return Q.expectations_report(tx, Q.TRANSACTIONS_EXPECTATIONS)


@register("gated_run", TRANSACTIONS_SQL)
def q_gated_run(spark, sf_dir):
    """Q6: input gate, write beside the target, output gate, promote; then what stands at the target."""
    out = scratch_path(spark, f"gated-run-{uuid.uuid4().hex}")
    CL.run_gated(spark, claims_v(spark, sf_dir), contracts_v(spark, sf_dir), EU, out, run_ts=RUN_TS)
    return spark.read.parquet(out)


@register("run_log", "SELECT 'Europe 3' AS region, 'success' AS status, count(*) AS rows_output, '{\"hash\": \"md5\"}' AS config_snapshot, CAST(NULL AS VARCHAR) AS error_message FROM orders")
def q_run_log(spark, sf_dir):
    """the appended run-log row of one write."""
    base = scratch_path(spark, f"run-log-{uuid.uuid4().hex}")
    CL.run_with_log(spark, transactions_df(spark, sf_dir), f"{base}/out", "Europe 3", {"hash": "md5"}, f"{base}/log")
    return spark.read.parquet(f"{base}/log").select("region", "status", "rows_output", "config_snapshot", "error_message")


@register("reject_rows", with_ctes(r"""
SELECT CLAIM_ID, reasons FROM (
  SELECT CLAIM_ID, list_filter([
      CASE WHEN CLAIM_ID IS NULL THEN 'claim_id_null' END,
      CASE WHEN CLAIM_ID IS NOT NULL AND NOT regexp_full_match(CLAIM_ID, '[A-Z]{2}_\d+') THEN 'claim_id_format' END,
      CASE WHEN TRY_CAST(NULLIF(regexp_extract(CLAIM_ID, '_(\d+)$', 1), '') AS BIGINT) > 2147483647 THEN 'claim_id_number_range' END,
      CASE WHEN AMOUNT IS NULL THEN 'amount_null' END,
      CASE WHEN AMOUNT IS NOT NULL AND TRY_CAST(AMOUNT AS DECIMAL(16,5)) IS NULL THEN 'amount_not_decimal' END,
      CASE WHEN DATE_OF_LOSS IS NOT NULL AND TRY_CAST(try_strptime(DATE_OF_LOSS, '%d.%m.%Y') AS DATE) IS NULL THEN 'date_of_loss_pattern' END,
      CASE WHEN CREATION_DATE IS NOT NULL AND try_strptime(CREATION_DATE, '%d.%m.%Y %H:%M') IS NULL THEN 'creation_date_pattern' END,
      CASE WHEN CLAIM_TYPE IS NULL OR CLAIM_TYPE NOT IN {TYPE_KEYS} THEN 'claim_type_unmapped' END
    ], lambda x: x IS NOT NULL) AS reasons
  FROM claims_v) WHERE len(reasons) > 0
""".replace("{TYPE_KEYS}", in_list(R.TRANSACTION_TYPE_MAPPING)), **DIRTY_CTES))
def q_reject_rows(spark, sf_dir):
    """Rejected claims with the list of failed checks; the claims carry every fault there is a check for."""
    _, rejected = Q.split_rejects(claims_dirty_v(spark, sf_dir), Q.claims_checks(EU.date_format, EU.timestamp_format))
    return rejected.select("CLAIM_ID", "reasons")
