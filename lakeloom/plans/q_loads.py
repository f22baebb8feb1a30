"""Multi-region and incremental loads, versioned lookups, enrichment once per
distinct id, file audit and snapshot freshness (F2, A21, J4–J6, F4, U4, S13, S17)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions import columns as C
from lakeloom.functions.hashing import hash_id
from lakeloom.operators import claims as CL
from lakeloom.operators import incremental as INC
from lakeloom.operators import merging as ME
from lakeloom.operators import states as ST
from lakeloom.plans.catalog import register
from lakeloom.plans.q_claims import (BD_SQL, CV_SQL, DIRECTION_SQL, RUN_TS, RUN_TS_SQL, SSID_SQL, TRANSACTIONS_SQL,
                                     TYPE_SQL, _md4_sql, transactions_df)
from lakeloom.plans.sqltext import values_table
from lakeloom.plans.standins import (CLAIMS_REGION_SQL, CLAIMS_V_SQL, CONTRACTS_V_SQL, claims_v, contracts_v,
                                     with_ctes)
from lakeloom.session import scratch_path, written
from lakeloom.sources import files as FS
from lakeloom.sources.tables import table

REGIONS = R.region_rules()
PAT = {"Europe 3": ("%d.%m.%Y", "%d.%m.%Y %H:%M"), "Asia Pacific 1": ("%Y-%m-%d", "%Y-%m-%d %H:%M"),
       "North America 2": ("%m/%d/%Y", "%m/%d/%Y %H:%M")}


def _region_case(i: int) -> str:
    return "CASE REGION " + " ".join(f"WHEN '{k}' THEN strptime(c.{'DATE_OF_LOSS' if i == 0 else 'CREATION_DATE'}, '{v[i]}')"
                                     for k, v in PAT.items()) + " END"


MULTI_SQL = with_ctes(f"""
SELECT c.REGION, c.REGION AS CONTRACT_SOURCE_SYSTEM,
       CASE WHEN k.CONTRACT_ID IS NOT NULL THEN TRY_CAST(c.CONTRACT_ID AS BIGINT) END AS CONTRACT_SOURCE_SYSTEM_ID,
       {SSID_SQL} AS SOURCE_SYSTEM_ID, {TYPE_SQL} AS TRANSACTION_TYPE, {DIRECTION_SQL} AS TRANSACTION_DIRECTION,
       {CV_SQL} AS CONFORMED_VALUE, CAST({_region_case(0)} AS DATE) AS BUSINESS_DATE, {_region_case(1)} AS CREATION_DATE,
       {RUN_TS_SQL} AS SYSTEM_TIMESTAMP, md5(c.CLAIM_ID) AS NSE_ID,
       CASE WHEN {CV_SQL} < 0 THEN 'REFUND' ELSE 'CHARGE' END AS TRANSACTION_CATEGORY
FROM claims_r c LEFT JOIN contracts_v k ON c.CONTRACT_SOURCE_SYSTEM = k.SOURCE_SYSTEM AND c.CONTRACT_ID = k.CONTRACT_ID
""", claims_r=CLAIMS_REGION_SQL, contracts_v=CONTRACTS_V_SQL)


def multi_region_df(spark, sf_dir):
    return CL.build_multi_region(claims_v(spark, sf_dir, per_region_formats=True), contracts_v(spark, sf_dir),
                                 REGIONS, run_ts=RUN_TS)


@register("multi_region", MULTI_SQL)
def q_multi_region(spark, sf_dir):
    """three regions with their own date patterns and labels in one job."""
    return multi_region_df(spark, sf_dir)


@register("global_transactions", with_ctes("""
SELECT REGION, TRANSACTION_TYPE, TRANSACTION_CATEGORY, count(*) AS n_transactions,
       CAST(sum(CONFORMED_VALUE) AS DECIMAL(38,5)) AS total_value
FROM m GROUP BY ALL
""", m=MULTI_SQL))
def q_global_transactions(spark, sf_dir):
    """Cross-region aggregate (count and value by region × type × category)."""
    return CL.global_aggregate(multi_region_df(spark, sf_dir))


CUTOFF = _dt.date(1999, 1, 1)
KEY_SQL = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in INC.TX_KEY)


@register("incremental_new", with_ctes(f"""
SELECT s.*, 'batch-2' AS BATCH_ID FROM tx s
WHERE NOT EXISTS (SELECT 1 FROM tx t WHERE t.BUSINESS_DATE < DATE '1999-01-01' AND {KEY_SQL})
""", tx=TRANSACTIONS_SQL))
def q_incremental_new(spark, sf_dir):
    """J4 + F4: a re-delivered full batch against the table loaded before 1999:
    only genuinely new rows, stamped with the batch id (NULL-safe key)."""
    tx = transactions_df(spark, sf_dir)
    target = tx.where(F.col("BUSINESS_DATE") < F.lit(CUTOFF))
    return INC.new_rows(target, tx).withColumn("BATCH_ID", F.lit("batch-2"))


UPSERT_COLS = ["CONTRACT_SOURCE_SYSTEM", "CONTRACT_SOURCE_SYSTEM_ID", "NSE_ID", "TRANSACTION_TYPE", "CONFORMED_VALUE"]


@register("upsert_merge", with_ctes(f"""
SELECT {', '.join(f"CASE WHEN s.NSE_ID IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in UPSERT_COLS)},
       CASE WHEN s.NSE_ID IS NULL THEN 'keep' WHEN t.NSE_ID IS NULL THEN 'insert'
            WHEN t.TRANSACTION_TYPE IS DISTINCT FROM s.TRANSACTION_TYPE OR t.CONFORMED_VALUE IS DISTINCT FROM s.CONFORMED_VALUE
            THEN 'update' ELSE 'unchanged' END AS merge_action
FROM (SELECT {', '.join(UPSERT_COLS)} FROM tx WHERE BUSINESS_DATE < DATE '2000-01-01') t
FULL OUTER JOIN (SELECT {', '.join(c for c in UPSERT_COLS if c != 'TRANSACTION_TYPE')},
                        CASE WHEN TRANSACTION_TYPE = 'Unknown' THEN 'Unmapped' ELSE TRANSACTION_TYPE END AS TRANSACTION_TYPE
                 FROM tx WHERE BUSINESS_DATE >= DATE '1998-01-01') s ON {KEY_SQL}
""", tx=TRANSACTIONS_SQL))
def q_upsert_merge(spark, sf_dir):
    """The table loaded up to 1999 merged with a staged batch from 1998 on whose
    default type label changed: inserts, updates, unchanged and kept rows."""
    tx = transactions_df(spark, sf_dir)
    target = tx.where(F.col("BUSINESS_DATE") < F.lit(_dt.date(2000, 1, 1))).select(*UPSERT_COLS)
    staged = (tx.where(F.col("BUSINESS_DATE") >= F.lit(_dt.date(1998, 1, 1)))
              .withColumn("TRANSACTION_TYPE", F.when(F.col("TRANSACTION_TYPE") == "Unknown", F.lit("Unmapped"))
                          .otherwise(F.col("TRANSACTION_TYPE"))).select(*UPSERT_COLS))
    return INC.upsert(target, staged)


@register("merge_buckets", with_ctes(f"""
SELECT {', '.join(f"CASE WHEN s.NSE_ID IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in UPSERT_COLS)}
FROM (SELECT {', '.join(UPSERT_COLS)} FROM tx WHERE BUSINESS_DATE < DATE '2001-01-01') t
FULL OUTER JOIN (SELECT {', '.join(c for c in UPSERT_COLS if c != 'TRANSACTION_TYPE')},
                        CASE WHEN TRANSACTION_TYPE = 'Unknown' THEN 'Unmapped' ELSE TRANSACTION_TYPE END AS TRANSACTION_TYPE
                 FROM tx WHERE BUSINESS_DATE >= DATE '2000-12-01') s ON {KEY_SQL}
""", tx=TRANSACTIONS_SQL))
def q_merge_buckets(spark, sf_dir):
    """J5 + J4: the table up to 2000 in key buckets, then the batch from December 2000 on (changed,
    unchanged and new rows) merged into the buckets that it changes; the table read back."""
    tx = transactions_df(spark, sf_dir)
    old = tx.where(F.col("BUSINESS_DATE") < F.lit(_dt.date(2001, 1, 1))).select(*UPSERT_COLS)
    batch = (tx.where(F.col("BUSINESS_DATE") >= F.lit(_dt.date(2000, 12, 1)))
             .withColumn("TRANSACTION_TYPE", F.when(F.col("TRANSACTION_TYPE") == "Unknown", F.lit("Unmapped"))
                         .otherwise(F.col("TRANSACTION_TYPE"))).select(*UPSERT_COLS))
    target = ME.KeyedTable(scratch_path(spark, f"merge-{uuid.uuid4().hex}"), old.schema, INC.TX_KEY, 64)
    target.write(old)
    ME.merge(target, batch)
    return target.rows(spark)


def lookup_rows():
    """A versioned type lookup from the rule table: every code valid 1990–1998;
    from 1999 a second label version (open-ended) except code 3, whose new
    version is inactive (so the file default applies)."""
    rows = []
    for code, label in R.TRANSACTION_TYPE_MAPPING.items():
        rows.append(("Europe 3", code, label, _dt.date(1990, 1, 1), _dt.date(1998, 12, 31), True))
        rows.append(("Europe 3", code, f"{label} (2)", _dt.date(1999, 1, 1), None, code != "3"))
    return rows


LOOKUP_COLS = ["source_system", "claim_type_code", "label", "effective_from", "effective_to", "active"]


@register("lookup_effective", with_ctes(f"""
SELECT c.CLAIM_ID, {BD_SQL} AS BUSINESS_DATE, COALESCE(l.label, {TYPE_SQL}) AS TRANSACTION_TYPE
FROM claims_v c LEFT JOIN lk l
  ON l.source_system = 'Europe 3' AND l.claim_type_code = c.CLAIM_TYPE AND l.active
 AND l.effective_from <= {BD_SQL} AND (l.effective_to IS NULL OR l.effective_to >= {BD_SQL})
""", claims_v=CLAIMS_V_SQL,
    lk="SELECT source_system, claim_type_code, label, CAST(effective_from AS DATE) AS effective_from, "
       "CAST(effective_to AS DATE) AS effective_to, active FROM " + values_table(
           [(a, b, c, d.isoformat(), e.isoformat() if e else None, f) for a, b, c, d, e, f in lookup_rows()],
           LOOKUP_COLS, "v")))
def q_lookup_effective(spark, sf_dir):
    """Claim type label valid at the loss date from a versioned lookup
    (DB value wins over the file mapping; inactive or missing → file mapping)."""
    c = claims_v(spark, sf_dir).select(
        "CLAIM_ID", "CLAIM_TYPE", C.parse_date("DATE_OF_LOSS", "dd.MM.yyyy").alias("BUSINESS_DATE"),
        F.lit("Europe 3").alias("SOURCE_SYSTEM_KEY"))
    lk = spark.createDataFrame(lookup_rows(), "source_system string, claim_type_code string, label string, "
                                              "effective_from date, effective_to date, active boolean")
    default = C.value_map("CLAIM_TYPE", R.TRANSACTION_TYPE_MAPPING, R.TRANSACTION_TYPE_DEFAULT)
    out = INC.lookup_effective(c, lk, ["SOURCE_SYSTEM_KEY", "CLAIM_TYPE"], ["source_system", "claim_type_code"],
                               "BUSINESS_DATE", "label", "TRANSACTION_TYPE", default)
    return out.select("CLAIM_ID", "BUSINESS_DATE", "TRANSACTION_TYPE")


VERSION_DAYS = 3


@register("lookup_intervals", with_ctes(f"""
SELECT c.CLAIM_ID, {BD_SQL} AS BUSINESS_DATE, CASE WHEN c.CLAIM_TYPE IS NULL THEN 'none'
  ELSE c.CLAIM_TYPE || '-' || CAST(CAST(floor(date_diff('day', DATE '1995-01-01', {BD_SQL}) / {VERSION_DAYS}.0) AS BIGINT) AS VARCHAR) END AS LABEL
FROM claims_v c
""", claims_v=CLAIMS_V_SQL))
def q_lookup_intervals(spark, sf_dir):
    """Claim types with a version of the label every three days (thousands of versions a type, derived from the claims' own dates)."""
    c = claims_v(spark, sf_dir).select("CLAIM_ID", "CLAIM_TYPE", C.parse_date("DATE_OF_LOSS", "dd.MM.yyyy").alias("BUSINESS_DATE"))
    start = F.lit(_dt.date(1995, 1, 1))
    turn = F.floor(F.date_diff("BUSINESS_DATE", start) / VERSION_DAYS)
    begin = F.date_add(start, (turn * VERSION_DAYS).cast("int"))
    lookup = (c.where("CLAIM_TYPE is not null").select("CLAIM_TYPE", turn.alias("turn"), begin.alias("effective_from")).distinct()
              .select(F.col("CLAIM_TYPE").alias("code"), F.concat_ws("-", "CLAIM_TYPE", "turn").alias("label"), "effective_from",
                      F.date_add("effective_from", VERSION_DAYS - 1).alias("effective_to"), F.lit(True).alias("active")))
    out = INC.lookup_intervals(c, lookup, ["CLAIM_TYPE"], ["code"], "BUSINESS_DATE", "label", "LABEL", F.lit("none"))
    return out.select("CLAIM_ID", "BUSINESS_DATE", "LABEL")


DELIVERIES_SQL = """SELECT year(BUSINESS_DATE) AS y, tx.* FROM tx
UNION ALL SELECT year(BUSINESS_DATE) + 1, tx.* FROM tx WHERE month(BUSINESS_DATE) = 12 AND year(BUSINESS_DATE) < 2001"""


@register("dq_incremental", with_ctes("""
SELECT count(*) AS row_count, count(*) FILTER (WHERE NSE_ID IS NULL) AS null_NSE_ID,
       count(*) FILTER (WHERE TRANSACTION_TYPE IS NULL) AS null_TRANSACTION_TYPE,
       count(*) FILTER (WHERE CONFORMED_VALUE < 0) AS negative_CONFORMED_VALUE,
       count(*) - (count(DISTINCT NSE_ID) + max(CASE WHEN NSE_ID IS NULL THEN 1 ELSE 0 END)) AS duplicate_NSE_ID
FROM deliveries
""", tx=TRANSACTIONS_SQL, deliveries=DELIVERIES_SQL))
def q_dq_incremental(spark, sf_dir):
    """Q1–Q3: a delivery a year, each with last December's rows once more; the report from the merged states of the deliveries."""
    tx = written(transactions_df(spark, sf_dir).select("NSE_ID", "TRANSACTION_TYPE", "CONFORMED_VALUE", "BUSINESS_DATE"), "deliveries")
    table_ = ST.CheckedTable(scratch_path(spark, f"dq-{uuid.uuid4().hex}"), tx.schema, ("NSE_ID", "TRANSACTION_TYPE"), "NSE_ID", "CONFORMED_VALUE")
    year = F.year("BUSINESS_DATE")
    years = sorted(r[0] for r in tx.select(year).distinct().collect())  # bounded by the calendar
    for part, y in enumerate(years):
        table_.add(spark, tx.where((year == y) | ((year == y - 1) & (F.month("BUSINESS_DATE") == 12))), part)
    return table_.report(spark)


@register("distinct_enrich", "WITH claims_v AS (" + CLAIMS_V_SQL + "),\n" + _md4_sql("claims_v", "CONTRACT_ID") + """
SELECT CLAIM_ID, CONTRACT_ID, (SELECT h FROM md4 WHERE t = CONTRACT_ID) AS contract_hash FROM claims_v""")
def q_distinct_enrich(spark, sf_dir):
    """U4: a costly per-id function (MD4 in Python) runs once per distinct id, then joins
    back (the id table is shuffled by id like the claims; no call per row)."""
    c = claims_v(spark, sf_dir).select("CLAIM_ID", "CONTRACT_ID")
    ids = c.select("CONTRACT_ID").distinct().withColumn("contract_hash", hash_id(F.col("CONTRACT_ID"), "md4"))
    return c.join(ids, "CONTRACT_ID", "left").select("CLAIM_ID", "CONTRACT_ID", "contract_hash")


@register("file_audit", """
SELECT regexp_extract(filename, '([^/]+)$', 1) AS file_name, size AS size_bytes, md5(content) AS md5,
       sha256(content) AS sha256
FROM read_blob('/root/testdata/sf0.01/*.parquet')
""")
def q_file_audit(spark, sf_dir):
    """Size and MD5 / SHA-256 digests of every table file of the scale factor."""
    return FS.file_audit(spark, f"{sf_dir.rstrip('/')}/*.parquet").select("file_name", "size_bytes", "md5", "sha256")


NOW = _dt.datetime(2024, 1, 30, 12, 0, 0)
SRC_SQL = ("CASE event_type WHEN 'click' THEN 'OECD_MIG' WHEN 'view' THEN 'EUROSTAT' "
           "WHEN 'error' THEN 'IRCC' ELSE 'OTHER' END")


@register("fresh_snapshots", with_ctes(f"""
SELECT source, user_id, fetched_at, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, user_id ORDER BY fetched_at DESC, event_id DESC) AS rn FROM m
  WHERE (epoch_us(TIMESTAMP '{NOW.isoformat(sep=' ')}') - epoch_us(fetched_at)) / 3600000000.0
        <= CASE source WHEN 'OECD_MIG' THEN 24 WHEN 'EUROSTAT' THEN 12 WHEN 'IRCC' THEN 168 ELSE 24 END)
WHERE rn = 1
""", m=f"SELECT {SRC_SQL} AS source, user_id, ts AS fetched_at, event_id FROM events"))
def q_fresh_snapshots(spark, sf_dir):
    """Events read as a fetch manifest; per (source, key) the latest snapshot
    still within its source's TTL at a fixed 'now'."""
    e = table(spark, sf_dir, "events")
    src = (F.when(F.col("event_type") == "click", F.lit("OECD_MIG")).when(F.col("event_type") == "view", F.lit("EUROSTAT"))
           .when(F.col("event_type") == "error", F.lit("IRCC")).otherwise(F.lit("OTHER")))
    m = e.select(src.alias("source"), "user_id", F.col("ts").cast("timestamp").alias("fetched_at"), "event_id")
    return FS.fresh_snapshots(m, NOW, key=("source", "user_id"), source_col="source").select(
        "source", "user_id", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), "event_id")
