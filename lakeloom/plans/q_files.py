"""Round trips through files (S1–S3, S6–S8, S11, S15, S16, W9, M7, Q4): tables are
written to the shared folder by Spark and read back by the readers under test, so
building these queries runs the write."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.operators import messages as M
from lakeloom.operators import normalise as N
from lakeloom.operators import quality as Q
from lakeloom.plans import q_messages as MQ
from lakeloom.plans.catalog import register
from lakeloom.plans.fin_job import numbered_messages, run_fin_batch
from lakeloom.plans.q_normalise import CSV_SELECT, FETCH_TS, SUMT, _out
from lakeloom.plans.standins import CLAIMS_V_SQL, MIGRATION_V_SQL, OBS_V_SQL, claims_v, migration_lines, obs_v, with_ctes
from lakeloom.session import scratch_path
from lakeloom.sources import files as FS
from lakeloom.sources import text as TXT
from lakeloom.sources.tables import table


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("claims_csv", with_ctes(f"SELECT {', '.join(R.CLAIMS_COLUMNS)} FROM claims_v", claims_v=CLAIMS_V_SQL))
def q_claims_csv(spark, sf_dir):
    """S1 + S15: claims written as a folder of CSV files (``;``) and read with the declared schema."""
    path = _folder(spark, "claims-csv")
    FS.write_csv(claims_v(spark, sf_dir).select(*R.CLAIMS_COLUMNS), path, sep=";")
    return FS.read_claims(spark, path, sep=";")


@register("claims_csv_regions", "SELECT o_orderkey % 3 AS region, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def q_claims_csv_regions(spark, sf_dir):
    """S2 + S15: one folder a region, types inferred on reading, summed per folder."""
    path = _folder(spark, "claims-regions")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(3)).alias("region"))
    FS.write_csv(o, path, partition_by=["region"])
    back = FS.read_csv(spark, path, infer_schema=True)
    return back.groupBy(F.col("region").cast("long").alias("region")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@register("json_lines", "SELECT event_id, event_type, user_id FROM events")
def q_json_lines(spark, sf_dir):
    """S3: events as JSON lines and back."""
    path = _folder(spark, "events-json")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    e.write.json(path)
    return FS.read_json(spark, path, e.schema)


@register("migration_csv", with_ctes(f"SELECT {CSV_SELECT} FROM obs", obs=OBS_V_SQL))
def q_migration_csv(spark, sf_dir):
    """S6 + N1: headerless migration files read by the declared schema, then normalised."""
    path = _folder(spark, "migration")
    migration_lines(spark, sf_dir).select("value").write.text(path)
    return _out(N.norm_csv(FS.read_migration_csv(spark, path), fetch_ts=FETCH_TS))


CANON_TEXT = ["counterpart", "obs_value", "ref_area", "time_period", "sex", "year"]


@register("canonical_csv", with_ctes(f"""
SELECT ref_area, counterpart, time_period, sex, year, CAST(obs_value AS {SUMT}) AS obs_value, 'FALLBACK_CSV' AS source_dataset FROM obs""", obs=OBS_V_SQL))
def q_canonical_csv(spark, sf_dir):
    """Canonical files with a header, columns in another order and some missing."""
    path = _folder(spark, "canonical")
    FS.write_csv(obs_v(spark, sf_dir).select(*CANON_TEXT), path)
    back = FS.read_canonical_csv(spark, path, fetch_ts=FETCH_TS)
    return back.select("ref_area", "counterpart", "time_period", "sex", "year", F.col("obs_value").cast(SUMT).alias("obs_value"), "source_dataset")


@register("discover_files", """
SELECT file_src, file_country, count(*) AS n FROM (
  VALUES ('oecd', 'italy'), ('un', 'canada'), ('un', 'peru')) t(file_src, file_country)
  JOIN orders ON CASE WHEN file_src = 'oecd' THEN o_orderkey % 2 = 0 WHEN file_country = 'canada' THEN o_orderkey % 2 = 1 ELSE true END
GROUP BY ALL
""")
def q_discover_files(spark, sf_dir):
    """Files of two layouts found by name and read by their source, rows counted per file."""
    base = _folder(spark, "discover")
    o = obs_v(spark, sf_dir)
    lines = migration_lines(spark, sf_dir)
    lines.where(F.pmod("line_no", F.lit(2)) == 0).select("value").write.text(f"{base}/oecd_italy.csv")
    FS.write_csv(o.where(F.pmod("row_id", F.lit(2)) == 1).select(*CANON_TEXT), f"{base}/un_canada.csv")
    FS.write_csv(o.select(*reversed(CANON_TEXT)), f"{base}/un_peru.csv")
    out = None
    for src, country in (("oecd", "italy"), ("un", "canada"), ("un", "peru")):
        rows = FS.load_fallback(spark, base, src, country, FETCH_TS).agg(
            F.lit(src).alias("file_src"), F.lit(country).alias("file_country"), F.count(F.lit(1)).alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _fin_files(spark, sf_dir) -> str:
    """All batches as FIN text files, junk ahead of the messages of each file."""
    path = _folder(spark, "fin")
    MQ.fin_batches(spark, sf_dir).select(F.col("text").alias("value")).write.text(path)
    return path


@register("fin_file_batch", MQ._fin("SELECT ref, count(*) AS n FROM fin GROUP BY ref"))
def q_fin_file_batch(spark, sf_dir):
    """FIN files → messages, by reference."""
    parsed = M.parse_mt103(M.read_fin_batch(spark, _fin_files(spark, sf_dir)))
    return M.typed(parsed.withColumn("message_id", F.lit(0))).groupBy("ref").agg(F.count(F.lit(1)).alias("n"))


@register("fin_numbering", "SELECT count(*) AS messages, count(*) AS numbers FROM orders")
def q_fin_numbering(spark, sf_dir):
    """In every file the numbers run from 1 to its message count, without gap or repeat."""
    n = numbered_messages(spark, _fin_files(spark, sf_dir))
    per_file = n.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("message_id").alias("d"), F.min("message_id").alias("lo"),
                                     F.max("message_id").alias("hi"))
    return per_file.agg(F.sum("n").alias("messages"), F.sum(F.when((F.col("lo") == 1) & (F.col("hi") == F.col("d")), F.col("d"))).alias("numbers"))


@register("fin_job", MQ._fin("SELECT ref, CASE WHEN has_b3 THEN 1 ELSE 0 END AS has_block_3 FROM fin"))
def q_fin_job(spark, sf_dir):
    """M7: the batch job; its typed table read back."""
    out = run_fin_batch(spark, _fin_files(spark, sf_dir), _folder(spark, "fin-out"))
    typed = spark.read.option("header", "true").option("multiLine", "true").csv(out["typed"])
    return typed.select("ref", F.col("block_3").isNotNull().cast("int").alias("has_block_3"))


@register("snapshot_manifest", """
SELECT 'ORDERS' AS fetcher, '{"year": ' || year(o_orderdate) || '}' AS params, count(*) AS row_count FROM orders GROUP BY 1, 2
""")
def q_snapshot_manifest(spark, sf_dir):
    """A snapshot of every year in one write, and the manifest rows that count them."""
    base = _folder(spark, "snapshots")
    FS.write_snapshots(table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), base, "ORDERS", "year", FETCH_TS)
    return spark.read.parquet(f"{base}/manifest").select("fetcher", "params", "row_count")


FILE_ROWS = 2000


@register("csv_region_files", """
SELECT region, count(*) AS n, true AS none_above_limit, true AS no_more_than_asked FROM (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 7 END AS region FROM orders) GROUP BY 1
""")
def q_csv_region_files(spark, sf_dir):
    """A folder a region, of which one holds a third of all rows: files of at most FILE_ROWS rows,
    and per folder no more than twice those its rows ask for."""
    path = _folder(spark, "claims-bounded")
    key = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(key, F.when(key % 3 == 0, F.lit(0)).otherwise(key % 7).cast("long").alias("region"))
    FS.write_csv(o, path, partition_by=["region"], max_records=FILE_ROWS)
    files = FS.read_csv(spark, path).groupBy("region", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(F.col("region").cast("long").alias("region")).agg(
        F.sum("n").alias("n"), (F.max("n") <= FILE_ROWS).alias("none_above_limit"),
        (F.count(F.lit(1)) <= 2 * F.ceil(F.sum("n") / FILE_ROWS)).alias("no_more_than_asked"))


@register("schema_check", """
SELECT 'claims' AS name, '' AS missing, count(*) AS n FROM orders UNION ALL SELECT 'orders', 'AMOUNT,CLAIM_ID', count(*) FROM orders
""")
def q_schema_check(spark, sf_dir):
    """Q4: columns that a suite asks for and a table lacks (known from the plan), beside the rows that would be checked."""
    suite = Q.Expectations(columns=("CLAIM_ID", "AMOUNT"))
    frames = {"claims": claims_v(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(",".join(sorted(Q.missing_columns(df, suite)))).alias("missing"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@register("read_lines", with_ctes("SELECT Country, Year, count(*) AS n, CAST(sum(Value) AS BIGINT) AS total FROM mig GROUP BY ALL", obs=OBS_V_SQL, mig=MIGRATION_V_SQL))
def q_read_lines(spark, sf_dir):
    """S4 + S5: text files read line by line, fields by position, summed."""
    path = _folder(spark, "lines")
    migration_lines(spark, sf_dir).select("value").write.text(path)
    rows = TXT.parse_positional(TXT.read_lines(spark, path), casts={"Year": "int", "Value": "long"}, strict=True)
    return rows.groupBy("Country", "Year").agg(F.count(F.lit(1)).alias("n"), F.sum("Value").alias("total"))
