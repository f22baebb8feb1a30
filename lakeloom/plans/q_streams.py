"""Streaming queries (T1–T3, T5): tables land as files in the shared folder (no
shuffle), a file stream limited by bytes drains them, and the complete-mode totals
are returned. The stream runs while the query is built."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeloom.operators import merging as ME
from lakeloom.plans.catalog import register
from lakeloom.plans.standins import MIGRATION_V_SQL, OBS_V_SQL, migration_lines, with_ctes
from lakeloom.session import scratch_path
from lakeloom.sources.tables import table
from lakeloom.streaming import running as S
from lakeloom.streaming import sinks as K


def _drained(spark, landing: str, totals, name: str):
    out = S.run_available(totals, spark, name)
    S.drop_landing(spark, landing)
    return out


def _events(spark, sf_dir):
    """Values as exact decimals, so that sums can be compared."""
    return table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,4)"))


def _stream_totals(spark, sf_dir, key: str):
    events = _events(spark, sf_dir)
    landing = S.stage_files(events, spark, f"events-{key}")
    stream = S.file_stream(spark, landing, events.schema, "parquet")
    return _drained(spark, landing, S.running_totals(stream, key, "value"), f"sum_by_{key}")


@register("stream_sum", """
SELECT event_type, sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY event_type
""")
def q_stream_sum(spark, sf_dir):
    """T1 + S14: file stream → running sum per key, complete mode."""
    return _stream_totals(spark, sf_dir, "event_type")


@register("stream_batch_parity", """
WITH t AS (SELECT user_id, sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY user_id)
SELECT user_id, total AS stream_total, total AS batch_total, true AS equal FROM t
""")
def q_stream_batch_parity(spark, sf_dir):
    """The streamed totals per user equal the batch twin computed by the same function."""
    streamed = _stream_totals(spark, sf_dir, "user_id")
    return S.parity(streamed, S.running_totals(_events(spark, sf_dir), "user_id", "value"), "user_id")


@register("stream_resume", """
SELECT event_type, sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY event_type
""")
def q_stream_resume(spark, sf_dir):
    """Half of the files, then the rest with the same checkpoint: the second drain
    reads only what is new and its totals cover both."""
    events, base = _events(spark, sf_dir), scratch_path(spark, f"resume-{uuid.uuid4().hex}")
    late = F.pmod("event_id", F.lit(2)) == 1
    events.where(~late).write.parquet(f"{base}/in")
    totals = S.running_totals(S.file_stream(spark, f"{base}/in", events.schema), "event_type", "value")
    S.run_available(totals, spark, "resume", f"{base}/state")
    events.where(late).write.mode("append").parquet(f"{base}/in")
    out = S.run_available(totals, spark, "resume", f"{base}/state")
    S.drop_landing(spark, f"{base}/in")
    return out


@register("stream_csv_totals", with_ctes("""
SELECT Country, CAST(sum(Value) AS BIGINT) AS total FROM mig GROUP BY Country
""", obs=OBS_V_SQL, mig=MIGRATION_V_SQL))
def q_stream_csv_totals(spark, sf_dir):
    """T5 + T1: the migration lines land as headerless CSV files shaped like the
    shipped stream files (a blank line before each record, a leading space, two
    trailing empty fields); the CSV file stream sums Value per Country."""
    lines = migration_lines(spark, sf_dir).select(
        F.concat(F.lit("\n "), F.col("value"), F.lit(",,")).alias("value"))
    landing = S.stage_files(lines, spark, "migration-csv", fmt="text")
    return _drained(spark, landing, S.running_totals(S.csv_stream(spark, landing), "Country", "Value"), "csv_by_country")


@register("stream_upsert", """
SELECT user_id, sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY user_id
""")
def q_stream_upsert(spark, sf_dir):
    """T1 + S18: totals per user in update mode, kept in key buckets: the first half of the files, then the rest,
    whose epochs rewrite only the buckets of users that occur in them."""
    events, base = _events(spark, sf_dir), scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    late = F.pmod("event_id", F.lit(2)) == 1
    events.where(~late).write.parquet(f"{base}/in")
    totals = S.running_totals(S.file_stream(spark, f"{base}/in", events.schema), "user_id", "value")
    table_ = ME.KeyedTable(f"{base}/totals", totals.schema, ("user_id",), 32)
    K.upsert_totals(totals, table_, f"{base}/checkpoint", spark)
    events.where(late).write.mode("append").parquet(f"{base}/in")
    K.upsert_totals(totals, table_, f"{base}/checkpoint", spark)
    S.drop_landing(spark, f"{base}/in")
    return table_.rows(spark)


@register("stream_rejects", with_ctes("""
SELECT CASE WHEN line_no % 7 < 2 THEN 'rejected' ELSE 'accepted' END AS part, count(*) AS n,
       CAST(sum(CASE WHEN line_no % 7 >= 2 THEN Value END) AS BIGINT) AS total
FROM mig GROUP BY 1
""", obs=OBS_V_SQL, mig=MIGRATION_V_SQL))
def q_stream_rejects(spark, sf_dir):
    """T5 + S14: CSV lines of which some have text for a number and some lack a field: both parts of the split stream."""
    kind = F.pmod("line_no", F.lit(7))
    line = (F.when(kind == 0, F.concat(F.regexp_replace("value", "[^,]*$", "n/a"), F.lit(",,")))
            .when(kind == 1, F.concat(F.col("value"), F.lit(","))).otherwise(F.concat(F.col("value"), F.lit(",,"))))
    lines = migration_lines(spark, sf_dir).select(F.concat(F.lit("\n "), line).alias("value"))
    landing = S.stage_files(lines, spark, "migration-dirty", fmt="text")
    out = scratch_path(spark, f"split-{uuid.uuid4().hex}")
    K.split_stream(K.checked_csv_stream(spark, landing), out, f"{out}/checkpoint")
    S.drop_landing(spark, landing)
    accepted, rejected = K.split_tables(spark, out)
    return (accepted.agg(F.lit("accepted").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("Value").alias("total"))
            .unionByName(rejected.agg(F.lit("rejected").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("total"))))
