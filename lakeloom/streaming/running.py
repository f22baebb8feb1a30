"""File-stream running totals (T1–T5) with Structured Streaming.

* Source: ``readStream`` with a declared schema and ``maxBytesPerTrigger`` (or
  ``maxFilesPerTrigger``).
* Operator: ``groupBy(key).agg(sum)`` — state grows with distinct keys only.
* Sink: complete-mode output, one folder an epoch. A reader takes the newest
  finished one, so a crash in between leaves the last result standing, and a
  replayed epoch rewrites its own folder. With the same base folder a second
  call resumes from the checkpoint.
* ``availableNow`` drains what is there and stops — bounded runs and tests.

The memory / console sinks of the reference are kept for interactive use
(``sink="memory"``) but the memory sink lives in driver memory, so it is not
the default.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.session import scratch_path

TRIGGER_BYTES = 1 << 30

# Positional columns of the migration stream files (13 fields, no header).
STREAM_CSV_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ["CO2", "Country_Nationality", "VAR", "Variable", "GEN", "Gender", "COU", "Country", "YEA", "Year"]]
    + [T.StructField("Value", T.LongType()), T.StructField("Flag_Codes", T.StringType()),
       T.StructField("Flags", T.StringType())])


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, max_bytes_per_trigger: int = TRIGGER_BYTES, **options) -> DataFrame:
    """A file-source stream with a declared schema (no inference from a sample),
    limited by bytes a micro-batch unless a number of files is given."""
    r = spark.readStream.schema(schema).format(fmt)
    r = (r.option("maxBytesPerTrigger", max_bytes_per_trigger) if max_files_per_trigger is None
         else r.option("maxFilesPerTrigger", max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def csv_stream(spark: SparkSession, path: str, schema: T.StructType = STREAM_CSV_SCHEMA,
               max_files_per_trigger: int | None = None, max_bytes_per_trigger: int = TRIGGER_BYTES) -> DataFrame:
    """T5: headerless files with a blank first line and leading spaces. With
    ``header=false`` + ``ignoreLeadingWhiteSpace`` the blank line is skipped and
    the data row survives (a header option would eat it)."""
    return file_stream(spark, path, schema, "csv", max_files_per_trigger, max_bytes_per_trigger, header="false",
                       ignoreLeadingWhiteSpace="true", mode="PERMISSIVE")


def running_totals(df: DataFrame, key: str | Sequence[str], value: str, name: str = "total") -> DataFrame:
    """Sum of ``value`` per key — the same function serves stream and batch."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def start_to_table(agg: DataFrame, out_path: str, checkpoint: str, query_name: str,
                   available_now: bool = True, sink: str = "parquet") -> StreamingQuery:
    """T1 sink + T4 control: start the complete-mode query; returns the handle."""
    w = agg.writeStream.outputMode("complete").queryName(query_name).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if sink == "memory":
        return w.format("memory").start()
    if sink == "console":
        return w.format("console").start()

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch-{epoch_id:012d}")
        for old in _epochs(batch.sparkSession, out_path)[:-2]:
            _delete(batch.sparkSession, old)
    return w.foreachBatch(write_epoch).start()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _epochs(spark: SparkSession, out_path: str) -> list[str]:
    """Folders of finished epochs, oldest first; no more than a few, as old ones go."""
    fs, p = _fs(spark, out_path)
    if not fs.exists(p):
        return []
    found = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("epoch-")]
    done = [str(f) for f in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(done)


def latest(spark: SparkSession, out_path: str, schema: T.StructType) -> DataFrame:
    """The newest finished epoch's table; empty before the first."""
    epochs = _epochs(spark, out_path)
    return spark.read.schema(schema).parquet(epochs[-1]) if epochs else spark.createDataFrame([], schema)


def run_available(agg: DataFrame, spark: SparkSession, name: str, base: str | None = None, timeout_s: int | None = None) -> DataFrame:
    """Drain the stream once (``availableNow``) and return its totals as a batch
    DataFrame. Output and checkpoint stand in ``base``: a second call with it reads
    only files that are new. Without one they go to a new folder below the shared
    checkpoint folder. There is no time limit unless one is given."""
    base = base or scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex}")
    q = start_to_table(agg, f"{base}/out", f"{base}/checkpoint", f"{name}_{uuid.uuid4().hex[:8]}")
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination(), True)[1]
        if not finished:
            raise TimeoutError(f"stream {name} did not drain within {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()
    return latest(spark, f"{base}/out", agg.schema)


def stage_files(df: DataFrame, spark: SparkSession, name: str, fmt: str = "parquet") -> str:
    """Write a table into a stream's landing folder without a shuffle, one file a
    partition, so files are as large as the table's own splits. Returns the folder."""
    path = scratch_path(spark, f"landing-{name}-{uuid.uuid4().hex}")
    df.write.format(fmt).save(path)
    return path


def drop_landing(spark: SparkSession, path: str) -> None:
    """A landing folder of ``stage_files``, once its stream is drained."""
    _delete(spark, path)


def parity(stream_result: DataFrame, batch_result: DataFrame, key: str | Sequence[str],
           name: str = "total") -> DataFrame:
    """Stream totals beside batch totals with an equality flag (full outer join)."""
    keys = [key] if isinstance(key, str) else list(key)
    s = stream_result.withColumnRenamed(name, "stream_total")
    b = batch_result.withColumnRenamed(name, "batch_total")
    j = s.join(b, keys, "full_outer")
    return j.withColumn("equal", F.col("stream_total").eqNullSafe(F.col("batch_total")))
