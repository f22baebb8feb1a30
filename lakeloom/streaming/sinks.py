"""Stream sinks that write what changed (T1, S18) and what was refused.

* ``upsert_totals``: running totals in update mode. An epoch brings the keys whose
  total changed, and ``merging.merge`` rewrites the key buckets that hold them. A
  replayed epoch finds its totals in place and writes nothing.
* ``split_stream``: rows of a declared CSV layout and the lines that don't fit it,
  told apart by the reader's corrupt-record column, go to two tables from one
  pass over each micro-batch. Each epoch has its own folders, which a replay
  overwrites, so both tables hold every line once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators import merging as ME
from lakeloom.streaming.running import STREAM_CSV_SCHEMA, file_stream

CORRUPT = "_corrupt_record"


def _drained(query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    finally:
        if query.isActive:
            query.stop()


def merge_epoch(table: ME.KeyedTable, batch: DataFrame) -> None:
    """One epoch's changed totals into the table."""
    ME.merge(table, batch)


def upsert_totals(totals: DataFrame, table: ME.KeyedTable, checkpoint: str, spark: SparkSession, drain: bool = True) -> StreamingQuery:
    """T1 + S18: streaming totals (one row a key) kept in a keyed table; with ``drain`` until all files are read."""
    table.create(spark)
    query = (totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(**({"availableNow": True} if drain else {"processingTime": "10 seconds"}))
             .foreachBatch(lambda batch, epoch: merge_epoch(table, batch)).start())
    if drain:
        _drained(query)
    return query


def checked_csv_stream(spark: SparkSession, path: str, schema: T.StructType = STREAM_CSV_SCHEMA, **options) -> DataFrame:
    """T5 + S14: the CSV stream with ``_corrupt_record``: the line as it stands if a field is missing, too many, or of another type."""
    checked = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    return file_stream(spark, path, checked, "csv", header="false", ignoreLeadingWhiteSpace="true", mode="PERMISSIVE",
                       columnNameOfCorruptRecord=CORRUPT, **options)


def write_split(batch: DataFrame, epoch: int, out: str) -> None:
    """One epoch's rows and rejects, each into its own folder of this epoch."""
    batch = batch.persist()  # read and parsed once for both
    try:
        bad = F.col(CORRUPT).isNotNull()
        batch.where(~bad).drop(CORRUPT).write.mode("overwrite").parquet(f"{out}/accepted/_epoch={epoch}")
        batch.where(bad).select(F.col(CORRUPT).alias("line")).write.mode("overwrite").parquet(f"{out}/rejected/_epoch={epoch}")
    finally:
        batch.unpersist()


def split_stream(rows: DataFrame, out: str, checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Rows of ``checked_csv_stream`` into ``out``/accepted and ``out``/rejected."""
    query = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(**({"availableNow": True} if drain else {"processingTime": "10 seconds"}))
             .foreachBatch(lambda batch, epoch: write_split(batch, epoch, out)).start())
    if drain:
        _drained(query)
    return query


def split_tables(spark: SparkSession, out: str, schema: T.StructType = STREAM_CSV_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected lines) of all epochs."""
    return (spark.read.schema(schema).parquet(f"{out}/accepted").drop("_epoch"),
            spark.read.schema("line string").parquet(f"{out}/rejected").drop("_epoch"))
