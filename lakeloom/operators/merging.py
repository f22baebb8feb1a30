"""Merges that touch only what changed (J4, J5): a table in key buckets.

The table is a folder of Parquet files in ``_bucket=k`` folders, k a hash of the
key. A batch is looked up in the buckets that hold one of its keys only, by key
and compared columns; of those

* a bucket with changed rows is rewritten (dynamic partition overwrite: the files
  are staged beside the table and take the old ones' place when the job commits);
* a bucket that only gains rows gets one more file;
* a bucket whose staged rows are all there already is left alone.

A job that fails before its commit leaves the table as it was. Insertions commit
after the rewritten buckets; a merge that stopped between the two, or was
started twice, is finished by running it again, since what is there already is
not staged for writing again. One merge at a time writes to a table.

Keys compare NULL-safe. A key that stands twice in a batch fails the merge before
anything is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.incremental import TX_KEY
from lakeloom.session import written

BUCKET = "_bucket"
KEEP, INSERT, UPDATE, UNCHANGED = "keep", "insert", "update", "unchanged"


@dataclass(frozen=True)
class KeyedTable:
    """Where the table is, what identifies a row, and into how many buckets keys fall (fixed for the table's life)."""

    path: str
    schema: T.StructType
    key: tuple[str, ...] = TX_KEY
    buckets: int = 256
    max_records: int = 5_000_000  # of a file

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def create(self, spark: SparkSession) -> None:
        """The table's folder, so that a table without rows can be read."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def read(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets (folders of others aren't listed for reading), with their bucket."""
        rows = spark.read.schema(T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])).parquet(self.path)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).drop(BUCKET)

    def write(self, rows: DataFrame, mode: str = "overwrite") -> None:
        """Rows into their buckets; ``overwrite`` replaces the buckets that get rows and no other.

        ``rebalance`` parts large buckets among tasks and puts small ones together;
        without adaptive execution (a stream's batches) a bucket is a task's.
        """
        rows = rows.select(*[f.name for f in self.schema], self.bucket())
        adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        rows = rows.hint("rebalance", BUCKET) if adaptive else rows.repartition(BUCKET)
        (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", self.max_records).partitionBy(BUCKET).parquet(self.path))


def _same(left: str, right: str, key: tuple[str, ...]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def staged_actions(table: KeyedTable, batch: DataFrame) -> DataFrame:
    """The batch's rows with their bucket and action (insert, update, unchanged), written once.

    Of the table only the buckets with a key of the batch are read. Their rows
    meet the batch in an inner join (Spark filters the larger side by the smaller
    one's keys where that pays), so a shuffle carries no rows of other buckets.
    """
    spark = batch.sparkSession
    columns = [f.name for f in table.schema]
    staged = written(batch.select(*columns, table.bucket()), "merge-batch")
    twice = staged.groupBy(*table.key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"a key stands {twice[0]['count']} times in the batch: {[twice[0][k] for k in table.key]}")
    hit = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # at most table.buckets
    old = table.read(spark, hit).select(BUCKET, *[F.col(c).alias(c) for c in columns]).alias("t")
    differ = F.lit(False)
    for c in columns:
        if c not in table.key:
            differ = differ | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    new = staged.alias("s")
    joined = new.join(old, (F.col(f"s.{BUCKET}") == F.col(f"t.{BUCKET}")) & _same("s", "t", table.key), "left")
    action = F.when(F.col(f"t.{BUCKET}").isNull(), INSERT).when(differ, UPDATE).otherwise(UNCHANGED)
    return written(joined.select("s.*", action.alias("merge_action")), "merge-actions")


def merge(table: KeyedTable, batch: DataFrame, update: bool = True) -> DataFrame:
    """The batch into the table; returns ``staged_actions``.

    J4 with ``update=False``: only rows whose key the table lacks are added.
    """
    actions = staged_actions(table, batch)
    spark = batch.sparkSession
    counts = actions.groupBy(BUCKET).pivot("merge_action", [INSERT, UPDATE, UNCHANGED]).count().na.fill(0).collect()  # a row a bucket
    rewritten = sorted(r[BUCKET] for r in counts if update and r[UPDATE])
    if rewritten:
        changed = actions.where(F.col("merge_action").isin(INSERT, UPDATE) & F.col(BUCKET).isin(rewritten))
        gone = actions.where(F.col("merge_action") == UPDATE).select(BUCKET, *table.key).alias("s")
        kept = table.read(spark, rewritten).alias("t").join(gone, (F.col(f"s.{BUCKET}") == F.col(f"t.{BUCKET}")) & _same("s", "t", table.key), "left_anti")
        table.write(kept.unionByName(changed.drop("merge_action")))
    added = actions.where((F.col("merge_action") == INSERT) & ~F.col(BUCKET).isin(rewritten))
    if any(r[INSERT] and r[BUCKET] not in rewritten for r in counts):
        table.write(added, "append")
    return actions
