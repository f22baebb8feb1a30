"""Bucket merges: what is read, what is rewritten, and what a failure leaves."""

import os
import re

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import merging as ME

SCHEMA = "a string, b long, v long"


def table_of(spark, tmp_path, rows, buckets=8, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    table = ME.KeyedTable(str(tmp_path / "table"), df.schema, ("a", "b"), buckets, **options)
    table.write(df)
    return table


def files(table):
    return {f"{os.path.basename(d)}/{f}" for d, _, names in os.walk(table.path) for f in names if f.startswith("part-")}


def rows_of(spark, table):
    return sorted((tuple(r) for r in table.rows(spark).collect()), key=str)


BASE = [(f"k{i}", i, i) for i in range(200)] + [("k", None, 1), (None, 1, 2)]


def test_update_insert_unchanged_and_null_keys(spark, tmp_path):
    table = table_of(spark, tmp_path, BASE)
    batch = [("k1", 1, 1), ("k2", 2, -2), ("k", None, 9), (None, 1, 2), (None, None, 5), ("new", 1, 1)]
    actions = {(r.a, r.b): r.merge_action for r in ME.merge(table, spark.createDataFrame(batch, SCHEMA)).collect()}
    assert actions == {("k1", 1): "unchanged", ("k2", 2): "update", ("k", None): "update", (None, 1): "unchanged", (None, None): "insert", ("new", 1): "insert"}
    expected = {(a, b): v for a, b, v in BASE} | {(a, b): v for a, b, v in batch}
    assert rows_of(spark, table) == sorted(((a, b, v) for (a, b), v in expected.items()), key=str)


def test_only_buckets_with_changes_are_rewritten(spark, tmp_path):
    table = table_of(spark, tmp_path, BASE, buckets=32)
    of = {(r.a, r.b): r[2] for r in spark.createDataFrame(BASE, SCHEMA).select("a", "b", table.bucket()).collect()}
    before = files(table)
    ME.merge(table, spark.createDataFrame([("k5", 5, 50), ("k9", 9, 9)], SCHEMA))
    after = files(table)
    assert {f.split("/")[0] for f in before ^ after} == {f"_bucket={of['k5', 5]}"}
    # Nothing new: nothing written. New rows only: old files stay.
    ME.merge(table, spark.createDataFrame([("k5", 5, 50)], SCHEMA))
    assert files(table) == after
    ME.merge(table, spark.createDataFrame([("brand", 1, 1)], SCHEMA))
    assert after < files(table) and len(files(table)) == len(after) + 1


def test_other_buckets_are_not_read(spark, tmp_path):
    table = table_of(spark, tmp_path, BASE, buckets=32)
    plan = table.read(spark, [3])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket#\d+ = 3", plan)
    for name in os.listdir(table.path):  # a batch for one bucket gets by without the others' files
        if name.startswith("_bucket=") and name != "_bucket=3":
            for f in os.listdir(f"{table.path}/{name}"):
                with open(f"{table.path}/{name}/{f}", "wb") as out:
                    out.write(b"no parquet")
    row = table.read(spark, [3]).first()
    actions = ME.merge(table, spark.createDataFrame([(row.a, row.b, -1)], SCHEMA)).collect()
    assert [r.merge_action for r in actions] == ["update"]
    assert table.read(spark, [3]).where("v = -1").count() == 1


def test_a_failed_merge_leaves_the_table_and_can_be_run_again(spark, tmp_path):
    table = table_of(spark, tmp_path, BASE)
    before, kept = files(table), rows_of(spark, table)
    rows = table.read(spark, list(range(8))).drop("_bucket")
    broken = rows.withColumn("v", F.when(F.col("a") == "k7", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v") + 1))
    with pytest.raises(Exception, match="lost"):
        table.write(broken)
    assert files(table) == before and rows_of(spark, table) == kept
    batch = spark.createDataFrame([("k1", 1, 100), ("n1", 1, 1)], SCHEMA)
    ME.merge(table, batch)
    once = rows_of(spark, table)
    ME.merge(table, batch)
    assert rows_of(spark, table) == once and len(once) == len(kept) + 1


def test_repeated_keys_and_append_only(spark, tmp_path):
    table = table_of(spark, tmp_path, BASE)
    before = rows_of(spark, table)
    with pytest.raises(ValueError, match="2 times"):
        ME.merge(table, spark.createDataFrame([("x", 1, 1), ("x", 1, 2)], SCHEMA))
    assert rows_of(spark, table) == before
    ME.merge(table, spark.createDataFrame([("k1", 1, 77), ("x", 1, 1)], SCHEMA), update=False)
    assert rows_of(spark, table) == sorted([*before, ("x", 1, 1)], key=str)


def test_large_buckets_fall_into_files(spark, tmp_path):
    table = table_of(spark, tmp_path, [("hot", i, i) for i in range(1000)], buckets=1, max_records=100)
    assert len(files(table)) >= 10
    assert table.rows(spark).count() == 1000
