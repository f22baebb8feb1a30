"""Keyed totals and the split stream."""

import os

from pyspark.sql import functions as F

from lakeloom.operators import merging as ME
from lakeloom.streaming import running as S
from lakeloom.streaming import sinks as K


def files(path):
    return {f"{os.path.basename(d)}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_epochs_write_only_the_buckets_of_changed_keys(spark, tmp_path):
    def land(rows):
        spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def drain():
        K.upsert_totals(totals, table, f"{tmp_path}/checkpoint", spark)
        return {r.k: r.total for r in table.rows(spark).collect()}

    land([(f"k{i}", i) for i in range(100)])
    totals = S.running_totals(S.file_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema), "k", "v")
    table = ME.KeyedTable(f"{tmp_path}/out", totals.schema, ("k",), 16)
    assert drain() == {f"k{i}": i for i in range(100)}
    first = files(table.path)
    assert len(first) == 16
    land([("k7", 1000)])  # an epoch with one key
    assert drain() == {f"k{i}": i + 1000 * (i == 7) for i in range(100)}
    second = files(table.path)
    bucket = spark.createDataFrame([("k7",)], "k string").select(table.bucket()).first()[0]
    assert {f.split("/")[0] for f in first ^ second} == {f"_bucket={bucket}"}
    # Replaying an epoch changes nothing.
    K.merge_epoch(table, spark.createDataFrame([("k7", 1007)], totals.schema))
    assert files(table.path) == second
    assert drain() and files(table.path) == second  # nothing new in the folder


def test_accepted_and_rejected_are_all_lines(spark, tmp_path):
    good = " CO,Italy,B11,Inflow,TOT,Total,AFG,Afghanistan,1998,1998,{},,"
    lines = [good.format(5), "", good.format("x"), " a,b", good.format(7) + ",more", good.format(""), good.format(8)]
    os.makedirs(f"{tmp_path}/in")
    (tmp_path / "in" / "a.csv").write_text("\n".join(lines) + "\n")
    K.split_stream(K.checked_csv_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    accepted, rejected = K.split_tables(spark, f"{tmp_path}/out")
    assert sorted(r.Value if r.Value is not None else -1 for r in accepted.collect()) == [-1, 5, 8]
    assert sorted(r.line.strip() for r in rejected.collect()) == sorted(lines[k].strip() for k in (2, 3, 4))
    # A second drain takes the new file; a replayed epoch overwrites its own folders.
    (tmp_path / "in" / "b.csv").write_text(good.format(9) + "\n" + "bad\n")
    K.split_stream(K.checked_csv_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    batch = spark.read.schema(accepted.schema.add(K.CORRUPT, "string")).option("columnNameOfCorruptRecord", K.CORRUPT).csv(f"{tmp_path}/in/b.csv")
    K.write_split(batch.withColumn("Value", F.col("Value")), 1, f"{tmp_path}/out")
    accepted, rejected = K.split_tables(spark, f"{tmp_path}/out")
    assert accepted.count() == 4 and rejected.count() == 4
