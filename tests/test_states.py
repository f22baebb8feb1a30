"""Mergeable quality and quantile states, sparse pivots and interval lookups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import explore as X
from lakeloom.operators import incremental as INC
from lakeloom.operators import quality as Q
from lakeloom.operators import states as ST


def checked(spark, tmp_path, deliveries):
    schema = "id string, kind string, v double"
    table, read = None, []
    for part, rows in enumerate(deliveries):
        df = spark.createDataFrame(rows, schema)
        table = table or ST.CheckedTable(str(tmp_path / "t"), df.schema, ("id", "kind"), "id", "v")
        read.append(table.add(spark, df, part))
    return table, read


DELIVERIES = [[("a1", "x", 1.0), ("a2", None, -1.0), ("a2", "x", 1.0)],
              [("b1", "x", 1.0), (None, "x", -2.0), (None, None, 1.0)],
              [("a2", "x", 1.0), ("a3", "x", 1.0)],      # an id of the first
              [("a0", "x", 1.0), ("b9", "x", 1.0)],      # overlaps all ranges, shares nothing
              [(None, "x", 1.0), ("c1", "x", -1.0)],     # NULL again
              []]


def test_merged_states_equal_a_recount(spark, tmp_path):
    table, read = checked(spark, tmp_path, DELIVERIES)
    whole = Q.dq_report(table.rows(spark), ["id", "kind"], "v", "id").first().asDict()
    assert table.report(spark).first().asDict() == whole and whole["duplicate_id"] == 4
    assert read == [[], [], [0], [], [1], []]


def test_only_the_new_partition_and_suspects_are_read(spark, tmp_path):
    table, _ = checked(spark, tmp_path, DELIVERIES[:2])
    for part in (0, 1):  # what is not read may be anything
        folder = tmp_path / "t" / "data" / f"part={part}"
        for f in folder.glob("part-*"):
            f.write_bytes(b"no parquet")
    new = spark.createDataFrame([("z1", "x", 1.0), ("z2", "x", -1.0)], table.schema)
    assert table.add(spark, new, 2) == []
    assert table.add(spark, new, 2) == []  # the newest once more
    r = table.report(spark).first()
    assert (r.row_count, r.negative_v, r.duplicate_id) == (8, 3, 2)


def test_many_ids_are_checked_exactly(spark, tmp_path):
    schema = spark.createDataFrame([("a", "x", 1.0)], "id string, kind string, v double").schema
    table = ST.CheckedTable(str(tmp_path / "t"), schema, ("id",), "id")
    rows = lambda lo, hi, step: spark.range(lo, hi, step).select(F.format_string("%07d", "id").alias("id"), F.lit("x").alias("kind"), F.lit(1.0).alias("v"))
    assert table.add(spark, rows(0, 20_000, 2), 0) == []
    assert table.add(spark, rows(1, 20_001, 2).unionByName(rows(4, 5, 1)), 1) == [0]  # one id of ten thousand is known
    assert table.report(spark).first().duplicate_id == 1


def test_quantiles_of_merged_sketches(spark):
    df = spark.range(30_000).select((F.col("id") % 7).alias("part"), F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 100 == 1, None)
                                    .otherwise((F.col("id") * 7919 % 10_007).cast("double")).alias("v"))
    found = ST.merged_quantiles(ST.quantile_states(df, "part", "v"), [0.1, 0.5, 0.9])
    rows = ST.rank_errors(df, "v", found).collect()
    assert len(rows) == 3 and all(r.error <= ST.KLL_ERROR for r in rows)
    assert {r.n for r in found.collect()} == {df.where("v is not null").count()}
    wrong = spark.createDataFrame([(0.5, 9000.0)], "probability double, value double")
    assert ST.rank_errors(df, "v", wrong).first().error > ST.KLL_ERROR


def test_sparse_pivot(spark):
    rows = [("a", 1, 1.0), ("a", 1, 2.0), ("a", 10, 5.0), ("b", 2, None), (None, 1, 4.0), ("c", None, 3.0)]
    df = spark.createDataFrame(rows, "r string, c int, obs_value double")
    sparse = X.pivot_sparse(df, "r", "c")
    assert {r.r: r.cells for r in sparse.collect()} == {"a": {"1": 3.0, "10": 5.0}, "b": {"2": None}, None: {"1": 4.0}, "c": {}}
    wide = X.widen(sparse, [1, 2, 10])
    dense = X.pivot_sum(df.where("c is not null"), "r", "c", [1, 2, 10])
    assert wide.where("r <> 'c' or r is null").exceptAll(dense).isEmpty() and wide.columns == dense.columns
    assert X.widen(sparse, [2], fill=None).where("r = 'a'").first()["2"] is None
    many = spark.range(12_000).select(F.lit("k").alias("r"), F.col("id").alias("c"), F.lit(1.0).alias("obs_value"))
    with pytest.raises(Exception, match="(?i)pivot"):
        X.pivot_sum(many, "r", "c").count()
    assert X.pivot_sparse(many, "r", "c").select(F.size("cells")).first()[0] == 12_000


def test_interval_lookup_equals_the_other_one(spark):
    rng = random.Random(3)
    day = lambda n: dt.date(1990, 1, 1) + dt.timedelta(days=n)
    versions = [(f"k{i % 5}", f"v{i}", day(a := rng.randint(0, 4000)), None if rng.random() < 0.1 else day(a + rng.randint(0, 900)), rng.random() < 0.9) for i in range(300)]
    versions += [("k0", "late", day(9000), None, True), ("k0", None, day(10), day(20), None)]
    facts = [(i, None if i % 50 == 0 else f"k{rng.randint(0, 6)}", None if i % 41 == 0 else day(rng.randint(-50, 5000))) for i in range(600)]
    facts = spark.createDataFrame(facts, "id long, code string, d date")
    lookup = spark.createDataFrame(versions, "k string, label string, effective_from date, effective_to date, active boolean")
    args = (["code"], ["k"], "d", "label", "out", F.lit("none"))
    plain, binned = INC.lookup_effective(facts, lookup, *args), INC.lookup_intervals(facts, lookup, *args)
    assert sorted(map(tuple, binned.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    plan = binned._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "collect_list" not in plan
    assert INC.lookup_intervals(facts.limit(0), lookup, *args).count() == 0


def test_ten_thousand_versions_of_one_key(spark):
    days = spark.range(10_000).select(F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("id").cast("int")).alias("d"), F.col("id").cast("string").alias("label"))
    lookup = days.select(F.lit("k").alias("k"), "label", F.col("d").alias("effective_from"), F.col("d").alias("effective_to"), F.lit(True).alias("active"))
    facts = days.select(F.lit("k").alias("code"), "d", F.col("label").alias("want"))
    got = INC.lookup_intervals(facts, lookup, ["code"], ["k"], "d", "label", "out", F.lit("none"))
    assert got.count() == 10_000 and got.where("out <> want").isEmpty()
