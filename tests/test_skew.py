"""A key holding a third of all rows: results stay whole and plans pre-aggregate."""
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.operators import claims as CL
from lakeloom.operators import observations as O
from lakeloom.operators import quality as Q
from lakeloom.operators import ranking

N = 30_000


def skewed(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        "id", F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 101).alias("v"))


def test_priority_merge_hot_key(spark):
    df = skewed(spark).select(F.lit("ITA").alias("ref_area"), F.col("k").alias("counterpart"),
                              F.lit("2020").alias("time_period"), F.lit("B11").alias("var_code"), F.lit("T").alias("sex"),
                              F.col("v").cast("double").alias("obs_value"),
                              F.when(F.col("id") == 29997, F.lit("OECD_MIG")).otherwise(F.lit("IRCC")).alias("source_dataset"),
                              F.col("id").alias("row_id"))
    m = O.priority_merge(df)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # the hot key is combined map-side before the shuffle
    hot = m.where(F.col("counterpart") == "HOT").collect()
    assert len(hot) == 1 and hot[0].source_dataset == "OECD_MIG" and hot[0].row_id == 29997
    assert m.count() == 998


def test_gate_counts_with_hot_id(spark):
    r = Q.dq_report(skewed(spark), ["k"], id_col="k").first()
    assert r.row_count == N and r.duplicate_k == N - 998


def test_join_fan_out_with_hot_contract(spark):
    numeric = F.when(F.col("k") == "HOT", F.lit("1000000")).otherwise(F.substring("k", 2, 10))
    claims = skewed(spark).select(F.concat(F.lit("CL_"), F.col("id").cast("string")).alias("CLAIM_ID"),
                                  F.lit("S").alias("CONTRACT_SOURCE_SYSTEM"), numeric.alias("CONTRACT_ID"))
    contracts = spark.createDataFrame([("S", "1000000"), ("S", "1000000"), ("S", "1")],
                                      "SOURCE_SYSTEM string, CONTRACT_ID string")
    j = CL.join_contracts(claims, contracts)
    s = CL.join_stats(j).first()
    hot_rows = N // 3
    n_k1 = claims.where(F.col("CONTRACT_ID") == "1").count()
    assert s.matched == 2 * hot_rows + n_k1 and j.count() == N + hot_rows  # duplicates fan out, nothing dropped
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_rank_with_hot_value(spark):
    df = skewed(spark).select("id", "v")
    ours = {r.id: r.rank for r in ranking.min_rank(df, "v", buckets=16).collect()}
    ref = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy("v"))).collect()}
    assert ours == ref


def test_rank_with_many_buckets(spark):
    df = spark.range(20_000).select("id", ((F.col("id") * 7919) % 5003).alias("v"))
    ours = {r.id: r.rank for r in ranking.min_rank(df, "v", buckets=1024).collect()}
    ref = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy("v"))).collect()}
    assert ours == ref


def test_heavy_contract_is_spread_without_adaptive_help(spark):
    claims = skewed(spark).select(F.concat(F.lit("CL_"), F.col("id").cast("string")).alias("CLAIM_ID"), F.lit("S").alias("CONTRACT_SOURCE_SYSTEM"),
                                  F.when(F.col("k") == "HOT", F.lit("1000000")).when(F.col("id") % 1000 == 1, F.lit(None).cast("string"))
                                  .otherwise(F.substring("k", 2, 10)).alias("CONTRACT_ID"))
    rows = [("S", "1000000"), ("S", "1000000"), ("S", None), (None, "5"), *[("S", str(i)) for i in range(0, 997, 2)]]
    contracts = spark.createDataFrame(rows, "SOURCE_SYSTEM string, CONTRACT_ID string")
    settings = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "211"}
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert [tuple(r) for r in CL.heavy_contracts(claims, share=0.01).collect()] == [("S", "1000000")]
        plain = CL.join_contracts(claims, contracts)
        spread = CL.join_contracts_spread(claims, contracts, share=0.01)
        columns = ["CLAIM_ID", "CONTRACT_ID", "CONTRACT_MATCHED", "CONTRACT_SOURCE_SYSTEM_ID"]
        assert spread.columns == plain.columns
        assert spread.select(columns).exceptAll(plain.select(columns)).isEmpty() and plain.select(columns).exceptAll(spread.select(columns)).isEmpty()
        sizes = sorted(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
        sizes = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] > 20 * sizes[len(sizes) // 2]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
