from pyspark.sql import functions as F

from lakeloom.streaming import running as S


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"k{i % 3}", float(i) / 4) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, key string, value double")
    landing = str(tmp_path / "landing")
    df.repartition(4).write.parquet(landing)
    stream = S.file_stream(spark, landing, df.schema, "parquet", max_files_per_trigger=1)
    assert stream.isStreaming
    streamed = S.run_available(S.running_totals(stream, "key", "value"), spark, "t_parity")
    par = S.parity(streamed, S.running_totals(df, "key", "value"), "key").collect()
    assert len(par) == 3 and all(r.equal for r in par)


def test_memory_sink_and_query_control(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "Country string, Value double")
    landing = str(tmp_path / "in")
    df.write.parquet(landing)
    q = S.start_to_table(S.running_totals(S.file_stream(spark, landing, df.schema), "Country", "Value", "QtdPeople"),
                         out_path=None, checkpoint=str(tmp_path / "ck"), query_name="countries_people", sink="memory")
    q.awaitTermination(120)
    assert not q.isActive and q.status is not None
    got = {r.Country: float(r.QtdPeople) for r in spark.sql(
        "SELECT Country, QtdPeople FROM countries_people WHERE QtdPeople > 1 ORDER BY QtdPeople DESC").collect()}
    assert got == {"a": 4.0, "b": 2.0}


def test_csv_stream_blank_first_line(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    for i in range(3):
        (d / f"f{i}.csv").write_text(
            f'\n "ITA","Italy","B12","Outflows","TOT","Total","TUR","Turkey","2018","2016",{900 + i},,\n')
    out = S.run_available(S.running_totals(S.csv_stream(spark, str(d)), "Country", "Value"), spark, "t_csv")
    r = out.first()
    assert r.Country == "Turkey" and int(r.total) == 2703


def test_second_call_resumes(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"), F.lit(0.004).alias("value"))
    landing, base = str(tmp_path / "in"), str(tmp_path / "base")
    df.write.parquet(landing)
    totals = S.running_totals(S.file_stream(spark, landing, df.schema), "k", "value")
    one = {r.k: r.total for r in S.run_available(totals, spark, "t_resume", base).collect()}
    df.where("id < 7").write.mode("append").parquet(landing)
    two = {r.k: r.total for r in S.run_available(totals, spark, "t_resume", base).collect()}
    assert all(abs(two[k] - one[k] - 0.004) < 1e-9 for k in one)
    assert abs(sum(two.values()) - 107 * 0.004) < 1e-9
    again = S.run_available(totals, spark, "t_resume", base)  # nothing new: the last result stands
    assert {r.k: r.total for r in again.collect()} == two
    assert len(S._epochs(spark, f"{base}/out")) == 2


def test_unfinished_epoch_is_not_read(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, total long")
    out = str(tmp_path / "out")
    assert S.latest(spark, out, df.schema).count() == 0
    df.write.parquet(f"{out}/epoch-000000000000")
    (tmp_path / "out" / "epoch-000000000001").mkdir()
    assert S.latest(spark, out, df.schema).collect() == df.collect()


def test_landing_is_dropped_and_rate_by_bytes(spark):
    df = spark.range(10_000).select(F.col("id"), (F.col("id") % 7).alias("k"), F.lit(1).alias("value"))
    path = S.stage_files(df.repartition(6), spark, "t_landing")
    stream = S.file_stream(spark, path, df.schema, max_bytes_per_trigger=1024)
    out = S.run_available(S.running_totals(stream, "k", "value"), spark, "t_rate")
    S.drop_landing(spark, path)
    assert sum(r.total for r in out.collect()) == 10_000
