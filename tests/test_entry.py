import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["CONTRACT_SOURCE_SYSTEM", "CONTRACT_SOURCE_SYSTEM_ID", "SOURCE_SYSTEM_ID"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 90


def test_all_queries_build_and_run_small(spark):
    """Every registered query runs on the smallest scale factor with a stable schema."""
    for name, fn in E.queries().items():
        df = fn(spark, SF)
        cols = df.columns
        df.write.format("noop").mode("overwrite").save()
        assert fn(spark, SF).columns == cols, name
