import pytest
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom import rules as R
from lakeloom.operators import explore as X
from lakeloom.operators import observations as O
from lakeloom.operators import ranking
from lakeloom.operators import reshape as G

COLS = "ref_area string, counterpart string, time_period string, var_code string, sex string, " \
       "obs_value double, source_dataset string, row_id long"


def test_priority_merge(spark):
    rows = [("ITA", "DEU", "2010", "B11", "T", 1.0, "EUROSTAT", 1),
            ("ITA", "DEU", "2010", "B11", "T", 2.0, "OECD_MIG", 2),
            ("ITA", "FRA", "2010", "B11", "T", 3.0, "SOMETHING", 3),
            ("ITA", "FRA", "2010", "B11", "T", 4.0, "FALLBACK_CSV", 4),
            ("ITA", "ESP", "2010", "B11", "T", 5.0, "IRCC", 5),
            ("ITA", "ESP", "2010", "B11", "T", 6.0, "IRCC", 6),
            ("ITA", None, "2010", "B11", "T", 7.0, "OECD_MIG", 7),
            ("ITA", "", "2010", "B11", "T", 8.0, "OTHER", 8)]
    m = O.priority_merge(spark.createDataFrame(rows, COLS))
    got = {r.counterpart: r.obs_value for r in m.collect()}
    # OECD beats EUROSTAT; known source beats unknown (99); ties → first row; NULL key
    # competes with "" and comes out as "", the non-NULL original sorting first
    assert got == {"DEU": 2.0, "FRA": 4.0, "ESP": 5.0, "": 8.0}


def test_priority_merge_by_whole_rows(spark):
    rows = [("N1", 3.0, "b", "OECD_MIG"), ("N1", 2.0, "b", "OECD_MIG"), ("N1", 9.0, "a", "OECD_MIG"), ("N1", 1.0, "a", "IRCC"),
            ("N2", 5.0, "a", "IRCC"), ("N2", None, "a", "IRCC"), ("N3", float("nan"), "a", "IRCC"), ("N3", 7.0, "a", "IRCC"), (None, 4.0, "a", "IRCC"), ("", 6.0, "a", "IRCC")]
    m = O.priority_merge(spark.createDataFrame(rows, "counterpart string, obs_value double, metric string, source_dataset string"), key=["counterpart"])
    assert m.columns == ["counterpart", "obs_value", "metric", "source_dataset"]
    assert {r.counterpart: (r.obs_value, r.metric, r.source_dataset) for r in m.collect()} == {
        "N1": (2.0, "b", "OECD_MIG"), "N2": (None, "a", "IRCC"), "N3": (7.0, "a", "IRCC"), "": (6.0, "a", "IRCC")}
    p = m._jdf.queryExecution().executedPlan().toString()
    assert p.index("SortAggregate") < p.index(" HashAggregate") and "partial_min(obs_value" in p  # what is sorted has been reduced by hash


def test_union_aligned_skips_none_and_fills(spark):
    a = spark.createDataFrame([("ITA", 1.0)], "ref_area string, obs_value double")
    b = spark.createDataFrame([("CAN", "x", 1)], "ref_area string, extra string, year int")
    u = O.union_aligned([a, None, b])
    assert u.columns == R.CANONICAL_COLUMNS and u.count() == 2
    assert O.union_aligned([None]) is None


def test_obs_filter(spark):
    df = spark.createDataFrame([("2010", "Male", "m"), ("2012", "Female", "m"), ("x", "Male", "m"),
                                (None, "Male", "m"), ("2011", "Male", "n")], "year string, gender string, metric string")
    assert O.obs_filter(df, 2010, 2012, "All", None).count() == 3
    assert O.obs_filter(df, 2010, 2012, "Male", "m").count() == 1


def test_coverage_and_summary(spark):
    df = spark.createDataFrame([("A", None, 2000, 1.0, "m1"), ("A", None, 2003, None, "m2"), ("B", "X", 1999, 2.0, "m1")],
                               "source_dataset string, ref_area string, year int, obs_value double, metric string")
    cov = {r.source_dataset: r for r in O.coverage(df).collect()}
    assert (cov["A"].min_year, cov["A"].max_year, cov["A"].row_count, cov["A"].span_years) == (2000, 2003, 1, 4)
    s = {r.source_dataset: r.metrics for r in O.source_summary(df).collect()}
    assert s["A"] == ["m1", "m2"]


def test_top_n_and_share(spark):
    df = spark.createDataFrame([(2000, "a", 5.0), (2001, "a", 5.0), (2000, "b", 3.0), (2000, None, 100.0),
                                (2000, "c", 3.0)], "year int, g string, obs_value double")
    top = X.top_n_groups(df, "g", 2)
    assert {r.g for r in top.collect()} == {"a", "b"}  # NULL excluded; tie b/c by key
    share = {r.g: float(r.share_pct) for r in X.top_n_share(df, "g", 2).collect()}
    assert set(share) == {None, "a"} and abs(sum(share.values()) - 100) < 1e-6


def test_pivot_and_format(spark):
    df = spark.createDataFrame([("r1", "F", 1234.9), ("r1", "F", 1000.0), ("r2", "M", -1500.7), (None, "M", 1.0)],
                               "reg string, gender string, obs_value double")
    p = X.pivot_table(df, "reg", "gender")
    f = {r.reg: (r.F, r.M) for r in X.formatted(p, ["F", "M"]).collect()}
    assert f == {"r1": ("2,234", "0"), "r2": ("0", "-1,500")}


def test_pivot_columns_come_from_the_data(spark):
    df = spark.createDataFrame([("a", 2000, 0.004)] * 1000 + [("b", 2002, 1.5), ("a", None, 2.0)], "g string, year int, obs_value double")
    p = X.pivot_sum(df.dropna(), "g", "year")
    assert p.columns == ["g", "2000", "2002"]
    got = {r.g: (r["2000"], r["2002"]) for r in p.collect()}
    assert abs(got["a"][0] - 4.0) < 1e-9 and got["a"][1] == 0 and got["b"] == (0, 1.5)
    with pytest.raises(Exception, match="outside the declared list"):
        X.pivot_sum(df, "g", "year", [2000]).collect()


def test_group_column_falls_back(spark):
    df = spark.createDataFrame([(None, "x")], "imm_category string, counterpart_name string")
    assert X.group_column(df, "imm_category") == X.group_column(df, "absent") == "counterpart_name"
    assert X.group_column(df, "counterpart_name") == "counterpart_name"


def test_quantiles_are_those_of_numpy(spark):
    import numpy as np
    for values in ([3.0], [1.0, 2.0], [5, 1, 1, 1, 9, 2, 2, 7.5, -3, 0], list(range(1001))):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        r = ranking.quantiles(df, "v", [0.0, 0.2, 0.5, 0.95, 1.0]).first()
        assert r.quantiles == pytest.approx(np.quantile(values, [0.0, 0.2, 0.5, 0.95, 1.0]).tolist())
        assert r.least == min(values) and r.rows == len(values)
    assert ranking.quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).first().quantiles == [None]


def test_rank_buckets_are_even(spark):
    n, buckets = 200_000, 512
    df = spark.range(n).select((F.col("id") * 7919 % 1_000_003).alias("v"))
    cuts = sorted(set(df.approxQuantile("v", [i / buckets for i in range(1, buckets)], 0.1 / buckets)))
    sizes = [r["count"] for r in df.groupBy(ranking._bucket_of(F.col("v"), cuts)).count().collect()]
    assert max(sizes) < 1.5 * n / buckets


def test_min_rank_matches_window_rank(spark):
    vals = [5, 3, 3, None, 10, 1, 3, 7, 7, 2] * 3
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v long")
    ours = {r.id: r.rank for r in ranking.min_rank(df, "v", buckets=4).collect()}
    ref = df.where(F.col("v").isNotNull()).withColumn("r", F.rank().over(Window.orderBy("v")))
    expect = {r.id: r.r for r in ref.collect()}
    assert all(ours[i] == expect.get(i) for i in ours)


def test_unpivot_and_checked_pivot(spark):
    wide = spark.createDataFrame([("Asia", "10", None), ("Europe", "x", "5")], "area string, `2000` string, `2001` string")
    long = G.unpivot_years(wide, ["area"], ["2000", "2001"])
    got = {(r.area, r.DateYear): r.PeopleQtd for r in long.collect()}
    assert got == {("Asia", 2000): 10.0, ("Asia", 2001): 0.0, ("Europe", 2000): 0.0, ("Europe", 2001): 5.0}
    ok = G.pivot_unique(long, "area", "DateYear", "PeopleQtd")
    assert ok.count() == 2
    dup = long.unionByName(long)
    import pytest
    with pytest.raises(Exception, match="duplicate pivot cell"):
        G.pivot_unique(dup, "area", "DateYear", "PeopleQtd").collect()


def test_name_to_code(spark):
    df = spark.createDataFrame([(" Germany ",), ("Narnia",), ("Ab",), ("Total",)], "n string")
    got = [r.code for r in G.name_to_code(df, "n", spark).orderBy("n").collect()]
    assert sorted(got) == sorted(["DEU", "NAR", "Ab", "_T"])


def test_outer_fill(spark):
    shapes = spark.createDataFrame([("A", 1), ("B", 2)], "name string, region int")
    totals = spark.createDataFrame([("B", 5), ("C", 7)], "Country string, total long")
    got = {r.name: (r.region, r.total) for r in G.outer_fill(shapes, totals, "name", "Country", {"total": 0}).collect()}
    assert got == {"A": (1, 0), "B": (2, 5), "C": (None, 7)}
