import datetime as dt

from pyspark.sql import functions as F

from lakeloom.operators import incremental as INC

SCHEMA = "CONTRACT_SOURCE_SYSTEM string, CONTRACT_SOURCE_SYSTEM_ID long, NSE_ID string, v int"


def test_new_rows_null_safe_key(spark):
    target = spark.createDataFrame([("E", None, "a", 1), ("E", 7, "b", 1)], SCHEMA)
    staging = spark.createDataFrame([("E", None, "a", 9), ("E", 7, "b", 9), ("E", None, "c", 9)], SCHEMA)
    new = INC.new_rows(target, staging).collect()
    assert [r.NSE_ID for r in new] == ["c"]  # the NULL-keyed "a" is recognised as existing
    out = INC.append_new(target, staging, "batch-2")
    assert out.count() == 3 and out.where(F.col("BATCH_ID") == "batch-2").count() == 1


def test_upsert_actions(spark):
    target = spark.createDataFrame([("E", None, "a", 1), ("E", 7, "b", 1), ("E", 8, "k", 1)], SCHEMA)
    staging = spark.createDataFrame([("E", None, "a", 2), ("E", 7, "b", 1), ("E", 9, "n", 5)], SCHEMA)
    got = {r.NSE_ID: (r.v, r.merge_action) for r in INC.upsert(target, staging).collect()}
    assert got == {"a": (2, "update"), "b": (1, "unchanged"), "k": (1, "keep"), "n": (5, "insert")}


def test_lookup_effective_ranges(spark):
    facts = spark.createDataFrame([("c1", "1", dt.date(1998, 6, 1)), ("c2", "1", dt.date(2005, 1, 1)),
                                   ("c3", "3", dt.date(2005, 1, 1)), ("c4", None, dt.date(2005, 1, 1))],
                                  "id string, code string, d date")
    lk = spark.createDataFrame([("1", "old", dt.date(1990, 1, 1), dt.date(1998, 12, 31), True),
                                ("1", "new", dt.date(1999, 1, 1), None, True),
                                ("3", "off", dt.date(1999, 1, 1), None, False)],
                               "k string, label string, effective_from date, effective_to date, active boolean")
    out = INC.lookup_effective(facts, lk, ["code"], ["k"], "d", "label", "label_out", F.lit("file"))
    got = {r.id: r.label_out for r in out.collect()}
    assert got == {"c1": "old", "c2": "new", "c3": "file", "c4": "file"}
