import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions import columns as C
from lakeloom.functions.hashing import md4_hex_batch
from lakeloom.operators import claims as CL
from lakeloom.operators import quality as Q


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_trailing_int(spark):
    df = one_col(spark, ["CL_68545123", "U_7065313", "NOUNDERSCORE", None, "CL_99999999999999"])
    got = [r[0] for r in df.select(C.trailing_int("x")).collect()]
    assert got == [68545123, 7065313, None, None, None]  # overflow → NULL in lenient mode


def test_value_map_defaults(spark):
    df = one_col(spark, ["1", "", None, "42", "10"])
    got = [r[0] for r in df.select(C.value_map("x", R.TRANSACTION_TYPE_MAPPING, "Unknown")).collect()]
    assert got == ["Private", "Unknown", "Unknown", "Unknown", "Internal"]
    empty = [r[0] for r in df.select(C.value_map("x", {}, "Unknown")).collect()]
    assert empty == ["Unknown"] * 5


def test_value_map_compares_as_text(spark):
    df = one_col(spark, [1, 9], "int")
    assert [r[0] for r in df.select(C.value_map("x", R.TRANSACTION_TYPE_MAPPING, "U")).collect()] == [
        "Private", "Reinsurance"]


def test_prefix_map(spark):
    df = one_col(spark, ["CL_1", "RX_2", "CX_3", "U_4", "cl_5", None, "RI_6"])
    got = [r[0] for r in df.select(C.prefix_map("x", R.TRANSACTION_DIRECTION_MAPPING)).collect()]
    assert got == ["COINSURANCE", "REINSURANCE", None, None, None, None, "INWARD_REINSURANCE"]


def test_decimal_dates_category(spark):
    df = spark.createDataFrame([("523.21", "14.02.2021", "17.01.2022 14:45"), ("98465", None, None),
                                (None, "01.01.2020", "01.01.2020 00:00"), ("-500.25", None, None),
                                ("0", None, None)], "a string, d string, t string")
    rows = df.select(C.to_decimal("a").alias("v"), C.parse_date("d", "dd.MM.yyyy").alias("d"),
                     C.parse_timestamp("t", "dd.MM.yyyy HH:mm").alias("t")).withColumn(
        "c", C.sign_category("v")).collect()
    assert rows[0].v == Decimal("523.21000") and rows[1].v == Decimal("98465.00000") and rows[2].v is None
    assert rows[0].d == dt.date(2021, 2, 14) and rows[0].t == dt.datetime(2022, 1, 17, 14, 45)
    assert [r.c for r in rows] == ["CHARGE", "CHARGE", "CHARGE", "REFUND", "CHARGE"]


def test_lenient_parse_gives_null(spark):
    df = spark.createDataFrame([("2021-02-14", "abc")], "d string, a string")
    r = df.select(C.parse_date("d", "dd.MM.yyyy", strict=False).alias("d"),
                  C.to_decimal("a", strict=False).alias("a")).first()
    assert r.d is None and r.a is None


def test_md4_vectors_and_golden_ids(spark):
    local = md4_hex_batch(pd.Series(["", "abc", "message digest", None]))
    assert local.tolist() == ["31d6cfe0d16ae931b73c59d7e0c089c0", "a448017aaf21d8525fc10ae87aa6729d",
                              "d9130a8164549fe818874806e1c7014b", None]
    df = one_col(spark, ["CX_339254", "CL_729664", None])
    got = [r[0] for r in df.select(CL.hash_id(F.col("x"), "md4")).collect()]
    assert got == ["a89cc9d9e62da256c91081b39d25afa1", "c6df8f2766135ec2830ee28615339301", None]


# FIXED VALUES — published claims, contracts and ids that the transactions have to match.
CLAIMS = [("Claim_SR_Europa_3", "CX_339254", "Contract_SR_Europa_3", "13767503", "4", "25.11.2021", "41979.15",
           "17.01.2022 14:45"),
          ("Claim_SR_Europa_3", "CL_729664", "Contract_SR_Europa_3", "97563756", "8", "28.09.2021", "14137.29",
           "17.01.2022 14:46"),
          ("Claim_SR_Europa_3", "RX_000002", "Contract_SR_Europa_3", "11111111", None, "01.01.2021", "-500.25",
           "17.01.2022 14:47")]
CONTRACTS = [("Contract_SR_Europa_3", "13767503", "Reinsurance"), ("Contract_SR_Europa_3", "97563756", "Direct"),
             (None, "11111111", "Direct")]


def claims_df(spark, rows=CLAIMS):
    from lakeloom.schemas import CLAIMS_SCHEMA
    return spark.createDataFrame(rows, CLAIMS_SCHEMA)


def contracts_df(spark, rows=CONTRACTS):
    return spark.createDataFrame(rows, "SOURCE_SYSTEM string, CONTRACT_ID string, CONTRACT_TYPE string")


def test_build_transactions_golden_rows(spark):
    tx = CL.build_transactions(claims_df(spark), contracts_df(spark), R.TransactionRules(),
                               run_ts=dt.datetime(2024, 1, 1), hash_algorithm="md4")
    assert tx.columns == R.TRANSACTIONS_COLUMNS
    rows = {r.NSE_ID: r for r in tx.collect()}
    r = rows["a89cc9d9e62da256c91081b39d25afa1"]
    assert (r.CONTRACT_SOURCE_SYSTEM, r.CONTRACT_SOURCE_SYSTEM_ID, r.SOURCE_SYSTEM_ID, r.TRANSACTION_TYPE,
            r.TRANSACTION_DIRECTION, r.CONFORMED_VALUE, r.BUSINESS_DATE, r.TRANSACTION_CATEGORY) == (
        "Europe 3", 13767503, 339254, "Government", None, Decimal("41979.15000"), dt.date(2021, 11, 25), "CHARGE")
    r2 = rows["c6df8f2766135ec2830ee28615339301"]
    assert r2.TRANSACTION_TYPE == "PartnerNetwork" and r2.TRANSACTION_DIRECTION == "COINSURANCE"
    refund = [x for x in rows.values() if x.TRANSACTION_CATEGORY == "REFUND"]
    # NULL contract source system never matches → no contract id; type NULL → default
    assert len(refund) == 1 and refund[0].CONTRACT_SOURCE_SYSTEM_ID is None and refund[0].TRANSACTION_TYPE == "Unknown"


def test_join_fans_out_on_duplicate_contracts(spark):
    dup = CONTRACTS + [("Contract_SR_Europa_3", "13767503", "Reinsurance")]
    j = CL.join_contracts(claims_df(spark), contracts_df(spark, dup))
    assert j.count() == 4
    stats = CL.join_stats(j).first()
    assert (stats.matched, stats.unmatched) == (3, 1)
    rep = Q.dq_report(j, ["CLAIM_ID"], id_col="CLAIM_ID").first()
    assert rep.duplicate_CLAIM_ID == 1


def test_dq_report_null_id_is_one_value(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "-2"), (None, "3"), (None, "x")], "id string, amt string")
    r = Q.dq_report(df, ["id"], amount_col="amt", id_col="id").first()
    assert (r.row_count, r.null_id, r.negative_amt, r.duplicate_id) == (4, 2, 1, 2)


def test_expectations_and_gate(spark):
    rows = CLAIMS + [("S", "CX_339254", "C", "1", "1", "01.01.2020", None, None),
                     ("S", "bad-id", "C", "1", "1", "01.01.2020", "1", None)]
    rep = Q.expectations_report(claims_df(spark, rows), Q.CLAIMS_EXPECTATIONS).first()
    assert rep.not_null_AMOUNT == 1 and rep.regex_CLAIM_ID == 1 and rep.unique_CLAIM_ID == 2
    with pytest.raises(RuntimeError, match="unique_CLAIM_ID=2"):
        Q.assert_expectations(Q.expectations_report(claims_df(spark, rows), Q.CLAIMS_EXPECTATIONS), "input")
    Q.assert_expectations(Q.expectations_report(claims_df(spark), Q.CLAIMS_EXPECTATIONS), "input")
    assert Q.missing_columns(claims_df(spark).drop("AMOUNT"), Q.CLAIMS_EXPECTATIONS) == ["AMOUNT"]


def test_reject_split(spark):
    rows = CLAIMS + [("S", "bad", "C", "1", "1", "2020-01-01", "x", None)]
    clean, rejected = Q.split_rejects(claims_df(spark, rows), Q.claims_checks("dd.MM.yyyy", "dd.MM.yyyy HH:mm"))
    bad = {r.CLAIM_ID: set(r.reasons) for r in rejected.collect()}
    assert bad["bad"] == {"claim_id_format", "amount_not_decimal", "date_of_loss_pattern"}
    assert bad["RX_000002"] == {"claim_type_unmapped"}
    assert clean.count() == 2


def test_multi_region_patterns(spark):
    rows = [("S", "CL_1", "SRC", "1", "1", "2021-02-14", "10", "2021-02-14 10:00", "Asia Pacific 1"),
            ("S", "CL_2", "SRC", "1", "1", "02/14/2021", "10", "02/14/2021 10:00", "North America 2"),
            ("S", "CL_3", "SRC", "1", "1", "14.02.2021", "10", "14.02.2021 10:00", "Europe 3")]
    claims = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in R.CLAIMS_COLUMNS + ["REGION"]))
    tx = CL.build_multi_region(claims, contracts_df(spark), R.region_rules(), run_ts=dt.datetime(2024, 1, 1))
    got = {r.REGION: (r.CONTRACT_SOURCE_SYSTEM, r.BUSINESS_DATE) for r in tx.collect()}
    assert all(v == (k, dt.date(2021, 2, 14)) for k, v in got.items()) and len(got) == 3
    agg = CL.global_aggregate(tx).collect()
    assert sum(r.n_transactions for r in agg) == 3


def test_unknown_region_is_parted_off_or_fails(spark):
    rows = [("S", "CL_1", "SRC", "1", "1", "2021-02-14", "10", "2021-02-14 10:00", r) for r in ("Asia Pacific 1", "Atlantis", None)]
    claims = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in R.CLAIMS_COLUMNS + ["REGION"]))
    known, unknown = CL.known_regions(claims, R.region_rules())
    assert known.count() == 1 and {tuple(r.reasons) for r in unknown.collect()} == {("region_unknown",)}
    with pytest.raises(Exception, match="no rules for region"):
        CL.build_multi_region(claims, contracts_df(spark), R.region_rules(), run_ts=dt.datetime(2024, 1, 1)).collect()


def test_matched_contract_without_number(spark):
    claims = spark.createDataFrame([("C1", "S", "AB7"), ("C2", "S", "8"), ("C3", None, "8")], "CLAIM_ID string, CONTRACT_SOURCE_SYSTEM string, CONTRACT_ID string")
    contracts = spark.createDataFrame([("S", "AB7"), ("S", "8")], "SOURCE_SYSTEM string, CONTRACT_ID string")
    j = CL.join_contracts(claims, contracts, strict=False)
    assert {r.CLAIM_ID: (r.CONTRACT_MATCHED, r.CONTRACT_SOURCE_SYSTEM_ID) for r in j.collect()} == {
        "C1": (True, None), "C2": (True, 8), "C3": (False, None)}
    assert tuple(CL.join_stats(j).first()) == (2, 1)
    with pytest.raises(Exception, match="AB7"):
        CL.join_contracts(claims, contracts).collect()


def test_run_log_is_appended_and_failure_raised(spark, tmp_path):
    tx = CL.build_transactions(claims_df(spark), contracts_df(spark), run_ts=dt.datetime(2024, 1, 1))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    CL.run_with_log(spark, tx, out, "Europe 3", {"a": 1}, log)
    with pytest.raises(Exception, match="already exists"):
        CL.run_with_log(spark, tx, out, "Europe 3", {"a": 1}, log, mode="errorifexists")
    rows = {r.status: r for r in spark.read.parquet(log).collect()}
    assert rows["success"].rows_output == 3 and rows["success"].error_message is None
    assert rows["failed"].rows_output is None and "already exists" in rows["failed"].error_message


def test_gate_stands_before_the_output(spark, tmp_path):
    out = str(tmp_path / "a")
    ok = CL.run_gated(spark, claims_df(spark), contracts_df(spark), R.TransactionRules(), out, run_ts=dt.datetime(2024, 1, 1))
    assert ok["rows_out"] == 3 and ok["duplicate_NSE_ID"] == 0
    good = sorted(map(str, spark.read.parquet(out).collect()))
    repeated = CONTRACTS + [CONTRACTS[0]]
    with pytest.raises(RuntimeError, match="after_transform"):
        CL.run_gated(spark, claims_df(spark), contracts_df(spark, repeated), R.TransactionRules(), out)
    assert sorted(map(str, spark.read.parquet(out).collect())) == good  # the last good run stays
    with pytest.raises(RuntimeError, match="after_raw_input"):
        CL.run_gated(spark, claims_df(spark, CLAIMS + [CLAIMS[0]]), contracts_df(spark), R.TransactionRules(), out)
    CL.run_gated(spark, claims_df(spark, CLAIMS[:1]), contracts_df(spark), R.TransactionRules(), out, run_ts=dt.datetime(2024, 1, 1))
    assert spark.read.parquet(out).count() == 1
