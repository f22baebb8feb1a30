"""Payment-message round trips.

Spark writes one MT103 per order into FIN batch texts (8 consecutive orders per
batch: a bounded group) and one pacs.008 document per batch; the parsers read
them back. The oracle derives every expected field from ``orders`` directly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import messages as M
from lakeloom.operators import pacs_files as PF
from lakeloom.session import scratch_path
from lakeloom.plans.catalog import register
from lakeloom.plans.sqltext import case_map
from lakeloom.plans.standins import with_ctes
from lakeloom.sources.tables import table

BATCH = 8
CCYS = ["EUR", "USD", "CHF"]
CHARGES = {"F": "SHA", "O": "OUR"}  # anything else BEN


def _orders(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)


def _pieces(df: DataFrame) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    nk2 = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    ccy = F.element_at(F.array(*[F.lit(c) for c in CCYS]), F.pmod("n_nationkey", F.lit(3)).cast("int") + 1)
    amt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    charges = (F.when(F.col("o_orderstatus") == "F", F.lit("SHA"))
               .when(F.col("o_orderstatus") == "O", F.lit("OUR")).otherwise(F.lit("BEN")))
    return df.select(
        "o_orderkey", F.floor(F.col("o_orderkey") / BATCH).cast("long").alias("batch_id"),
        F.concat(F.lit("REF"), k).alias("ref"), ccy.alias("ccy"), amt.alias("amt"),
        F.date_format("o_orderdate", "yyMMdd").alias("yymmdd"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("ymd"),
        F.concat(F.lit("DE"), F.lpad(F.col("o_custkey").cast("string"), 20, "0")).alias("iban_d"),
        F.concat(F.lit("GB"), F.lpad(k, 20, "0")).alias("iban_c"),
        F.concat(F.lit("BANK"), nk2, F.lit("XXX")).alias("bic_c"),
        F.concat(F.lit("BANKDE"), nk2, F.lit("X")).alias("bic_d"),
        "c_name", "n_name", "o_orderpriority", "o_orderstatus", nk2.alias("nk2"), charges.alias("charges"),
        (F.pmod("o_orderkey", F.lit(5)) == 0).alias("has_b3"), (F.pmod("o_orderkey", F.lit(7)) == 0).alias("has_b5"),
        (F.col("o_orderstatus") == "F").alias("has_33b"),
        F.substring("o_orderpriority", 1, 1).isin("1", "2").alias("has_53b"),
        (F.col("o_orderstatus") != "P").alias("has_77b"))


def _fin_message(p: DataFrame) -> DataFrame:
    nl = F.lit("\n")
    opt = lambda cond, *parts: F.when(F.col(cond), F.concat(*parts)).otherwise(F.lit(""))
    k = F.col("o_orderkey").cast("string")
    body = F.concat(
        F.lit("{1:F01BANK"), F.col("nk2"), F.lit("XXXX"), F.lpad(k, 10, "0"), F.lit("}"),
        F.lit("{2:I103BANK"), F.col("nk2"), F.lit("XXXXN}"),
        opt("has_b3", F.lit("{3:{108:"), F.col("ref"), F.lit("}}")),
        F.lit("{4:\n:20:"), F.col("ref"), F.lit("\n:23B:CRED\n:32A:"), F.col("yymmdd"), F.col("ccy"),
        F.regexp_replace(F.col("amt"), r"\.", ","), nl,
        opt("has_33b", F.lit(":33B:"), F.col("ccy"), F.regexp_replace(F.col("amt"), r"\.", ","), nl),
        F.lit(":50K:/"), F.col("iban_d"), nl, F.col("c_name"), nl, F.col("n_name"), nl,
        opt("has_53b", F.lit(":53B:/"), F.lpad(k, 10, "0"), nl),
        F.lit(":57A:"), F.col("bic_c"), F.lit("\n:59:/"), F.col("iban_c"), F.lit("\nBENEF "), k,
        F.lit("\n:70:ORDER "), k, F.lit(" "), F.col("o_orderpriority"), F.lit("\n:71A:"), F.col("charges"), nl,
        opt("has_77b", F.lit(":77B:/REG/"), F.col("o_orderpriority"), nl),
        F.lit("-}"),
        opt("has_b5", F.lit("{5:{CHK:"), F.lpad(k, 12, "0"), F.lit("}}")))
    return p.withColumn("message", body)


def fin_batches(spark, sf_dir) -> DataFrame:
    """FIN batch texts (batch_id, text): ≤ 8 messages each, in order-key order."""
    m = _fin_message(_pieces(_orders(spark, sf_dir)))
    return m.groupBy("batch_id").agg(F.concat_ws("\n", F.transform(
        F.array_sort(F.collect_list(F.struct("o_orderkey", "message"))), lambda x: x["message"])).alias("text"))


def split_messages(spark, sf_dir) -> DataFrame:
    """S11 + W9: batch texts → (message_id, batch_id, seq, message); seq is the
    1-based position in its batch, message_id = batch_id·8 + seq − 1."""
    b = fin_batches(spark, sf_dir)
    s = b.select("batch_id", F.posexplode(M.split_batch(F.col("text"))).alias("pos", "message"))
    return s.select((F.col("batch_id") * BATCH + F.col("pos")).alias("message_id"), "batch_id",
                    (F.col("pos") + 1).alias("seq"), "message")


def parsed_messages(spark, sf_dir) -> DataFrame:
    return M.parse_mt103(split_messages(spark, sf_dir))


# ---------------------------------------------------------------- oracle pieces
FIN_SQL = f"""
SELECT o_orderkey, CAST(floor(o_orderkey / {BATCH}) AS BIGINT) AS batch_id,
       CAST(floor(o_orderkey / {BATCH}) AS BIGINT) * {BATCH}
         + row_number() OVER (PARTITION BY floor(o_orderkey / {BATCH}) ORDER BY o_orderkey) - 1 AS message_id,
       'REF' || CAST(o_orderkey AS VARCHAR) AS ref,
       ['EUR', 'USD', 'CHF'][n_nationkey % 3 + 1] AS ccy,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amt,
       strftime(o_orderdate, '%y%m%d') AS yymmdd, strftime(o_orderdate, '%Y-%m-%d') AS ymd,
       'DE' || lpad(CAST(o_custkey AS VARCHAR), 20, '0') AS iban_d,
       'GB' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS iban_c,
       'BANK' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || 'XXX' AS bic_c,
       'BANKDE' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || 'X' AS bic_d,
       lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS nk2,
       c_name, n_name, o_orderpriority, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'SHA' WHEN 'O' THEN 'OUR' ELSE 'BEN' END AS charges,
       o_orderkey % 5 = 0 AS has_b3, o_orderkey % 7 = 0 AS has_b5, o_orderstatus = 'F' AS has_33b,
       substr(o_orderpriority, 1, 1) IN ('1', '2') AS has_53b, o_orderstatus <> 'P' AS has_77b
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
NL = "chr(10)"
VAL = {
    "20": "ref",
    "23B": "'CRED'",
    "32A": "yymmdd || ccy || replace(amt, '.', ',')",
    "33B": "CASE WHEN has_33b THEN ccy || replace(amt, '.', ',') END",
    "50K": f"'/' || iban_d || {NL} || c_name || {NL} || n_name",
    "53B": "CASE WHEN has_53b THEN '/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') END",
    "57A": "bic_c",
    "59": f"'/' || iban_c || {NL} || 'BENEF ' || CAST(o_orderkey AS VARCHAR)",
    "70": "'ORDER ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority",
    "71A": "charges",
    "77B": "CASE WHEN has_77b THEN '/REG/' || o_orderpriority END",
}
B1 = "'F01BANK' || nk2 || 'XXXX' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0')"
B2 = "'I103BANK' || nk2 || 'XXXXN'"
B3 = "CASE WHEN has_b3 THEN '{108:' || ref END"
B5 = "CASE WHEN has_b5 THEN '{CHK:' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END"
B4 = (f"{NL} || ':20:' || ref || {NL} || ':23B:CRED' || {NL} || ':32A:' || {VAL['32A']} || {NL} || "
      f"CASE WHEN has_33b THEN ':33B:' || {VAL['33B']} || {NL} ELSE '' END || ':50K:' || {VAL['50K']} || {NL} || "
      f"CASE WHEN has_53b THEN ':53B:' || {VAL['53B']} || {NL} ELSE '' END || ':57A:' || bic_c || {NL} || "
      f"':59:' || {VAL['59']} || {NL} || ':70:' || {VAL['70']} || {NL} || ':71A:' || charges || {NL} || "
      f"CASE WHEN has_77b THEN ':77B:' || {VAL['77B']} || {NL} ELSE '' END || '-'")


def _fin(body: str, **extra) -> str:
    return with_ctes(body, fin=FIN_SQL, **extra)


@register("mt103_split", _fin(
    f"SELECT message_id, batch_id, CAST(message_id - batch_id * {BATCH} + 1 AS INTEGER) AS seq, "
    f"'{{1:' || {B1} || '}}{{2:' || {B2} || '}}' || CASE WHEN has_b3 THEN '{{3:' || {B3} || '}}}}' ELSE '' END "
    f"|| '{{4:' || {B4} || '}}' || CASE WHEN has_b5 THEN '{{5:' || {B5} || '}}}}' ELSE '' END AS message FROM fin"))
def q_mt103_split(spark, sf_dir):
    """S11 + W9: FIN batch texts split into messages, numbered within the batch."""
    return split_messages(spark, sf_dir)


@register("mt103_blocks", _fin(
    f"SELECT message_id, {B1} AS block_1, {B2} AS block_2, {B3} AS block_3, {B4} AS block_4_raw, {B5} AS block_5 FROM fin"))
def q_mt103_blocks(spark, sf_dir):
    """M1: block contents; nested blocks 3 / 5 cut at their first ``}``."""
    p = parsed_messages(spark, sf_dir)
    b = lambda k: F.try_element_at(F.col("blocks"), F.lit(k))
    return p.select("message_id", b("1").alias("block_1"), b("2").alias("block_2"), b("3").alias("block_3"),
                    b("4").alias("block_4_raw"), b("5").alias("block_5"))


FIELDS_SQL = " UNION ALL ".join(
    f"SELECT message_id, '{tag}' AS tag, {expr} AS value FROM fin WHERE {expr} IS NOT NULL" for tag, expr in VAL.items())


@register("mt103_fields", _fin(FIELDS_SQL))
def q_mt103_fields(spark, sf_dir):
    """M2: one row per (message, tag, value)."""
    return M.field_rows(parsed_messages(spark, sf_dir))


DESC_SQL = case_map("tag", M.MT103_FIELD_DESCRIPTIONS)
BDESC_SQL = case_map("key", M.BLOCK_DESCRIPTIONS)


@register("mt103_long", _fin(f"""
SELECT message_id, 'field' AS kind, tag AS key, COALESCE({DESC_SQL}, 'Unknown MT103 field ' || tag) AS description, value
FROM ({FIELDS_SQL})
UNION ALL
SELECT message_id, 'block' AS kind, key, COALESCE({BDESC_SQL}, 'Unknown block ' || key) AS description, value FROM (
  SELECT message_id, '1' AS key, {B1} AS value FROM fin UNION ALL SELECT message_id, '2', {B2} FROM fin
  UNION ALL SELECT message_id, '3', {B3} FROM fin WHERE has_b3 UNION ALL SELECT message_id, '4_raw', {B4} FROM fin
  UNION ALL SELECT message_id, '5', {B5} FROM fin WHERE has_b5)
"""))
def q_mt103_long(spark, sf_dir):
    """M3: long form of fields and blocks with descriptions."""
    return M.long_form(parsed_messages(spark, sf_dir))


TYPED_COLS = ["message_id", "block_1", "block_2", "block_3", "block_5", "ref", "bank_op_code",
              "value_date_ccy_amount", "orig_amount", "exchange_rate", "ordering_customer",
              "beneficiary_customer", "senders_correspondent", "account_with_institution",
              "remittance_info", "charges", "regulatory"]
TYPED_SQL = (f"SELECT message_id, {B1} AS block_1, {B2} AS block_2, {B3} AS block_3, {B5} AS block_5, "
             f"{VAL['20']} AS ref, {VAL['23B']} AS bank_op_code, {VAL['32A']} AS value_date_ccy_amount, "
             f"{VAL['33B']} AS orig_amount, CAST(NULL AS VARCHAR) AS exchange_rate, {VAL['50K']} AS ordering_customer, "
             f"{VAL['59']} AS beneficiary_customer, {VAL['53B']} AS senders_correspondent, "
             f"{VAL['57A']} AS account_with_institution, {VAL['70']} AS remittance_info, {VAL['71A']} AS charges, "
             f"{VAL['77B']} AS regulatory FROM fin")


@register("mt103_typed", _fin(TYPED_SQL))
def q_mt103_typed(spark, sf_dir):
    """M4: typed record with 50K→50A→50F, 59→59A, 53B→53A→53D, 57A→B→C→D fallbacks."""
    return M.typed(parsed_messages(spark, sf_dir))


@register("mt103_summary", _fin(f"""
SELECT message_id, '[' || ref || '] ' || value_date_ccy_amount || ' | Sender: ' || split_part(ordering_customer, chr(10), 1)
       || ' → Benef: ' || split_part(beneficiary_customer, chr(10), 1) || ' | Charges: ' || charges AS summary
FROM t""", t=TYPED_SQL))
def q_mt103_summary(spark, sf_dir):
    """M5: one-line summary per message."""
    return M.summary(M.typed(parsed_messages(spark, sf_dir)))


WIDE_TAGS = sorted(VAL)


@register("mt103_wide", _fin(
    f"SELECT message_id, '103' AS mt_type, {B1} AS block_1, {B2} AS block_2, {B3} AS block_3, {B4} AS block_4_raw, "
    f"{B5} AS block_5, " + ", ".join(f'{VAL[t]} AS "{M.wide_column(t)}"' for t in WIDE_TAGS) + " FROM fin"))
def q_mt103_wide(spark, sf_dir):
    """One row per message, one ``f_<tag>_<slug>`` column per tag in the batch."""
    return M.wide(parsed_messages(spark, sf_dir))


# ------------------------------------------------------------------ pacs.008
def _xml_tx(p: DataFrame) -> Column:
    k = F.col("o_orderkey").cast("string")
    acct_d = F.when(F.pmod("o_orderkey", F.lit(2)) == 0,
                    F.concat(F.lit("<IBAN>"), F.col("iban_d"), F.lit("</IBAN>"))).otherwise(
        F.concat(F.lit("<Othr><Id>"), F.col("iban_d"), F.lit("</Id></Othr>")))
    chrg = (F.when(F.col("charges") == "SHA", F.lit("SHAR")).when(F.col("charges") == "OUR", F.lit("DEBT"))
            .otherwise(F.lit("CRED")))
    # every eleventh payment settles one unit less than instructed (a fee) → reconciliation flags it
    amount = F.when(F.pmod("o_orderkey", F.lit(11)) == 0,
                    (F.col("amt").cast("decimal(18,2)") - 1).cast("string")).otherwise(F.col("amt"))
    return F.concat(
        F.lit("<CdtTrfTxInf><PmtId><InstrId>"), F.col("ref"), F.lit("</InstrId><EndToEndId>E2E-"), F.col("ref"),
        F.lit("</EndToEndId><TxId>"), F.col("ref"), F.lit("</TxId><UETR>uetr-"), F.lpad(k, 12, "0"),
        F.lit("</UETR></PmtId><IntrBkSttlmAmt Ccy=\""), F.col("ccy"), F.lit("\">"), amount,
        F.lit("</IntrBkSttlmAmt><ChrgBr>"), chrg, F.lit("</ChrgBr><Dbtr><Nm>"), F.col("c_name"),
        F.lit("</Nm></Dbtr><DbtrAcct><Id>"), acct_d, F.lit("</Id></DbtrAcct><DbtrAgt><FinInstnId><BICFI>"),
        F.col("bic_d"), F.lit("</BICFI></FinInstnId></DbtrAgt><CdtrAgt><FinInstnId><BICFI>"), F.col("bic_c"),
        F.lit("</BICFI></FinInstnId></CdtrAgt><Cdtr><Nm>BENEF "), k,
        F.lit("</Nm></Cdtr><CdtrAcct><Id><IBAN>"), F.col("iban_c"),
        F.lit("</IBAN></Id></CdtrAcct><RmtInf><Ustrd>\n    ORDER "), k, F.lit(" "), F.col("o_orderpriority"),
        F.lit("\n  </Ustrd></RmtInf><Purp><Cd>"), F.substring("o_orderpriority", 3, 4),
        F.lit("</Cd></Purp></CdtTrfTxInf>"))


def pacs008_docs(spark, sf_dir) -> DataFrame:
    """One pacs.008 document per batch of ≤ 8 orders (default namespace)."""
    p = _pieces(_orders(spark, sf_dir))
    p = p.withColumn("tx", _xml_tx(p))
    g = p.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", "tx"))).alias("txs"), F.count(F.lit(1)).alias("n"),
        F.min("ymd").alias("sttl"), F.sum(F.col("amt").cast("decimal(18,2)")).alias("total"))
    bid = F.col("batch_id").cast("string")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<Document xmlns="urn:iso:std:iso:20022:tech:xsd:pacs.008.001.08">'
              "<FIToFICstmrCdtTrf><GrpHdr><MsgId>MSG-"), bid,
        F.lit("</MsgId><CreDtTm>2025-01-01T10:00:00</CreDtTm><NbOfTxs>"), F.col("n").cast("string"),
        F.lit("</NbOfTxs><TtlIntrBkSttlmAmt Ccy=\"EUR\">"), F.col("total").cast("string"),
        F.lit("</TtlIntrBkSttlmAmt><IntrBkSttlmDt>"), F.col("sttl"),
        F.lit("</IntrBkSttlmDt><InstgAgt><FinInstnId><BICFI>BANKSENDXXX</BICFI></FinInstnId></InstgAgt>"
              "<InstdAgt><FinInstnId><BICFI>BANKRECVXXX</BICFI></FinInstnId></InstdAgt></GrpHdr>"),
        F.array_join(F.transform("txs", lambda t: t["tx"]), ""),
        F.lit("</FIToFICstmrCdtTrf></Document>"))
    return g.select("batch_id", xml.alias("xml"))


def pacs008_flat(spark, sf_dir) -> DataFrame:
    return M.parse_pacs008(pacs008_docs(spark, sf_dir), keep=["batch_id"])


MX_SQL = f"""
SELECT f.*, 'MSG-' || CAST(batch_id AS VARCHAR) AS msg_id, '2025-01-01T10:00:00' AS created_at,
       min(ymd) OVER (PARTITION BY batch_id) AS settlement_date,
       CASE WHEN o_orderkey % 11 = 0 THEN CAST(CAST(amt AS DECIMAL(18,2)) - 1 AS VARCHAR) ELSE amt END AS mx_amount,
       CASE charges WHEN 'SHA' THEN 'SHAR' WHEN 'OUR' THEN 'DEBT' ELSE 'CRED' END AS charge_bearer,
       'ORDER ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS remittance_info,
       trim(substr(o_orderpriority, 3, 4)) AS purpose_code
FROM fin f
"""
FLAT_SQL = ("SELECT msg_id, created_at, settlement_date, ccy AS currency, mx_amount AS amount, ref AS tx_id, "
            "'E2E-' || ref AS end_to_end_id, 'uetr-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS uetr, "
            "charge_bearer, c_name AS debtor_name, iban_d AS debtor_iban, bic_d AS debtor_bic, bic_c AS creditor_bic, "
            "'BENEF ' || CAST(o_orderkey AS VARCHAR) AS creditor_name, iban_c AS creditor_iban, remittance_info, "
            "purpose_code FROM mx")


@register("pacs008_flat", _fin(FLAT_SQL, mx=MX_SQL))
def q_pacs008_flat(spark, sf_dir):
    """S12 + M8 + M9: pacs.008 documents → one row per transaction, header repeated, 17 columns."""
    return M.export_columns(pacs008_flat(spark, sf_dir))


@register("pacs008_header", _fin("""
SELECT DISTINCT 'MSG-' || CAST(batch_id AS VARCHAR) AS msg_id, CAST(sum(CAST(amt AS DECIMAL(18,2))) OVER (PARTITION BY batch_id) AS VARCHAR) AS total_amount,
       'EUR' AS total_currency, 'BANKSENDXXX' AS inst_agent_bic, 'BANKRECVXXX' AS instr_agent_bic FROM fin
"""))
def q_pacs008_header(spark, sf_dir):
    """M8 typed-only group-header fields (totals and agents), one row per document."""
    return pacs008_flat(spark, sf_dir).select("msg_id", "total_amount", "total_currency", "inst_agent_bic",
                                              "instr_agent_bic").distinct()


MAP_ROWS = [(mt, mx, c or "currency || ' ' || amount") for mt, mx, c in M.MT_MX_FIELDS]


@register("mx_field_map", _fin(" UNION ALL ".join(
    f"SELECT tx_id AS tx_ref, '{mt}' AS mt_field, '{mx}' AS mx_field, {expr} AS value FROM flat"
    for mt, mx, expr in MAP_ROWS), mx=MX_SQL, flat=FLAT_SQL))
def q_mx_field_map(spark, sf_dir):
    """13 (MT field, MX field, value) rows per transaction."""
    return M.field_map(pacs008_flat(spark, sf_dir).where(~F.col("_invalid")))


@register("mt_mx_reconcile", _fin("""
SELECT COALESCE(mt.ref, mx.ref) AS reference, mt.ref IS NOT NULL AS in_mt, mx.ref IS NOT NULL AS in_mx,
       two AND mt.o_orderkey % 11 <> 0 AS amount_ok, two AS currency_ok, two AS charges_ok, two AS debtor_iban_ok,
       two AS creditor_iban_ok, two AS creditor_bic_ok, two AS remittance_ok
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'MT' ELSE '' END || ref AS ref FROM fin) mt
FULL OUTER JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'MX' ELSE '' END || ref AS ref FROM fin) mx ON mt.ref = mx.ref,
LATERAL (SELECT mt.ref IS NOT NULL AND mx.ref IS NOT NULL AS two) b"""))
def q_mt_mx_reconcile(spark, sf_dir):
    """MT103 ⟗ pacs.008 on reference with per-field agreement flags. Some references
    differ between the formats, so both sides have rows that the other lacks."""
    def renamed(df, column, every, prefix):
        number = F.regexp_extract(column, r"(\d+)$", 1).cast("long")
        return df.withColumn(column, F.when(number % every == 0, F.concat(F.lit(prefix), F.col(column))).otherwise(F.col(column)))
    mt = renamed(M.typed(parsed_messages(spark, sf_dir)), "ref", 13, "MT")
    mx = renamed(pacs008_flat(spark, sf_dir).where(~F.col("_invalid")), "tx_id", 17, "MX")
    return M.reconcile(mt, mx)


FILE_ORDERS = 4096  # order keys a file


def _pacs008_files(spark, sf_dir, damage: bool = False) -> str:
    """pacs.008 files of up to FILE_ORDERS transactions, a line each; with ``damage`` most lack something."""
    p = _pieces(_orders(spark, sf_dir)).withColumn("file_no", F.floor(F.col("o_orderkey") / FILE_ORDERS).cast("long"))
    kind = F.col("file_no") % 5 if damage else F.lit(0)
    g = p.groupBy("file_no").agg(F.min("ymd").alias("sttl"), F.sum(F.col("amt").cast("decimal(18,2)")).alias("total"))
    root = F.when(kind == 1, F.lit("FIToFIPmtStsRpt")).otherwise(F.lit("FIToFICstmrCdtTrf"))
    header = F.when(kind == 2, F.lit("")).otherwise(F.concat(
        F.lit("<GrpHdr><MsgId>FILE-"), F.col("file_no").cast("string"), F.lit('</MsgId><CreDtTm>2025-01-01T10:00:00</CreDtTm><TtlIntrBkSttlmAmt Ccy="EUR">'),
        F.col("total").cast("string"), F.lit("</TtlIntrBkSttlmAmt><IntrBkSttlmDt>"), F.col("sttl"), F.lit("</IntrBkSttlmDt></GrpHdr>")))
    first = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<Document xmlns="urn:iso:std:iso:20022:tech:xsd:pacs.008.001.08"><'), root, F.lit(">"), header)
    tx = _xml_tx(p) if not damage else F.when(F.pmod("o_orderkey", F.lit(97)) == 5, F.regexp_replace(_xml_tx(p), "</Nm>", "")).otherwise(_xml_tx(p))
    last = F.concat(F.lit("</"), root, F.lit("></Document>"))
    lines = (g.select("file_no", F.lit(-1).cast("long").alias("at"), first.alias("value"))
             .unionByName(p.where(kind != 3).select("file_no", F.col("o_orderkey").cast("long").alias("at"), tx.alias("value")))
             .unionByName(g.select("file_no", F.lit(2**62).alias("at"), last.alias("value"))))
    if damage:
        lines = lines.withColumn("value", F.when(F.col("file_no") % 5 == 4, F.lit(" ")).otherwise(F.col("value")))
    path = scratch_path(spark, f"pacs008-{uuid.uuid4().hex}")
    lines.repartition("file_no").sortWithinPartitions("file_no", "at").select("file_no", "value").write.partitionBy("file_no").text(path)
    return path


FILE_MX_SQL = MX_SQL.replace("'MSG-' || CAST(batch_id AS VARCHAR)", f"'FILE-' || CAST(o_orderkey // {FILE_ORDERS} AS VARCHAR)").replace(
    "PARTITION BY batch_id", f"PARTITION BY o_orderkey // {FILE_ORDERS}")


@register("pacs008_file", _fin(FLAT_SQL, mx=FILE_MX_SQL))
def q_pacs008_file(spark, sf_dir):
    """S12 + M8 + M9: files of thousands of transactions, read transaction by transaction, 17 columns."""
    return PF.read_pacs008(spark, _pacs008_files(spark, sf_dir)).transactions.select(*M.PACS008_COLUMNS)


@register("pacs008_file_rejects", _fin(f"""
SELECT n AS file_no, CASE n % 5 WHEN 1 THEN 'no FIToFICstmrCdtTrf' WHEN 2 THEN 'no GrpHdr' WHEN 3 THEN 'no CdtTrfTxInf' ELSE 'empty' END AS reason, NULL AS tx
FROM (SELECT DISTINCT o_orderkey // {FILE_ORDERS} AS n FROM fin) WHERE n % 5 <> 0
UNION ALL
SELECT o_orderkey // {FILE_ORDERS}, 'broken CdtTrfTxInf', ref FROM fin WHERE (o_orderkey // {FILE_ORDERS}) % 5 < 3 AND o_orderkey % 97 = 5
"""))
def q_pacs008_file_rejects(spark, sf_dir):
    """Files that give no transaction, with the reason, and single broken transactions."""
    found = PF.read_pacs008(spark, _pacs008_files(spark, sf_dir, damage=True))
    file_no = F.regexp_extract("file", "file_no=([0-9]+)", 1).cast("long").alias("file_no")
    return found.rejects.select(file_no, "reason", F.lit(None).cast("string").alias("tx")).unionByName(
        found.broken.select(file_no, F.lit("broken CdtTrfTxInf").alias("reason"), F.regexp_extract("xml", "<TxId>(.*?)</TxId>", 1).alias("tx")))


@register("pacs008_rejects", _fin("""
SELECT batch_id, CASE batch_id % 4 WHEN 1 THEN 'no FIToFICstmrCdtTrf' WHEN 2 THEN 'no GrpHdr' ELSE 'empty' END AS reason
FROM (SELECT DISTINCT batch_id FROM fin) WHERE batch_id % 4 <> 0
"""))
def q_pacs008_rejects(spark, sf_dir):
    """Documents without a transfer, without a header, and empty ones, with the reason."""
    docs = pacs008_docs(spark, sf_dir)
    kind = F.col("batch_id") % 4
    xml = (F.when(kind == 0, F.col("xml")).when(kind == 1, F.regexp_replace("xml", "FIToFICstmrCdtTrf", "FIToFIPmtStsRpt"))
           .when(kind == 2, F.regexp_replace("xml", "(?s)<GrpHdr>.*</GrpHdr>", "")).otherwise(F.lit(" ")))
    return M.pacs008_rejects(docs.withColumn("xml", xml), keep=["batch_id"])
