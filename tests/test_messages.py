import os
import random
import re

from pyspark.sql import functions as F

from lakeloom.operators import messages as M

MSG1 = ("{1:F01NORDNOKKAXXX0000000017}{2:I103LUSOPTPLXXXXN}{3:{108:BATCH-9}}{4:\n:20:PAY/77-K\n:23B:SPAY\n"
        ":32A:310930NOK50,\n:36:1,25\n:50K:/NO8330001234567\nFJELL OG FJORD AS\nHAVNEGATA 12\nBERGEN\n"
        ":53B:/99-17\n:57A:LUSOPTPLXXX\n:59:/PT50002700000001234567833\nCASA DO RIO LDA\n"
        ":70:BOATS, TWO\n:71A:OUR\n:77B:/BENEFRES/PT\n-}{5:{MAC:0F}}")
MSG2 = ("{1:F01KENYKENAXXXX0000000003}{2:I103THAITHBKXXXXN}{4:\n:20:Z-1\n:32A:320229KES7,005\n"
        ":50A:\n:50F:/KE55\nAMANI TEA\n:59A:THAITHBK\n:70:GATE OPENS 09:45:10 SHARP\n:70:LAST WINS\n-}")


def parsed(spark):
    df = spark.createDataFrame([(1, MSG1), (2, MSG2)], "message_id long, message string")
    return M.parse_mt103(df)


def test_blocks_and_fields(spark):
    rows = {r.message_id: r for r in parsed(spark).collect()}
    b = rows[1].blocks
    assert b["1"] == "F01NORDNOKKAXXX0000000017" and b["3"] == "{108:BATCH-9" and b["5"] == "{MAC:0F"
    f = rows[1].fields
    assert f["50K"] == "/NO8330001234567\nFJELL OG FJORD AS\nHAVNEGATA 12\nBERGEN" and f["77B"] == "/BENEFRES/PT"
    assert len(f) == 11
    f2 = rows[2].fields
    # the tag pattern matches anywhere: "09:45:10" yields tag 45; a repeated tag keeps the last value
    assert f2["45"] == "10 SHARP" and f2["70"] == "LAST WINS" and f2["50A"] == ""


def test_fields_of_odd_text(spark):
    """Tags that touch, repeat, end the text or hold nothing: what a scan from the left finds."""
    rng = random.Random(5)
    parts = [":20:", ":32A:", ":30", ":7", ":", " ", "\n", "\t", "12:30:45", "A", "-", "\n-", "é", "20:", ":20:\n:21:"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300)] + ["", " \n", "-", ":20:", ":20::21:x", ":20:30:40:"]
    rows = [(k, "{1:A}{4:" + t + "}{1:B}") for k, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "{4:\n:20:open"), (1003, "{9:}{9:x}{9:y}")]
    got = {r.message_id: (r.blocks, r.fields) for r in M.parse_mt103(spark.createDataFrame(rows, "message_id long, message string")).collect()}
    for k, t in enumerate(texts):
        body = re.sub(r"\s*-$", "", t.strip(" \t\n"))
        pairs = re.findall(r"\s*:(\d{2}[A-Z]?):(.*?)(?=\s*:\d{2}[A-Z]?:|\Z)", body, re.S)
        assert got[k] == ({"1": "B", "4": t}, {tag: v.strip(" \t\n") for tag, v in pairs}), t
    assert got[1000] == (None, {}) and got[1001] == ({}, {}) and got[1002] == ({}, {}) and got[1003] == ({"9": "y"}, {})
    fields = M.field_rows(M.parse_mt103(spark.createDataFrame(rows, "message_id long, message string")))
    assert fields.count() == sum(len(f) for _, f in got.values())


def test_typed_fallbacks_and_summary(spark):
    t = {r.message_id: r for r in M.typed(parsed(spark)).collect()}
    assert t[1].ordering_customer.startswith("/NO83") and t[1].senders_correspondent == "/99-17"
    assert t[2].ordering_customer == "/KE55\nAMANI TEA"  # empty 50A falls through to 50F
    assert t[2].beneficiary_customer == "THAITHBK" and t[2].charges is None
    s = {r.message_id: r.summary for r in M.summary(M.typed(parsed(spark))).collect()}
    assert s[1] == "[PAY/77-K] 310930NOK50, | Sender: /NO8330001234567 → Benef: /PT50002700000001234567833 | Charges: OUR"
    assert s[2].endswith("Charges: ?")


def test_long_and_wide(spark):
    lf = M.long_form(parsed(spark))
    unknown = {r.description for r in lf.where(F.col("key") == "45").collect()}
    assert unknown == {"Unknown MT103 field 45"}
    assert lf.where((F.col("kind") == "block") & (F.col("key") == "4_raw")).count() == 2
    w = M.wide(parsed(spark))
    assert w.columns[:7] == M.BASE_WIDE_COLUMNS
    assert "f_32A_Value_Date_Currency_Interbank_Settled_Amount" in w.columns
    assert w.columns[7:] == sorted(w.columns[7:])


def test_read_fin_batch(spark, tmp_path):
    p = tmp_path / "batch.fin"
    p.write_bytes((MSG1 + "\n" + MSG2 + "\n").replace("\n", "\r\n").encode())
    df = M.read_fin_batch(spark, str(p)).orderBy("_ord").collect()
    assert len(df) == 2 and df[0].message.startswith("{1:F01NORDNOKK") and df[1].message.startswith("{1:F01KENYKENA")
    assert "\r" not in df[0].message and not df[1].message.endswith("\n")


def test_split_batch_column(spark):
    df = spark.createDataFrame([("junk line\n" + MSG1 + "\n" + MSG2,)], "t string")
    parts = df.select(F.posexplode(M.split_batch(F.col("t")))).collect()
    assert [p.pos for p in parts] == [0, 1] and parts[0].col == MSG1


XML = """<?xml version="1.0" encoding="UTF-8"?>
<Document xmlns="urn:iso:std:iso:20022:tech:xsd:pacs.008.001.08"><FIToFICstmrCdtTrf>
 <GrpHdr><MsgId> HDR/5 </MsgId><CreDtTm>2031-09-30T06:30:00</CreDtTm><NbOfTxs>2</NbOfTxs>
  <TtlIntrBkSttlmAmt Ccy="NOK">57.005</TtlIntrBkSttlmAmt><IntrBkSttlmDt>2031-09-30</IntrBkSttlmDt>
  <InstgAgt><FinInstnId><BICFI>NORDNOKKXXX</BICFI></FinInstnId></InstgAgt></GrpHdr>
 <CdtTrfTxInf><PmtId><EndToEndId>E-77</EndToEndId><TxId>P1</TxId><UETR>0-0-1</UETR></PmtId>
  <IntrBkSttlmAmt Ccy="NOK">50.00</IntrBkSttlmAmt><ChrgBr>DEBT</ChrgBr><Dbtr><Nm>Fjell og Fjord</Nm></Dbtr>
  <DbtrAcct><Id><IBAN>NO83</IBAN></Id></DbtrAcct><Cdtr><Nm>Casa do Rio</Nm></Cdtr>
  <CdtrAcct><Id><Othr><Id>PT-50</Id></Othr></Id></CdtrAcct><RmtInf><Ustrd>
     TWO BOATS </Ustrd></RmtInf></CdtTrfTxInf>
 <CdtTrfTxInf><PmtId><TxId>P2</TxId></PmtId><IntrBkSttlmAmt Ccy="KES">7.005</IntrBkSttlmAmt></CdtTrfTxInf>
</FIToFICstmrCdtTrf></Document>"""
NO_NS = XML.replace(' xmlns="urn:iso:std:iso:20022:tech:xsd:pacs.008.001.08"', "")


def test_pacs008_flatten(spark):
    docs = spark.createDataFrame([(1, XML), (2, NO_NS), (3, "<Other><X>1</X></Other>")], "id int, xml string")
    flat = M.parse_pacs008(docs, keep=["id"])
    rows = {(r.id, r.tx_id): r for r in flat.collect()}
    r = rows[(1, "P1")]
    assert (r.msg_id, r.currency, r.amount, r.debtor_iban, r.creditor_iban, r.remittance_info) == (
        "HDR/5", "NOK", "50.00", "NO83", "PT-50", "TWO BOATS")
    assert (r.total_amount, r.total_currency, r.inst_agent_bic, r.instr_agent_bic) == ("57.005", "NOK", "NORDNOKKXXX", None)
    assert rows[(1, "P2")].currency == "KES" and rows[(1, "P2")].debtor_name is None
    assert (2, "P1") in rows  # no namespace accepted as well
    assert rows[(3, None)]._invalid
    out = M.export_columns(flat)
    assert out.columns == M.PACS008_COLUMNS and out.count() == 4
    assert M.field_map(flat.where(~F.col("_invalid"))).count() == 4 * 13


def test_pacs008_rejects(spark):
    docs = [(1, XML), (2, None), (3, "  "), (4, "<Other><X>1</X></Other>"), (5, "<Document><FIToFICstmrCdtTrf><CdtTrfTxInf/></FIToFICstmrCdtTrf></Document>"),
            (6, "<Document><FIToFICstmrCdtTrf><GrpHdr><MsgId>a</MsgId></GrpHdr></FIToFICstmrCdtTrf></Document>")]
    got = {r.id: r.reason for r in M.pacs008_rejects(spark.createDataFrame(docs, "id int, xml string"), keep=["id"]).collect()}
    assert got == {2: "empty", 3: "empty", 4: "no FIToFICstmrCdtTrf", 5: "no GrpHdr", 6: "no CdtTrfTxInf"}


def test_text_ahead_of_the_first_message(spark, tmp_path):
    from lakeloom.plans.fin_job import numbered_messages
    (tmp_path / "junk.fin").write_text("junk\n\n" + MSG1 + "\n" + MSG2)
    (tmp_path / "only.fin").write_text("no message here\n")
    got = sorted((r.message_id, r.message) for r in numbered_messages(spark, str(tmp_path)).collect())
    assert got == [(1, MSG1), (2, MSG2)]


def test_reconcile(spark):
    mt = M.typed(parsed(spark)).where(F.col("message_id") == 1)
    mx = spark.createDataFrame([("PAY/77-K", "50.00", "NOK", "DEBT", "NO8330001234567",
                                 "PT50002700000001234567833", "LUSOPTPLXXX", "BOATS, TWO"),
                                ("ONLY-MX", "1", "EUR", "DEBT", None, None, None, None)],
                               "tx_id string, amount string, currency string, charge_bearer string, debtor_iban string, "
                               "creditor_iban string, creditor_bic string, remittance_info string")
    r = {x.reference: x for x in M.reconcile(mt, mx).collect()}
    a = r["PAY/77-K"]
    assert a.in_mt and a.in_mx and a.amount_ok and a.charges_ok and a.debtor_iban_ok and a.creditor_iban_ok
    assert not r["ONLY-MX"].in_mt and r["ONLY-MX"].amount_ok is False


def test_fin_batch_job(spark, tmp_path):
    from lakeloom.plans.fin_job import run_fin_batch
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.fin").write_text(MSG1 + "\n" + MSG2 + "\n")
    (src / "b.fin").write_text(MSG2 + "\n")
    out = run_fin_batch(spark, str(src), str(tmp_path / "out"))
    wide = spark.read.option("header", "true").option("multiLine", "true").csv(out["wide"])
    assert wide.count() == 3 and sorted(int(r.message_id) for r in wide.collect()) == [1, 1, 2]
    assert spark.read.option("header", "true").option("multiLine", "true").csv(out["typed"]).count() == 3


def test_numbering_across_splits(spark, tmp_path):
    from lakeloom.plans.fin_job import numbered_messages
    msgs = [MSG2.replace(":20:Z-1", f":20:REF{i:04d}") for i in range(40)]
    (tmp_path / "big.fin").write_text("\n".join(msgs) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")  # the file spans several splits
    try:
        df = numbered_messages(spark, str(tmp_path / "big.fin"))
        assert df.rdd.getNumPartitions() >= 1
        typed = M.typed(M.parse_mt103(df)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r.message_id, r.ref) for r in typed)
    assert got == [(i + 1, f"REF{i:04d}") for i in range(40)]


def test_documents_are_parsed_once_under_a_filter(spark):
    docs = [(1, XML), (2, "<Document><FIToFICstmrCdtTrf><GrpHdr><MsgId>a</MsgId></GrpHdr></FIToFICstmrCdtTrf></Document>"),
            (3, "<Document><FIToFICstmrCdtTrf><CdtTrfTxInf><PmtId><TxId>x</TxId></PmtId></CdtTrfTxInf></FIToFICstmrCdtTrf></Document>"), (4, None)]
    flat = M.parse_pacs008(spark.createDataFrame(docs, "id int, xml string"), keep=["id"])
    assert sorted((r.id, r._invalid, r.tx_id or "") for r in flat.collect()) == [(1, False, "P1"), (1, False, "P2"), (2, False, ""), (3, True, "x"), (4, True, "")]
    valid = flat.where(~F.col("_invalid"))
    assert sorted((r.id, r.tx_id or "") for r in valid.collect()) == [(1, "P1"), (1, "P2"), (2, "")]
    for df in (valid, M.field_map(valid)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1


def test_numbering_moves_no_messages(spark, tmp_path):
    from lakeloom.plans.fin_job import numbered_messages
    (tmp_path / "a.fin").write_text("junk\n" + MSG1 + "\n" + MSG2 + "\n")
    df = numbered_messages(spark, str(tmp_path))
    assert sorted((r.message_id, r.message) for r in df.collect()) == [(1, MSG1), (2, MSG2)]
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in p and "SortMergeJoin" not in p


def test_fin_batch_job_writes_what_it_needs(spark, tmp_path, monkeypatch):
    from lakeloom.plans import fin_job
    kept, written = [], fin_job.written
    monkeypatch.setattr(fin_job, "written", lambda df, name: kept.append(df.columns) or written(df, name))
    monkeypatch.setattr(M, "written", lambda df, name: kept.append(name) or written(df, name))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fin").write_text(MSG1 + "\n" + MSG2 + "\n")
    out = fin_job.run_fin_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert kept == [["message_id", "blocks", "fields"]]  # once, without the messages' text
    for folder in out.values():
        names = [f for f in os.listdir(folder) if f.startswith("part-")]
        assert names and all(f.endswith(".csv.gz") for f in names)
        assert spark.read.option("header", "true").option("multiLine", "true").csv(folder).count() == 2


def test_tags_are_split_once(spark):
    text = "{1:A}{4:\n:20:X - -\n-}", "{4:\n:20:X\n :70:a:12:30:45\n:20:Y -}", "{4:-}", "{1:}{4::20:\r\n:21:q}"
    df = M.field_rows(M.parse_mt103(spark.createDataFrame(list(enumerate(text)), "message_id int, message string")))
    assert sorted(map(tuple, df.collect())) == [(0, "20", "X - -"), (1, "12", "30:45"), (1, "20", "Y"), (1, "70", "a"), (3, "20", ""), (3, "21", "q")]
    assert df._jdf.queryExecution().optimizedPlan().toString().count(M.TAG_PATTERN + ", -1)") == 1
