"""pacs.008 files read transaction by transaction."""

import os

import pytest

from lakeloom.operators import messages as M
from lakeloom.operators import pacs_files as PF

from test_messages import NO_NS, XML


def prefixed(xml):
    import re
    return re.sub(r"<(/?)([A-Za-z])", r"<\1doc:\2", xml.split("?>", 1)[1])


@pytest.fixture()
def folder(tmp_path):
    files = {"plain.xml": NO_NS, "namespace.xml": XML, "prefix.xml": prefixed(NO_NS), "attribute.xml": NO_NS.replace("<CdtTrfTxInf>", '<CdtTrfTxInf Id="7">'),
             "blank.xml": " \n", "other.xml": "<Other><X>1</X></Other>", "bare.xml": NO_NS.replace("GrpHdr", "Hdr"),
             "none.xml": "<Document><FIToFICstmrCdtTrf><GrpHdr><MsgId>a</MsgId></GrpHdr></FIToFICstmrCdtTrf></Document>",
             "broken.xml": NO_NS.replace("<TxId>P2</TxId>", "<TxId>P2")}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return tmp_path


def test_files_give_what_whole_documents_give(spark, folder):
    found = PF.read_pacs008(spark, str(folder))
    rows = [r.asDict() for r in found.transactions.collect()]
    expected = [tuple(r) for r in M.parse_pacs008(spark.createDataFrame([(XML,)], "xml string")).drop("_invalid").collect()]
    by_file = {}
    for r in rows:
        by_file.setdefault(os.path.basename(r.pop("file")), []).append(tuple(r.values()))
    assert set(by_file) == {"plain.xml", "namespace.xml", "prefix.xml", "attribute.xml", "broken.xml"}
    for name, got in by_file.items():
        assert sorted(got) == sorted(expected if name != "broken.xml" else expected[:1]), name


def test_rejects(spark, folder):
    found = PF.read_pacs008(spark, str(folder))
    assert {os.path.basename(r.file): r.reason for r in found.rejects.collect()} == {
        "blank.xml": "empty", "other.xml": "no FIToFICstmrCdtTrf", "bare.xml": "no GrpHdr", "none.xml": "no CdtTrfTxInf"}
    assert [(os.path.basename(r.file), "P2" in r.xml) for r in found.broken.collect()] == [("broken.xml", True)]


def test_one_document_in_many_splits(spark, tmp_path):
    head, rest = NO_NS.split("<CdtTrfTxInf>", 1)
    one = "<CdtTrfTxInf>" + rest.split("</CdtTrfTxInf>")[0] + "</CdtTrfTxInf>"
    (tmp_path / "large.xml").write_text(head + "".join(one.replace("P1", f"T{i}") for i in range(5000)) + "</FIToFICstmrCdtTrf></Document>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        pieces = PF.read_records(spark, str(tmp_path))
        assert pieces.rdd.getNumPartitions() > 10
        rows = PF.read_pacs008(spark, str(tmp_path)).transactions.select("msg_id", "tx_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.tx_id for r in rows) == sorted(f"T{i}" for i in range(5000)) and {r.msg_id for r in rows} == {"HDR/5"}


def test_ends_of_pieces(spark, tmp_path):
    tag = "CdtTrfTxInf>"
    pieces = ["<a/></", "x</doc:", "</", "</\n", "<" + tag[:-1] + ' Id="7"><b/></p:', "<n>1</n>", "", "p:", "<c></c", "</d></e:f"]
    (tmp_path / "a.xml").write_text(tag.join(pieces))
    records = PF.read_records(spark, str(tmp_path))
    got = {r.value: (r.inside, r.text) for r in records.collect()}
    assert got == {"<a/></": (True, "<a/>"), "x</doc:": (True, "x"), "</": (True, ""), "</\n": (True, "\n"), pieces[4]: (True, "<b/>"),
                   "<n>1</n>": (False, "<n>1</n>"), "": (False, ""), "p:": (False, "p:"), "<c></c": (False, "<c></c"), "</d></e:f": (False, "</d></e:f")}
    assert "Contains(value" in records._jdf.queryExecution().optimizedPlan().toString()  # only these are searched for an opening tag
