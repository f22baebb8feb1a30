"""pacs.008 files of any size (S12, M8, M9): a document is read transaction by transaction.

The text source cuts files at the end of the transactions' tags, so that one
record holds one transaction, whatever the size of its document, and Spark
splits a file between any two of them. The first record of a document holds
its group header as well. Headers, one a file, then join their transactions.

A file is one document, as in a batch of them. Prefixed and default namespaces
are read alike. What gives no transaction is listed with a reason: by file
(``empty``, ``no FIToFICstmrCdtTrf``, ``no GrpHdr``, ``no CdtTrfTxInf``) and, for
single transactions whose XML is broken, by file with the text. Spark's sources
show no file of zero bytes, so that is not listed; one of blanks is ``empty``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import messages as M
from lakeloom.session import written

_DOCUMENT = M.PACS008_SCHEMA["FIToFICstmrCdtTrf"].dataType
HEADER, TRANSACTION = _DOCUMENT["GrpHdr"].dataType, _DOCUMENT["CdtTrfTxInf"].dataType.elementType
TAG, _PREFIX = "CdtTrfTxInf", r"(?:[A-Za-z_][\w.-]*:)?"
_BROKEN = "_broken"
_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}


def _element(text: Column, tag: str, schema: T.StructType) -> Column:
    """What stands inside an element, parsed; of broken XML the raw text stays in ``_broken``."""
    broken = T.StructType([*schema, T.StructField(_BROKEN, T.StringType())])
    return F.from_xml(F.concat(F.lit(f"<{tag}>"), text, F.lit(f"</{tag}>")), broken, _OPTIONS)


@dataclass
class PacsFiles:
    """Transactions (file and all columns), rejected files (file, reason), broken transactions (file, xml)."""

    transactions: DataFrame
    rejects: DataFrame
    broken: DataFrame


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, text, inside, value: pieces of the documents. ``inside`` tells pieces that end a transaction from others,
    ``text`` is the transaction's content; a piece's ``value`` may hold the header ahead of it."""
    # The separator ends an opening tag without attributes and a closing tag, whatever their prefix.
    pieces = spark.read.option("lineSep", f"{TAG}>").option("recursiveFileLookup", "true").text(path)
    # The end is what follows the last "</"; only the few pieces that name the tag still are searched for its opening.
    end = F.substring_index("value", "</", -1)
    inside = F.col("value").contains("</") & end.rlike(f"^{_PREFIX}$")
    content = F.concat(F.left("value", F.length("value") - F.length(end) - 2), F.regexp_replace(end, f"^{_PREFIX}$", ""))
    text = (F.when(inside & F.col("value").contains(TAG), F.regexp_replace(content, rf"(?s)^.*<{_PREFIX}{TAG}\s[^>]*>", ""))
            .when(inside, content).otherwise(F.col("value")))
    return pieces.select(F.col("_metadata.file_path").alias("file"), text.alias("text"), inside.alias("inside"), "value")


def read_pacs008(spark: SparkSession, path: str) -> PacsFiles:
    """The files below a path, each read once."""
    pieces = read_records(spark, path)
    header = F.regexp_extract("value", rf"(?s)<{_PREFIX}GrpHdr(?:\s[^>]*)?>(.*)</{_PREFIX}GrpHdr>", 1)
    parsed = pieces.select("file", "inside", "text",
                           F.col("value").contains("FIToFICstmrCdtTrf").alias("root"), (~F.col("value").contains("<") & F.col("value").rlike(r"^\s*$")).alias("blank"),
                           F.when(F.col("value").contains("GrpHdr>"), _element(header, "GrpHdr", HEADER)).alias("header"),
                           F.when(F.col("inside"), _element(F.col("text"), TAG, TRANSACTION)).alias("tx"))
    broken = F.col("tx")[_BROKEN].isNotNull()
    own = M.own_columns(F.col("tx"))
    parsed = written(parsed.select("file", "inside", "root", "blank", F.when(F.col("header")[_BROKEN].isNull(), F.col("header").dropFields(_BROKEN)).alias("header"),
                                   *[e.alias(c) for c, e in own.items()], F.when(broken, F.col("text")).alias("xml")), "pacs008-pieces")
    files = parsed.groupBy("file").agg(F.max("root").alias("root"), F.first("header", ignorenulls=True).alias("header"), F.count_if("inside").alias("n"),
                                      F.min("blank").alias("blank"))
    reason = (F.when(F.col("blank"), F.lit("empty")).when(~F.col("root"), F.lit("no FIToFICstmrCdtTrf"))
              .when(F.col("header").isNull(), F.lit("no GrpHdr")).when(F.col("n") == 0, F.lit("no CdtTrfTxInf")))
    good = files.where(reason.isNull()).select("file", "header")
    found = M.header_columns(F.col("header"))
    rows = (parsed.where(F.col("inside") & F.col("xml").isNull()).drop("header", "root", "blank").join(good, "file")
            .select("file", *[(found[c] if c in found else F.col(c)).alias(c) for c in [*M.PACS008_COLUMNS, *M.TYPED_ONLY]]))
    rejects = files.select("file", reason.alias("reason")).where("reason is not null")
    return PacsFiles(rows, rejects, parsed.where("xml is not null").select("file", "xml"))
