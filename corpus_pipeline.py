"""A corpus pipeline of the library's training-data operators.

``STAGES`` names the steps; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again before the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import bpe, minhash, mixing, pii, quality
from lakeloom.llm.common import documents, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the perplexity bands reject go."""
    return quality.quality_rules(docs, carry=COLUMNS).filter("kept").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group stays, once; so do groups without any doc_id."""
    judged = minhash.near_duplicates(docs)
    stays = judged.filter("kept or component_id is null").select(F.col("doc_id").alias("_doc"), F.col("_version")).distinct()
    rows = docs.withColumn("_text_version", F.coalesce(F.xxhash64("text"), F.lit(0)))
    same = rows["doc_id"].eqNullSafe(stays["_doc"]) & (rows["_text_version"] == stays["_version"])
    return rows.join(stays, same, "left_semi").dropDuplicates(["doc_id", "_text_version"]).select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked."""
    found = pii.find_pii(docs, carry=COLUMNS)
    return found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document for each round that draws from it, with the words drawn."""
    return mixing.mixed_documents(docs, COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) and digests of every document of the mixture."""
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_stage), ("near duplicates", near_duplicate_stage), ("personal data", pii_stage),
          ("source mixture", mixing_stage), ("token ids", encoding_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, "pipeline-" + name.replace(" ", "-"))
    return docs


#: No SQL form: the stages hash, draw and tokenise; the tests hold them against plain versions.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE = {}
