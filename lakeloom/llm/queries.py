"""Registered queries of the operators: each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import ann, bpe, html_text, licenses, minhash, mixing, periodic, pii, positional, quality, shuffling, spelling, substrings
from lakeloom.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


@_query("op1_multi_index_hashing")
def op1(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(vectors, vectors.filter("vec_id % 50 = 0"))


@_query("op2_bpe")
def op2(spark, sf_dir):
    return bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False).drop("ids")


@_query("op3_quality_rules")
def op3(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir))


@_query("op4_html_text")
def op4(spark, sf_dir):
    return html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
REPEATS_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS rn FROM k) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, range(20) r(j)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS t, count(*) AS n FROM x ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i GROUP BY x.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""


@_query("op5_substring_dedup", REPEATS_SQL)
def op5(spark, sf_dir):
    return substrings.remove_repeated(documents(spark, sf_dir), with_text=False).drop("kept_text")


@_query("op6_mixing")
def op6(spark, sf_dir):
    return mixing.taken(documents(spark, sf_dir))


@_query("op7_licence_scan", licenses.oracle_sql())
def op7(spark, sf_dir):
    return licenses.licences(documents(spark, sf_dir))


@_query("op8_hypergeometric_shuffle")
def op8(spark, sf_dir):
    return shuffling.shard_documents(documents(spark, sf_dir))


GROUPS_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS_SQL.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * both_ >= 75 * (x.n + y.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, node) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.node = e.a),
m AS (SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d JOIN m ON d.doc_id = m.doc_id LEFT JOIN n ON d.doc_id = n.doc_id"""


@_query("op9_minhash", GROUPS_SQL)
def op9(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir)).drop("_version")


@_query("op10_pii")
def op10(spark, sf_dir):
    return pii.find_pii(documents(spark, sf_dir), redacted=False).drop("redacted", "scores")


@_query("op11_positional_index", positional.oracle_sql())
def op11(spark, sf_dir):
    return positional.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_query("op12_spelling")
def op12(spark, sf_dir):
    return spelling.spelling_variants(documents(spark, sf_dir), misspell=True)


@_query("op13_periodic_runs")
def op13(spark, sf_dir):
    return periodic.periodic_runs(documents(spark, sf_dir), rewrite=True, with_text=False).drop("runs", "collapsed")
