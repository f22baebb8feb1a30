"""Operator 11: benchmark decontamination by a distributed positional inverted index, in DataFrame functions.

1. ``build_index`` writes one posting (document, position, term) for every word
   of the corpus, sorted by term within each task's documents. The index is
   parted by documents: no word crosses the network, and a term that holds a
   third of all words is spread over all parts like any other. A closing posting
   of the empty term per document holds its id and its length.
2. Of each window of a test item the two rarest terms are its anchors. Their
   posting lists, moved by the terms' places in the item, are intersected:
   a document and a shift at which both meet is an alignment of the item.
3. ``phrase_matches`` compares the item's other terms with the postings of the
   aligned documents at the same shift. Stretches of consecutive hits as long as
   a window are exact matches.
4. ``proximity_matches`` finds documents in which the rarest terms of a window
   stand within a few words of each other, in any order.

Test sides are broadcast only when counted below ``BROADCAST_ROWS``; larger ones
meet the index in ordinary joins. Terms are compared as strings; their hashes
are only the sort order of the index.

Defined cases: a null or empty text has no words; an item without words has no
window and matches nothing; a null item_id is an item, written as an empty
string; items that repeat an item_id are one item in the counts; rows of
documents each get their own result, whatever repeats in doc_id or text; an
empty corpus gives an empty result, an empty benchmark hits nothing; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import staged

WINDOW = 10
NEAR_TERMS, NEAR_WORDS = 3, 20
BROADCAST_ROWS = 500_000
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = ""  # no word is empty


def _terms(text: str) -> Column:
    """Runs of TERM; splitting takes a tenth of the time of extracting them."""
    return F.array_remove(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), BETWEEN), "")


def _bounded(table: DataFrame) -> DataFrame:
    """A written table as a broadcast side if it has few rows, else as it is."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Postings (_doc, doc_id, pos, term, hash): a row a word, and the closing row of each document, the only one with its doc_id."""
    rows = docs.select(F.monotonically_increasing_id().alias("_doc"), F.col(doc_id).alias("_id"), F.concat(_terms(text), F.array(F.lit(_END))).alias("_terms"))
    return staged(rows.select("_doc", "_id", F.posexplode("_terms").alias("pos", "term"))
                  .select("_doc", F.when(F.col("term") == _END, F.col("_id")).alias("doc_id"), "pos", "term", F.xxhash64("term").alias("hash"))
                  .sortWithinPartitions("hash"), "op11-index")


def lengths(index: DataFrame) -> DataFrame:
    """_doc, doc_id, n_words of every document."""
    return index.filter((F.col("hash") == F.xxhash64(F.lit(_END))) & (F.col("term") == _END)).select("_doc", "doc_id", F.col("pos").cast("long").alias("n_words"))


def item_terms(index: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """_item, item_id, q, term, hash, n, seen: each word of the items, the item's length and the term's postings in the index."""
    words = items.select(F.monotonically_increasing_id().alias("_item"), F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), _terms(text).alias("_terms"))
    words = staged(words.select("_item", "item_id", F.size("_terms").alias("n"), F.posexplode("_terms").alias("q", "term"))
                   .withColumn("hash", F.xxhash64("term")), "op11-items")
    terms = staged(words.select("hash", "term").distinct(), "op11-terms")
    seen = index.join(_bounded(terms), ["hash", "term"]).groupBy("hash", "term").agg(F.count("*").alias("seen"))
    return staged(words.join(seen, ["hash", "term"], "left").select("_item", "item_id", "q", "term", "hash", "n", F.coalesce("seen", F.lit(0)).alias("seen")), "op11-item-terms")


def _windows(words: DataFrame, size: int) -> DataFrame:
    """Rows (_item, s, ...) of each window with its words."""
    last = F.greatest(F.col("n") - size, F.lit(0))
    return words.withColumn("s", F.explode(F.sequence(F.greatest(F.col("q") - (size - 1), F.lit(0)), F.least(F.col("q"), last))))


def alignments(index: DataFrame, words: DataFrame, size: int = WINDOW) -> DataFrame:
    """_item, _doc, shift (position in the document less place in the item) where the two rarest terms of a window meet."""
    rare = F.sort_array(F.collect_list(F.struct("seen", "q", "term", "hash")))
    windows = (_windows(words, size).groupBy("_item", "s").agg(rare.alias("r"), F.min("seen").alias("least")).filter("least > 0")
               .select("_item", F.col("r")[0].alias("a"), F.coalesce(F.get("r", F.lit(1)), F.col("r")[0]).alias("b")))
    pairs = windows.select("_item", F.col("a.q").alias("q1"), F.col("b.q").alias("q2"), "a", "b").distinct()
    anchors = staged(pairs.select("_item", "q1", "q2", F.inline(F.array(
        F.struct(F.lit(1).alias("role"), F.col("a.q").alias("q"), F.col("a.term").alias("term"), F.col("a.hash").alias("hash")),
        F.struct(F.lit(2).alias("role"), F.col("b.q").alias("q"), F.col("b.term").alias("term"), F.col("b.hash").alias("hash"))))), "op11-anchors")
    lists = index.join(_bounded(anchors), ["hash", "term"]).select("_item", "q1", "q2", "_doc", (F.col("pos") - F.col("q")).alias("shift"), "role")
    met = lists.groupBy("_item", "q1", "q2", "_doc", "shift").agg(F.bit_or("role").alias("roles")).filter("roles = 3")
    return staged(met.select("_item", "_doc", "shift").distinct(), "op11-alignments")


def phrase_matches(index: DataFrame, words: DataFrame, size: int = WINDOW) -> DataFrame:
    """_doc, item_id, first, last: stretches of document positions in which the item's windows occur, word for word."""
    met = alignments(index, words, size)
    aligned = staged(met.select("_doc").distinct(), "op11-aligned")
    terms = staged(words.select("hash", "term").distinct(), "op11-item-vocabulary")
    near = index.join(_bounded(aligned), "_doc", "left_semi").join(_bounded(terms), ["hash", "term"], "left_semi").select("_doc", "pos", "term")
    wanted = met.join(_bounded(words), "_item").select("_item", "item_id", "_doc", "shift", "q", "n", "term", (F.col("shift") + F.col("q")).alias("pos"))
    hits = wanted.join(near, ["_doc", "pos", "term"])
    turn = F.row_number().over(Window.partitionBy("_doc", "_item", "shift").orderBy("q"))
    stretches = (hits.withColumn("_stretch", F.col("q") - turn).groupBy("_doc", "_item", "shift", "_stretch")
                 .agg(F.first("item_id").alias("item_id"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.first("n").alias("n")))
    return stretches.filter(F.col("last") - F.col("first") + 1 >= F.least(F.col("n"), F.lit(size))).select("_doc", "item_id", "first", "last")


def proximity_matches(index: DataFrame, words: DataFrame, size: int = WINDOW, n_terms: int = NEAR_TERMS, within: int = NEAR_WORDS) -> DataFrame:
    """_doc, item_id: documents with ``within`` consecutive words that hold the ``n_terms`` rarest distinct terms of a window of the item.

    Terms tie in code-point order. A window of fewer distinct terms takes all it
    has; one with fewer than that many terms in the corpus matches nothing.
    """
    terms = _windows(words, size).select("_item", "item_id", "s", "seen", "term", "hash").distinct()
    found = F.sort_array(F.collect_list(F.when(F.col("seen") > 0, F.struct("seen", "term", "hash"))))
    groups = (terms.groupBy("_item", "item_id", "s").agg(F.least(F.count("*"), F.lit(n_terms)).cast("int").alias("k"), found.alias("r")).filter("size(r) >= k")
              .select("item_id", "k", F.transform(F.slice("r", F.lit(1), F.col("k")), lambda t: F.struct(t["hash"].alias("hash"), t["term"].alias("term"))).alias("r")))
    pair = F.xxhash64(F.slice("r", 1, 2))  # of the two rarest
    groups = staged(groups.select("item_id", F.xxhash64(F.array_sort("r")).alias("group"), pair.alias("pair"), "k", "r").distinct(), "op11-near")

    # Lists of the two rarest terms first. Blocks are stretches of ``within`` words from multiples of it; a rarest term also reaches
    # the blocks beside its own, so two terms within ``within`` words of each other meet.
    pairs = staged(groups.select("pair", F.posexplode(F.slice("r", 1, 2)).alias("turn", "t"), F.least("k", F.lit(2)).alias("many"))
                   .select("pair", "many", (F.col("turn") + 1).alias("role"), F.col("t.hash").alias("hash"), F.col("t.term").alias("term")).distinct(), "op11-near-pairs")
    block = F.floor(F.col("pos") / within)
    reach = F.when(F.col("role") == 1, F.array(block - 1, block, block + 1)).otherwise(F.array(block))
    met = (index.join(_bounded(pairs), ["hash", "term"]).select("pair", "many", "role", "_doc", F.explode(reach).alias("block"))
           .groupBy("pair", "many", "_doc", "block").agg(F.bit_or("role").alias("roles")).filter((F.col("roles") == 3) | (F.col("many") == 1)))
    met = staged(met.select("pair", "_doc").distinct(), "op11-near-documents")

    # Then all terms of the groups, in the documents that are left, in blocks of 2 * within words from every multiple of within.
    docs = staged(met.select("_doc").distinct(), "op11-near-aligned")
    members = staged(groups.select("item_id", "group", "pair", "k", F.inline("r")), "op11-near-terms")
    known = staged(members.select("hash", "term").distinct(), "op11-near-vocabulary")
    left = index.join(_bounded(docs), "_doc", "left_semi").join(_bounded(known), ["hash", "term"], "left_semi").select("_doc", "pos", "hash", "term")
    lists = (met.join(_bounded(members), "pair").join(left, ["_doc", "hash", "term"])
             .select("item_id", "group", "k", "_doc", F.explode(F.array(block - 1, block)).alias("block"), "pos", "hash"))
    blocks = lists.groupBy("item_id", "group", "_doc", "block").agg(F.first("k").alias("k"), F.collect_set(F.struct("pos", "hash")).alias("p"))
    at = F.col("p")
    full = F.size(F.array_distinct(F.transform(at, lambda x: x["hash"]))) == F.col("k")
    close = F.exists(at, lambda x: F.size(F.array_distinct(F.transform(F.filter(at, lambda y: (y["pos"] >= x["pos"]) & (y["pos"] < x["pos"] + within)),
                                                                     lambda y: y["hash"]))) == F.col("k"))
    return blocks.filter(full).filter(close).select("_doc", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near (items with a proximity match) of every row."""
    index = build_index(docs, text, doc_id)
    words = item_terms(index, items, item_text, item_id)
    exact = staged(phrase_matches(index, words, size), "op11-matches")
    covered = exact.select("_doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("_doc").agg(F.count("*").alias("n_hit"))
    named = exact.groupBy("_doc").agg(F.sort_array(F.collect_set("item_id")).alias("_items"))
    near = proximity_matches(index, words, size).groupBy("_doc").agg(F.count("*").alias("n_near"))
    rows = lengths(index).join(covered, "_doc", "left").join(named, "_doc", "left").join(near, "_doc", "left")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    return rows.select(F.col("doc_id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                       F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                       F.coalesce("n_near", F.lit(0)).alias("n_near"))


def oracle_sql(size: int = WINDOW, n_terms: int = NEAR_TERMS, within: int = NEAR_WORDS) -> str:
    """``contamination`` for DuckDB, window by window."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), {size}) AS m FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT item_id, m, i, w[i:i + m - 1] AS win FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
dw AS (SELECT doc_id, m, i, w[i:i + m - 1] AS win FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM b))),
hit AS (SELECT doc_id, dw.i, dw.m, item_id FROM dw JOIN (SELECT DISTINCT item_id, win FROM bw) x ON dw.win = x.win),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id),
dt AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM d),
seen AS (SELECT t, count(*) AS n FROM dt GROUP BY t),
wt AS (SELECT DISTINCT item_id, i, win, unnest(win) AS t FROM bw),
rk AS (SELECT item_id, i, wt.t, seen.n, row_number() OVER (PARTITION BY item_id, win, i ORDER BY seen.n NULLS LAST, wt.t) AS rn,
              least(count(*) OVER (PARTITION BY item_id, win, i), {n_terms}) AS k FROM wt LEFT JOIN seen ON wt.t = seen.t),
grp AS (SELECT item_id, list(t ORDER BY t) AS ts FROM rk WHERE rn <= k GROUP BY item_id, i, k HAVING count(n) = k),
g AS (SELECT item_id, ts, unnest(ts) AS t FROM (SELECT DISTINCT item_id, ts FROM grp)),
gp AS (SELECT item_id, ts, doc_id, g.t, p FROM g JOIN dt ON g.t = dt.t),
few AS (SELECT item_id, ts, doc_id FROM gp GROUP BY ALL HAVING count(DISTINCT t) = len(ts)),
gf AS (SELECT gp.* FROM gp SEMI JOIN few ON gp.item_id = few.item_id AND gp.ts = few.ts AND gp.doc_id = few.doc_id),
close AS (SELECT DISTINCT x.item_id, x.doc_id FROM gf x JOIN gf y ON x.item_id = y.item_id AND x.ts = y.ts AND x.doc_id = y.doc_id AND y.p >= x.p AND y.p < x.p + {within}
          GROUP BY x.item_id, x.ts, x.doc_id, x.p HAVING count(DISTINCT y.t) = len(x.ts)),
nr AS (SELECT doc_id, count(*) AS n_near FROM close GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN its ON d.doc_id = its.doc_id LEFT JOIN nr ON d.doc_id = nr.doc_id"""
