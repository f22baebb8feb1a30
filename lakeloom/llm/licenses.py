"""Operator 7: licence scan by Dice coefficient over word bigrams, in DataFrame functions.

A text's units are its lines, its paragraphs of several lines (parted by blank
lines) and, if it has several paragraphs, the whole; a licence may be any of
them. Normalised units (ASCII lower case, copyright lines out, everything but
a-z and 0-9 a gap) become sets of word bigrams. Dice is twice the common
bigrams over the sum of both set sizes, so a template of b bigrams can only
reach the threshold t with units of b*t/(2-t) to b*(2-t)/t bigrams; units that
fit no template end here. The bigrams of the others meet those of the templates
in a join (the templates, some thousand rows, are the broadcast side) under the
same bounds, and matches are counted per unit.

A licence may also stand within a longer line, run over lines and paragraphs of a
longer text, or behind comment marks. A template that no unit of a text has matched
is sought in windows: as many consecutive normalised words as the template has,
starting at one of its bigrams. Texts are cut into chunks of ``CHUNK`` starts
that overlap by the longest template; a chunk goes on with a template only if it
holds enough of its bigrams, and a window's Dice is exact. A text's best window for
a template is a match of kind ``WINDOW``, with the number of its first word.

Before all that, texts without any anchor end: the threshold leaves a template at
most b - b*t/(2-t) missing bigrams, so of one more than that at least one is there.
The anchors are those with the longest words. No match is lost.

Groups hold one unit's or one chunk's bigrams, so neither a notice found in many
documents nor a long document makes a large one.

Defined cases: a null or wordless text has no unit and no licence; units of one
word have no bigram; equal scores go to units before windows, then to the first template by name, then to
lines before paragraphs before the whole, then to the first unit or window; repeated rows
each get the same result; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import staged
from lakeloom.llm.license_texts import TEMPLATES

THRESHOLD = 0.9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(?m)^[ \t]*copyright[ \t]+(?:\(c\)|©|[0-9])[^\n]*$"
LINE, PARAGRAPH, WHOLE, WINDOW = 0, 1, 2, 3
CHUNK = 1024


def normalised(text: str) -> list[str]:
    """Words of a template, by the same rules as the columns below."""
    lower = "".join(_LOWER[_UPPER.index(c)] if c in _UPPER else c for c in text)
    return re.sub("[^a-z0-9]+", " ", re.sub(COPYRIGHT_LINE, "", lower)).split()


def bigrams(text: str) -> list[str]:
    words = normalised(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def least_common(b: int, threshold: float) -> int:
    """Bigrams that a set shares at least with a template of ``b`` to reach the threshold."""
    return next(c for c in range(b + 1) if 2 * c >= threshold * (c + b))


def longest(gram: str) -> str:
    return max(gram.split(), key=lambda w: (len(w), w))


def anchors(templates: list[tuple[str, str, str]], threshold: float) -> list[str]:
    """Bigrams of which every text that matches some template holds one: those with the longest words."""
    found = set()
    for _, _, text in templates:
        grams = sorted(bigrams(text), key=lambda g: (-len(longest(g)), -len(g), g))
        found |= set(grams[:len(grams) - least_common(len(grams), threshold) + 1])
    return sorted(found)


def template_rows(spark: SparkSession, templates: list[tuple[str, str, str]]) -> DataFrame:
    """template, licence, b (its number of bigrams), span (its places for bigrams), gram."""
    values = [{"template": name, "licence": licence, "b": len(grams), "span": len(normalised(text)) - 1, "grams": grams}
              for name, licence, text in templates if (grams := bigrams(text))]
    rows = F.from_json(F.lit(json.dumps(values)), "array<struct<template:string,licence:string,b:int,span:int,grams:array<string>>>")
    return spark.range(1).select(F.inline(rows)).select("template", "licence", "b", "span", F.explode("grams").alias("gram"))


def _lower(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, _UPPER, _LOWER), COPYRIGHT_LINE, "")


def _gap(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def _grams(words: Column, n: Column) -> Column:
    """The ``n`` bigrams of ``n`` + 1 words, in their order."""
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda x, y: F.concat(x, F.lit(" "), y))


def _units(text: Column) -> Column:
    """(kind, number, normalised text) of each unit."""
    lower, gap = _lower(text), _gap
    paragraphs = F.split(lower, r"\n[ \t]*\n")
    kind = lambda values, k: F.transform(values, lambda u, i: F.struct(F.lit(k).alias("kind"), i.alias("no"), gap(u).alias("unit")))
    several = F.filter(F.transform(paragraphs, lambda u, i: F.struct(F.lit(PARAGRAPH).alias("kind"), i.alias("no"), u.alias("unit"))),
                       lambda p: F.instr(F.trim(p["unit"]), "\n") > 0)
    return F.concat(kind(F.split(lower, "\n"), LINE),
                    F.transform(several, lambda p: F.struct(p["kind"].alias("kind"), p["no"].alias("no"), gap(p["unit"]).alias("unit"))),
                    F.when(F.size(paragraphs) > 1, F.array(F.struct(F.lit(WHOLE).alias("kind"), F.lit(0).alias("no"), gap(lower).alias("unit"))))
                    .otherwise(F.array()))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: list[tuple[str, str, str]] = TEMPLATES,
         threshold: float = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """doc_id, version (a hash of the text), kind, no, template, licence, dice: units and windows that reach the threshold with a template."""
    known = F.broadcast(template_rows(docs.sparkSession, templates))
    grams = anchors(templates, threshold)
    held = F.split(_gap(_lower(F.col("text"))), " ")
    # The words first, which costs less; texts that hold one are asked for the bigrams.
    anchored = (F.arrays_overlap(held, F.array(*map(F.lit, sorted({longest(g) for g in grams}))))
                & F.arrays_overlap(_grams(held, F.size(held) - 1), F.array(*map(F.lit, grams))))
    texts = staged(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"), F.col(text).alias("text")).filter(anchored), "op7-texts")
    units = staged(unit_matches(texts, known, sorted({len(bigrams(t)) for _, _, t in templates} - {0}), threshold), "op7-units")
    span = max((len(normalised(t)) for _, _, t in templates), default=0)
    return units.union(window_matches(texts, known, units, chunk, span, threshold))


def unit_matches(texts: DataFrame, known: DataFrame, sizes: list[int], threshold: float) -> DataFrame:
    fits = lambda a, b: (a * threshold <= b * (2 - threshold)) & (b * threshold <= a * (2 - threshold))
    units = (texts.select("doc_id", "version", F.explode(_units(F.col("text"))).alias("u"))
             .select("doc_id", "version", "u.kind", "u.no", F.split("u.unit", " ").alias("w")))
    # A unit of n words has at most n - 1 bigrams, and none fits with fewer than the least bound.
    n = F.size("w") - 1
    units = units.filter(n * (2 - threshold) >= sizes[0] * threshold)
    units = units.select("doc_id", "version", "kind", "no", F.array_distinct(_grams(F.col("w"), n)).alias("grams")).withColumn("a", F.size("grams"))
    bound = F.lit(False)
    for b in sizes:
        bound = bound | fits(F.col("a"), F.lit(b))
    rows = units.filter(bound).select("doc_id", "version", "kind", "no", "a", F.explode("grams").alias("gram"))
    met = rows.join(known, (rows["gram"] == known["gram"]) & fits(F.col("a"), F.col("b")))
    keys = ["doc_id", "version", "kind", "no", "a", "template", "licence", "b"]
    return (met.groupBy(*keys).agg(F.count_distinct(known["gram"]).alias("common"))
            .withColumn("dice", 2.0 * F.col("common") / (F.col("a") + F.col("b"))).filter(F.col("dice") >= threshold)
            .select("doc_id", "version", "kind", "no", "template", "licence", "dice"))


def window_matches(texts: DataFrame, known: DataFrame, units: DataFrame, chunk: int, overlap: int, threshold: float) -> DataFrame:
    """The best window of each text and template, where none of the text's ``units`` matched the template."""
    words = F.split(_gap(_lower(F.col("text"))), " ")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / chunk).cast("int")),
                      lambda c: F.struct(c.alias("c"), F.slice(F.col("w"), c * chunk + 1, chunk + overlap).alias("w")))
    chunks = staged(texts.select("doc_id", "version", words.alias("w")).select("doc_id", "version", F.inline(cut)), "op7-chunks")
    key = ["doc_id", "version", "c"]
    enough = F.col("common") * (2 - threshold) >= F.col("b") * threshold

    def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
        found = F.lit(True)
        for name in names:
            found = found & left[name].eqNullSafe(right[name])
        return found

    rows = chunks.filter(F.size("w") > 1).select(*key, F.posexplode(_grams(F.col("w"), F.size("w") - 1)).alias("pos", "gram"))
    met = rows.join(known, "gram").select(*key, "template", "licence", "b", "span", "pos", "gram")
    group = [*key, "template"]
    likely = met.groupBy(*group, "b").agg(F.count_distinct("gram").alias("common")).filter(enough).select(*group)
    done = units.select("doc_id", "version", "template").distinct()
    likely = likely.join(done, same(likely, done, "doc_id", "version", "template"), "left_anti")
    met = staged(met.join(likely, same(met, likely, *group), "left_semi").distinct(), "op7-places")
    start = met.filter(F.col("pos") < chunk).select(*(F.col(k).alias("_" + k) for k in group), "licence", "b", "span", F.col("pos").alias("start"))
    place = met.select(*group, "pos", "gram")
    pairs = start.join(place, F.expr(" and ".join(f"_{k} <=> {k}" for k in group)) & F.col("pos").between(F.col("start"), F.col("start") + F.col("span") - 1))
    windows = (pairs.groupBy(*group, "licence", "b", "span", "start").agg(F.count_distinct("gram").alias("common")).filter(enough))
    a = F.size(F.array_distinct(_grams(F.slice("w", F.col("start") + 1, F.col("span") + 1), F.least(F.col("span"), F.size("w") - F.col("start") - 1))))
    held = chunks.select(*(F.col(k).alias("_" + k) for k in key), "w").dropDuplicates(["_" + k for k in key])
    exact = (windows.join(held, F.expr(" and ".join(f"_{k} <=> {k}" for k in key)))
             .withColumn("dice", 2.0 * F.col("common") / (a + F.col("b"))).filter(F.col("dice") >= threshold)
             .withColumn("no", F.col("c") * chunk + F.col("start")))
    return (exact.groupBy("doc_id", "version", "template", "licence").agg(F.min_by(F.struct("no", "dice"), F.struct(-F.col("dice"), "no")).alias("m"))
            .select("doc_id", "version", F.lit(WINDOW).alias("kind"), "m.no", "template", "licence", "m.dice"))


def licences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_matches, template, licence, dice, kind, no of every row: its best match, nulls if none."""
    found = scan(docs, text, doc_id, **options)
    order = F.struct(-F.col("dice"), F.col("kind") == WINDOW, "template", "kind", "no")
    best = found.groupBy("doc_id", "version").agg(F.count("*").alias("n_matches"), F.min_by(F.struct("template", "licence", "dice", "kind", "no"), order).alias("m"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("version"))
    same = rows["doc_id"].eqNullSafe(best["doc_id"]) & (rows["version"] == best["version"])
    return rows.join(best, same, "left").select(
        rows["doc_id"], F.coalesce("n_matches", F.lit(0)).alias("n_matches"), "m.template", "m.licence", "m.dice", "m.kind", "m.no")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql(templates: list[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """``licences`` over ``documents`` for DuckDB, unit by unit and template by template."""
    values = ",\n  ".join(f"({_sql_text(n)}, {_sql_text(li)}, {len(bigrams(t))}, {len(normalised(t)) - 1}, [{', '.join(map(_sql_text, bigrams(t)))}])" for n, li, t in templates)
    gap = lambda c: f"trim(regexp_replace({c}, '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH t(template, licence, b, span, grams) AS (VALUES
  {values}),
d AS (SELECT doc_id, regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '{COPYRIGHT_LINE}', '', 'g') AS low FROM documents),
p AS (SELECT doc_id, low, string_split(low, chr(10)) AS lines, regexp_split_to_array(low, '\\n[ \\t]*\\n') AS paras FROM d),
u AS (
  SELECT doc_id, 0 AS kind, i - 1 AS no, {gap('lines[i]')} AS unit FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM p)
  UNION ALL
  SELECT doc_id, 1, i - 1, {gap('paras[i]')} FROM (SELECT doc_id, paras, unnest(range(1, len(paras) + 1)) AS i FROM p) WHERE contains(trim(paras[i]), chr(10))
  UNION ALL
  SELECT doc_id, 2, 0, {gap('low')} FROM p WHERE len(paras) > 1),
w AS (SELECT doc_id, kind, no, string_split(unit, ' ') AS w FROM u),
g AS (SELECT doc_id, kind, no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM w),
s AS (SELECT g.doc_id, g.kind, g.no, t.template, t.licence, 2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + t.b) AS dice
      FROM g JOIN t ON len(g.grams) BETWEEN t.b * 0.8 AND t.b * 1.25),
f AS (SELECT DISTINCT doc_id, template FROM s WHERE dice >= {threshold}),
x AS (SELECT doc_id, string_split({gap('low')}, ' ') AS w FROM p),
q AS (SELECT doc_id, unnest(range(1, len(w))) AS pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM x),
m AS (SELECT q.doc_id, t.template, t.licence, t.b, t.span, q.pos, q.gram
      FROM q JOIN (SELECT *, unnest(grams) AS gram FROM t) AS t ON q.gram = t.gram ANTI JOIN f ON q.doc_id = f.doc_id AND t.template = f.template),
c AS (SELECT m.doc_id, m.template, m.licence, m.b, m.span, m.pos, count(DISTINCT n.gram) AS common
      FROM m JOIN m AS n ON m.doc_id = n.doc_id AND m.template = n.template AND n.pos BETWEEN m.pos AND m.pos + m.span - 1
      GROUP BY ALL HAVING common >= {threshold} * (common + m.b) / 2),
e AS (SELECT c.doc_id, c.template, c.licence, c.pos - 1 AS no, 2.0 * c.common / (c.b + (
        SELECT count(DISTINCT z.gram) FROM q AS z WHERE z.doc_id = c.doc_id AND z.pos >= c.pos AND z.pos < c.pos + c.span)) AS dice FROM c),
v AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY dice DESC, no) AS rn FROM e WHERE dice >= {threshold}),
h AS (SELECT doc_id, kind, no, template, licence, dice FROM s WHERE dice >= {threshold}
      UNION ALL SELECT doc_id, 3, no, template, licence, dice FROM v WHERE rn = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, kind = 3, template, kind, no) AS rn, count(*) OVER (PARTITION BY doc_id) AS n_matches
      FROM h)
SELECT documents.doc_id, coalesce(r.n_matches, 0) AS n_matches, r.template, r.licence, CAST(r.dice AS DOUBLE) AS dice, r.kind, r.no
FROM documents LEFT JOIN r ON documents.doc_id = r.doc_id AND r.rn = 1"""
