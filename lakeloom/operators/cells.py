"""SDMX and JSON-stat documents whose cells are rows before they are decoded.

A document is parsed once into a VARIANT; ``variant_explode`` turns its cells
into rows that carry the document's key and a few numbers (strides and sizes),
never its dimension lists. Codes and labels are a side of their own, a row for
each place of a dimension, which the decoded places join. The side of a document
of many cells is repeated over ``CELLS`` cells each, and the cells deal themselves
over these copies, so that one large document is spread over many tasks. A
document's length bounds its cells, so the copies are fewer than its characters
by ``CELLS`` times ``CELL_CHARS``, however sparse its cube.

Defined cases: a null or malformed document gives no rows; repeated documents
give repeated rows. JSON-stat: ``value`` may be an object (flat place to value) or
an array (null cells left out); a dimension's ``index`` may be an object or an
array of codes; a place without a code gives ``UNK`` or an empty time. SDMX: a
series key shorter than the list of dimensions is left out, as are cells without
a number; a given sex is asked only of documents that have its code; a place
without a code gives ``UNK`` or an empty time; only the first data set counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.functions.columns import literal_map, year_of_period
from lakeloom.operators.normalise import AREA_TO_NAME, CITIZEN_DIMS, SEX_TO_GENDER
from lakeloom.operators.observations import to_canonical

CELLS = 1 << 18
CELL_CHARS = 2  # a cell takes no fewer: a digit and a comma
_KEY = ["_doc", "_hash"]
_AT = "$.data.structures[0].dimensions"
_DIMS = "array<struct<id:string,values:array<struct<id:string>>>>"


def _exploded(df: DataFrame, value: str) -> DataFrame:
    """``df`` with pos, key and value of each item of a VARIANT array or object."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(value).outer()))


def _parsed(docs: DataFrame, doc_col: str, doc_id: str, cells: int) -> DataFrame:
    """A row a document: key, VARIANT, and the copies of its sides."""
    spread = F.greatest(F.lit(1), F.ceil(F.length(doc_col) / (cells * CELL_CHARS))).cast("int")
    return docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(doc_col).alias("_hash"), spread.alias("spread"), F.try_parse_json(F.col(doc_col)).alias("v"))


def _joined(rows: DataFrame, sides: DataFrame, dim: Column, place: str, **taken: str) -> DataFrame:
    """``rows`` with the columns of the side's row for their place of the dimension, null without one."""
    side = sides.select(F.col("_doc").alias("d"), F.col("_hash").alias("h"), F.col("dim").alias("m"), F.col("place").alias("p"), F.col("copy").alias("y"),
                        *[F.col(c).alias(name) for name, c in taken.items()])
    same = F.col("_doc").eqNullSafe(F.col("d")) & (F.col("_hash") == F.col("h")) & (dim == F.col("m")) & (F.col(place) == F.col("p")) & (F.col("copy") == F.col("y"))
    return rows.join(side, same, "left").drop("d", "h", "m", "p", "y")


def _copies(sides: DataFrame) -> DataFrame:
    return sides.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))).drop("spread")


def _shapes(docs: DataFrame, doc_col: str, doc_id: str, cells: int) -> DataFrame:
    """A row a document: key, VARIANT, the places of its dimensions with stride and size, and the copies of its sides."""
    v = _parsed(docs, doc_col, doc_id, cells).select(*_KEY, "spread", "v", F.try_variant_get("v", "$.id", "array<string>").alias("ids"), F.try_variant_get("v", "$.size", "array<bigint>").alias("sizes"))
    n = F.size("ids")

    def at(name: str) -> Column:
        p = F.array_position("ids", F.lit(name)).cast("int")
        return F.when(p > 0, p - 1)

    def product(values: Column) -> Column:
        return F.aggregate(values, F.lit(1).cast("long"), lambda a, x: a * x)

    places = {"cit": F.coalesce(*[at(c) for c in CITIZEN_DIMS]), "time": F.coalesce(at("time"), n - 1), "sex": at("sex")}
    return v.filter(F.col("ids").isNotNull()).select(
        *_KEY, "v", "spread",
        *[c.alias(f"{k}_{name}") for k, i in places.items() for name, c in (
            ("dim", F.get("ids", i)), ("size", F.get("sizes", i)), ("step", product(F.slice("sizes", i + 2, F.greatest(n - i - 1, F.lit(0))))))])


def _sides(shapes: DataFrame) -> DataFrame:
    """_doc, _hash, dim, place, code, label, copy: a row for each place of each dimension, once a copy."""
    dims = shapes.select(*_KEY, "spread", F.try_variant_get("v", "$.dimension", "variant").alias("d"))
    dims = _exploded(dims, "d").select(*_KEY, "spread", F.col("key").alias("dim"), F.try_variant_get("value", "$.category.index", "variant").alias("i"),
                                       F.try_variant_get("value", "$.category.label", "variant").alias("l"))
    listed = F.col("key").isNull()
    codes = _exploded(dims.select(*_KEY, "spread", "dim", "i"), "i").select(
        *_KEY, "spread", "dim", F.when(listed, F.try_variant_get("value", "$", "string")).otherwise(F.col("key")).alias("code"),
        F.when(listed, F.col("pos").cast("long")).otherwise(F.try_variant_get("value", "$", "bigint")).alias("place"))
    labels = _exploded(dims.select(*_KEY, "dim", "l"), "l").select(*_KEY, "dim", F.col("key").alias("code"), F.try_variant_get("value", "$", "string").alias("label"))
    named = (codes.dropDuplicates([*_KEY, "dim", "place"]).alias("c")
             .join(labels.dropDuplicates([*_KEY, "dim", "code"]).alias("n"), F.expr("c._doc <=> n._doc and c._hash = n._hash and c.dim = n.dim and c.code = n.code"), "left"))
    return _copies(named.select("c._doc", "c._hash", "spread", "c.dim", "place", "c.code", "label"))


def norm_jsonstat_cells(docs: DataFrame, var_code: str = "B11", metric: str = "Inflows of Foreign Population", sex: str | None = "T",
                        ref_area: str = "ITA", ref_area_name: str = "Italy", doc_col: str = "doc", doc_id: str = "doc_id",
                        fetch_ts: object = None, cells: int = CELLS) -> DataFrame:
    """The rows of ``norm_jsonstat``, by cells."""
    shapes = _shapes(docs, doc_col, doc_id, cells)
    numbers = [f"{k}_{name}" for k in ("cit", "time", "sex") for name in ("dim", "size", "step")]
    flat = F.coalesce(F.col("key").try_cast("long"), F.when(F.col("key").isNull(), F.col("pos").cast("long")))
    rows = _exploded(shapes.select(*_KEY, "spread", *numbers, F.try_variant_get("v", "$.value", "variant").alias("cells")), "cells").select(
        *_KEY, *numbers, F.pmod(F.xxhash64(flat), F.col("spread")).alias("copy"), flat.alias("flat"), F.try_variant_get("value", "$", "double").alias("v"))
    rows = rows.filter(F.col("v").isNotNull())
    for k in ("cit", "time", "sex"):
        rows = rows.withColumn(f"{k}_place", F.pmod(F.floor(F.col("flat") / F.col(f"{k}_step")), F.col(f"{k}_size")))
    sides = _sides(shapes)
    for k in ("cit", "time", "sex"):
        rows = _joined(rows, sides, F.col(f"{k}_dim"), f"{k}_place", **{k: "code", f"{k}_label": "label"})
    asked = (sex or "T").upper()
    has_sex = F.col("sex_dim").isNotNull()
    code = F.when(has_sex, F.col("sex")).otherwise(F.lit(asked))
    if sex is not None:
        rows = rows.filter(~has_sex | (F.upper("sex") == asked))
    time = F.coalesce("time", F.lit(""))
    return to_canonical(rows.select(
        F.lit(ref_area).alias("ref_area"), F.lit(ref_area_name).alias("ref_area_name"), F.coalesce("cit", F.lit("UNK")).alias("counterpart"),
        F.coalesce("cit_label", "cit", F.lit("Unknown")).alias("counterpart_name"), time.alias("time_period"), year_of_period(time).alias("year"),
        F.lit(var_code).alias("var_code"), F.lit(metric).alias("metric"), code.alias("sex"),
        F.coalesce(F.try_element_at(literal_map(SEX_TO_GENDER), code), F.lit("Total")).alias("gender"),
        F.col("v").alias("obs_value"), F.lit("EUROSTAT").alias("source_dataset"),
        (F.current_timestamp() if fetch_ts is None else F.lit(fetch_ts).cast("timestamp")).alias("fetch_ts")))


def _sdmx_sides(parsed: DataFrame) -> DataFrame:
    """_doc, _hash, dim, place, code, name, copy: a row for each place of each series dimension, and of the time as dim -1, once a copy."""
    lists = parsed.select(*_KEY, "spread", F.try_variant_get("v", _AT + ".series", "variant").alias("s"), F.try_variant_get("v", _AT + ".observation[0]", "variant").alias("t"))
    listed = F.try_variant_get("value", "$.values", "variant").alias("values")
    series = _exploded(lists.select(*_KEY, "spread", "s"), "s").select(*_KEY, "spread", F.col("pos").alias("dim"), listed)
    time = lists.select(*_KEY, "spread", F.lit(-1).alias("dim"), F.try_variant_get("t", "$.values", "variant").alias("values"))
    places = _exploded(series.unionByName(time), "values").select(
        *_KEY, "spread", "dim", F.col("pos").alias("place"), F.try_variant_get("value", "$.id", "string").alias("code"), F.try_variant_get("value", "$.name", "string").alias("name"))
    return _copies(places.filter(F.col("place").isNotNull()).dropDuplicates([*_KEY, "dim", "place"]))


def norm_sdmx_cells(docs: DataFrame, ref_area: str | None = None, var_code: str | None = None, sex: str | None = None, doc_col: str = "doc",
                    doc_id: str = "doc_id", fetch_ts: object = None, cells: int = CELLS) -> DataFrame:
    """The rows of ``norm_sdmx``, by cells."""
    asked = None if sex is None else ("_T" if sex in ("T", "_T") else sex)
    parsed = _parsed(docs, doc_col, doc_id, cells)
    dims = F.col("dims")
    at = {"ra": ("REF_AREA", ref_area), "me": ("MEASURE", var_code), "sx": ("SEX", asked), "ci": ("CITIZENSHIP", None)}

    def first(values: Column, value: str) -> Column:
        p = F.array_position(F.transform(values, lambda x: x["id"]), F.lit(value)).cast("int")
        return F.when(p > 0, p - 1)

    shapes = parsed.withColumn("dims", F.try_variant_get("v", _AT + ".series", _DIMS))
    shapes = shapes.select(*_KEY, "spread", "dims", F.size("dims").alias("n"), F.try_variant_get("v", "$.data.dataSets[0].series", "variant").alias("series"),
                           *[first(dims, name).alias(f"{k}_dim") for k, (name, _) in at.items()])
    wanted = {k: code for k, (_, code) in at.items() if code is not None}
    shapes = shapes.select(*_KEY, "spread", "n", "series", *[f"{k}_dim" for k in at],
                           *[first(F.get("dims", F.col(f"{k}_dim"))["values"], code).alias(f"{k}_want") for k, code in wanted.items()])
    kept = [*_KEY, "spread", *[f"{k}_dim" for k in at]]
    rows = _exploded(shapes, "series").withColumn("places", F.transform(F.split("key", ":"), lambda p: p.try_cast("int")))
    rows = rows.filter(F.size("places") >= F.col("n")).select(
        *kept, *[f"{k}_want" for k in wanted], "key", F.try_variant_get("value", "$.observations", "variant").alias("observations"),
        *[F.get("places", F.col(f"{k}_dim")).alias(f"{k}_place") for k in at])
    for k in wanted:
        same = F.col(f"{k}_place") == F.col(f"{k}_want")
        rows = rows.filter(F.col(f"{k}_want").isNull() | same if k == "sx" else same)
    rows = rows.select(*kept, *[f"{k}_place" for k in at], F.col("key").alias("series_key"), "observations")
    rows = _exploded(rows, "observations").select(
        *kept, *[f"{k}_place" for k in at], F.col("key").try_cast("int").alias("time_place"), F.pmod(F.xxhash64("series_key", "key"), F.col("spread")).alias("copy"),
        F.try_variant_get("value", "$[0]", "double").alias("number"), F.try_variant_get("value", "$[1]", "string").alias("status"))
    rows = rows.filter(F.col("number").isNotNull())
    sides = _sdmx_sides(parsed)
    for k, (_, code) in at.items():
        if k in ("ra", "me") and code is not None:
            rows = rows.withColumn(k, F.lit(code))
        else:
            rows = _joined(rows, sides, F.col(f"{k}_dim"), f"{k}_place", **({"ci": "code", "ci_name": "name"} if k == "ci" else {k: "code"}))
    rows = _joined(rows, sides, F.lit(-1), "time_place", time="code")
    found = F.coalesce("sx", F.lit("_T"))
    time = F.coalesce("time", F.lit(""))
    return to_canonical(rows.select(
        F.col("ra").alias("ref_area"), F.coalesce(F.try_element_at(literal_map(AREA_TO_NAME), F.col("ra")), "ra").alias("ref_area_name"),
        F.coalesce("ci", F.lit("UNK")).alias("counterpart"), F.coalesce("ci_name", "ci", F.lit("Unknown")).alias("counterpart_name"),
        time.alias("time_period"), year_of_period(time).alias("year"), F.col("me").alias("var_code"),
        F.coalesce(F.try_element_at(literal_map(R.VAR_TO_METRIC), F.col("me")), "me").alias("metric"),
        (found if asked is None else F.lit(asked)).alias("sex"), F.coalesce(F.try_element_at(literal_map(SEX_TO_GENDER), found), F.lit("Total")).alias("gender"),
        F.col("number").alias("obs_value"), F.col("status").alias("obs_status"), F.lit("OECD_MIG").alias("source_dataset"),
        (F.current_timestamp() if fetch_ts is None else F.lit(fetch_ts).cast("timestamp")).alias("fetch_ts")))
