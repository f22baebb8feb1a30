"""Source documents written by Spark from the observation table, for round trips.

Rows are cut into documents of ``chunk`` consecutive row ids (a bounded group:
every document holds at most ``chunk`` observations, and every row lands in a
document). Each builder is ONE linear chain: a single ``repartition(doc_id)``,
after which every grouping (``doc_id`` plus more keys), the per-document value
lists and the final per-document aggregation are already satisfied by that
partitioning — one shuffle, and the observation join is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK = 64
SUM_TYPE = "decimal(38,4)"
SHEET_ROW = "array<struct<row_no:int,cells:array<string>>>"


def _chunked(obs: DataFrame, chunk: int, *cols) -> DataFrame:
    return (obs.select(F.floor(F.col("row_id") / F.lit(chunk)).cast("long").alias("doc_id"), *cols)
            .repartition("doc_id"))


def _pos(values: Column, v: Column) -> Column:
    return (F.array_position(values, v) - 1).cast("int")


def _vals(arr: Column) -> Column:
    return F.transform(arr, lambda x: F.struct(x.alias("id"), x.alias("name")))


def _doc_lists(df: DataFrame, **lists: Column) -> DataFrame:
    """Per-document sorted distinct value lists, attached to every row of the document."""
    w = Window.partitionBy("doc_id")
    return df.select("*", *[F.array_sort(F.collect_set(c).over(w)).alias(n) for n, c in lists.items()])


def _doc_cells(cells: DataFrame, columns: list[str], **lists: Column) -> DataFrame:
    """A row per document: its cells as an array, and its sorted distinct value lists. The rows
    that are grouped stay narrow: no list travels with a cell."""
    return cells.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("cells"),
                                       *[F.array_sort(F.collect_set(c)).alias(n) for n, c in lists.items()])


def _citizen(c: Column) -> Column:
    return F.struct(c["ci"].alias("id"), c["ci_name"].alias("name"))


def _series(placed: Column) -> Column:
    """Cells (key, observation) in the order of their keys → a map of keys and their observations."""
    def key(i: Column) -> Column:
        return F.get(placed, i)["key"]

    starts = F.filter(F.sequence(F.lit(0), F.size(placed) - 1), lambda i: (i == 0) | (key(i) != key(i - 1)))
    ends = F.filter(F.sequence(F.lit(1), F.size(placed)), lambda i: (i == F.size(placed)) | (key(i) != key(i - 1)))
    return F.map_from_entries(F.zip_with(starts, ends, lambda lo, hi: F.struct(key(lo), F.struct(F.map_from_entries(F.transform(
        F.slice(placed, lo + 1, hi - lo), lambda c: c["observation"])).alias("observations")))))


def sdmx_docs(obs: DataFrame, chunk: int = CHUNK, ref_area: str | None = None) -> DataFrame:
    """SDMX-JSON documents (doc_id, doc): series dims REF_AREA:CITIZENSHIP:MEASURE:SEX,
    observation dim TIME_PERIOD, values summed per cell, status ``A``."""
    o = _chunked(obs, chunk, (F.lit(ref_area) if ref_area else F.col("ref_area")).alias("ra"),
                 F.col("var_code").alias("me"),
                 F.when(F.col("sex") == "T", F.lit("_T")).otherwise(F.col("sex")).alias("sx"),
                 F.col("counterpart").alias("ci"), F.col("counterpart_name").alias("ci_name"),
                 F.col("time_period").alias("t"), "obs_value")
    cells = (o.groupBy("doc_id", "ra", "me", "sx", "ci", "ci_name", "t")
             .agg(F.sum(F.col("obs_value").cast(SUM_TYPE)).cast(SUM_TYPE).alias("v")))
    docs = _doc_cells(cells, ["ra", "me", "sx", "ci", "ci_name", "t", "v"], v_ra=F.col("ra"), v_me=F.col("me"), v_sx=F.col("sx"),
                      v_t=F.col("t"), v_ci=F.struct(F.col("ci").alias("id"), F.col("ci_name").alias("name")))

    def placed(c: Column) -> Column:
        key = F.concat_ws(":", _pos(F.col("v_ra"), c["ra"]).cast("string"),
                          F.when(c["ci"].isNotNull(), _pos(F.col("v_ci"), _citizen(c))).cast("string"),
                          _pos(F.col("v_me"), c["me"]).cast("string"), _pos(F.col("v_sx"), c["sx"]).cast("string"))
        return F.struct(key.alias("key"), F.struct(_pos(F.col("v_t"), c["t"]).cast("string").alias("t"),
                                                   F.array(c["v"].cast("string"), F.lit("A")).alias("v")).alias("observation"))

    lists = ["v_ra", "v_me", "v_sx", "v_t", "v_ci"]
    docs = docs.select("doc_id", *lists, F.sort_array(F.transform("cells", placed)).alias("placed"))
    docs = docs.select("doc_id", *lists, _series(F.col("placed")).alias("series"))
    sdims = F.array(
        F.struct(F.lit("REF_AREA").alias("id"), _vals(F.col("v_ra")).alias("values")),
        F.struct(F.lit("CITIZENSHIP").alias("id"), F.col("v_ci").alias("values")),
        F.struct(F.lit("MEASURE").alias("id"), _vals(F.col("v_me")).alias("values")),
        F.struct(F.lit("SEX").alias("id"), _vals(F.col("v_sx")).alias("values")))
    odims = F.array(F.struct(F.lit("TIME_PERIOD").alias("id"), _vals(F.col("v_t")).alias("values")))
    doc = F.struct(F.struct(
        F.array(F.struct("series")).alias("dataSets"),
        F.array(F.struct(F.struct(sdims.alias("series"), odims.alias("observation")).alias("dimensions")))
        .alias("structures")).alias("data"))
    return docs.select("doc_id", F.to_json(doc).alias("doc"))


def jsonstat_docs(obs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """JSON-stat 2.0 documents: dims citizen × sex × time, flat row-major value keys."""
    o = _chunked(obs, chunk, F.col("counterpart").alias("ci"), F.col("counterpart_name").alias("ci_name"),
                 F.col("sex").alias("sx"), F.col("time_period").alias("t"), "obs_value")
    cells = o.groupBy("doc_id", "ci", "ci_name", "sx", "t").agg(F.sum(F.col("obs_value").cast(SUM_TYPE)).alias("v"))
    docs = _doc_cells(cells, ["ci", "ci_name", "sx", "t", "v"], v_sx=F.col("sx"), v_t=F.col("t"),
                      v_ci=F.struct(F.col("ci").alias("id"), F.col("ci_name").alias("name")))
    n_sx, n_t = F.size("v_sx"), F.size("v_t")

    def value(c: Column) -> Column:
        flat = (F.when(c["ci"].isNotNull(), _pos(F.col("v_ci"), _citizen(c))) * n_sx * n_t
                + _pos(F.col("v_sx"), c["sx"]) * n_t + _pos(F.col("v_t"), c["t"]))
        return F.struct(flat.cast("string"), c["v"].cast("double"))

    docs = docs.select("doc_id", "v_ci", "v_sx", "v_t", F.map_from_entries(F.transform("cells", value)).alias("value"))

    def category(ids: Column, labels: Column) -> Column:
        return F.struct(F.struct(
            F.map_from_arrays(ids, F.sequence(F.lit(0), F.size(ids) - 1)).alias("index"),
            F.map_from_arrays(ids, labels).alias("label")).alias("category"))

    ci_ids = F.transform("v_ci", lambda x: x["id"])
    dimension = F.create_map(
        F.lit("citizen"), category(ci_ids, F.transform("v_ci", lambda x: x["name"])),
        F.lit("sex"), category(F.col("v_sx"), F.col("v_sx")),
        F.lit("time"), category(F.col("v_t"), F.col("v_t")))
    doc = F.struct(F.array(F.lit("citizen"), F.lit("sex"), F.lit("time")).alias("id"),
                   F.array(F.size("v_ci"), n_sx, n_t).alias("size"), dimension.alias("dimension"),
                   F.col("value"))
    return docs.select("doc_id", F.to_json(doc).alias("doc"))


def _sheet_row(no: Column, cells: Column) -> Column:
    return F.struct(no.cast("int").alias("row_no"), cells.cast("array<string>").alias("cells"))


def sheet_docs(obs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Multi-header sheets as rows (sheet_id, row_no, cells): title, blank, years,
    ``YYYY Total | Q1`` headers, months, one row per origin, then a source footer.
    The first origin row of a sheet also emits the five header rows and the last
    one the footer, so the whole sheet comes out of one pass."""
    o = _chunked(obs, chunk, F.col("counterpart_name").alias("name"), "year", "obs_value")
    cells = o.groupBy("doc_id", "name", "year").agg(F.sum(F.col("obs_value").cast(SUM_TYPE)).alias("v"))
    cells = _doc_lists(cells, years=F.col("year"))
    per_name = (cells.groupBy("doc_id", "name", "years")
                .agg(F.map_from_entries(F.collect_list(F.struct("year", "v"))).alias("m")))
    w = Window.partitionBy("doc_id").orderBy("name")  # at most `chunk` names per sheet
    per_name = per_name.select("*", F.row_number().over(w).alias("_i"),
                               F.count(F.lit(1)).over(Window.partitionBy("doc_id")).alias("_n"))
    ys = F.col("years")
    lit = F.lit
    data = _sheet_row(F.col("_i") + 4, F.concat(F.array("name"), F.flatten(F.transform(ys, lambda y: F.array(
        F.coalesce(F.try_element_at(F.col("m"), y).cast("string"), lit("")),
        F.coalesce(F.round(F.try_element_at(F.col("m"), y) / 4, 2).cast("string"), lit("")))))))
    header = [
        _sheet_row(lit(0), F.array(lit("Permanent residents by country of citizenship"))),
        _sheet_row(lit(1), F.array()),
        _sheet_row(lit(2), F.concat(F.array(lit("")), F.flatten(F.transform(
            ys, lambda y: F.array(y.cast("string"), lit("")))))),
        _sheet_row(lit(3), F.concat(F.array(lit("")), F.flatten(F.transform(
            ys, lambda y: F.array(F.concat(y.cast("string"), lit(" Total")), lit("Q1")))))),
        _sheet_row(lit(4), F.concat(F.array(lit("")), F.flatten(F.transform(
            ys, lambda y: F.array(lit("Jan"), lit("Q1 Total")))))),
    ]
    footer = _sheet_row(F.col("_n") + 5, F.array(lit("Source: IRCC"), lit("")))
    empty = F.array().cast(SHEET_ROW)
    rows = F.concat(F.when(F.col("_i") == 1, F.array(*header)).otherwise(empty), F.array(data),
                    F.when(F.col("_i") == F.col("_n"), F.array(footer)).otherwise(empty))
    return per_name.select(F.col("doc_id").alias("sheet_id"), F.inline(rows))
