"""Source normalisation into the canonical observation table.

Each source document is one row; parsing is ``from_json`` + ``explode`` +
array/map expressions, so documents are decoded in parallel and nothing goes
through the driver. Dimension lookups travel with their own document's rows.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import rules as R
from lakeloom.functions.columns import code_or_prefix, coerce_numeric, literal_map, sex_code, year_of_period
from lakeloom.operators.observations import province_iso, to_canonical

# FIXED VALUES — source-specific labels.
SEX_TO_GENDER = {"_T": "Total", "T": "Total", "M": "Male", "F": "Female"}
AREA_TO_NAME = {"ITA": "Italy", "CAN": "Canada"}
CITIZEN_DIMS = ["citizen", "cit_go", "partner", "c_birth"]
ANNUAL_TOTAL_PATTERN = r"(?i)^(\d{4})\s*Total$"

_VALUES = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))
_DIMS = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("values", _VALUES)]))
SDMX_SCHEMA = T.StructType([T.StructField("data", T.StructType([
    T.StructField("dataSets", T.ArrayType(T.StructType([T.StructField("series", T.MapType(
        T.StringType(), T.StructType([T.StructField("observations", T.MapType(
            T.StringType(), T.ArrayType(T.StringType())))])))]))),
    T.StructField("structures", T.ArrayType(T.StructType([T.StructField("dimensions", T.StructType([
        T.StructField("series", _DIMS), T.StructField("observation", _DIMS)]))]))),
]))])

JSONSTAT_SCHEMA = T.StructType([
    T.StructField("id", T.ArrayType(T.StringType())),
    T.StructField("size", T.ArrayType(T.LongType())),
    T.StructField("dimension", T.MapType(T.StringType(), T.StructType([T.StructField("category", T.StructType([
        T.StructField("index", T.MapType(T.StringType(), T.LongType())),
        T.StructField("label", T.MapType(T.StringType(), T.StringType()))]))]))),
    T.StructField("value", T.MapType(T.StringType(), T.DoubleType())),
])


def _fetch_ts(ts) -> Column:
    if ts is None:
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")


def _pos_in(values: Column, code: str | None) -> Column:
    """0-based position of ``code`` among a dimension's value ids, NULL when absent."""
    if code is None:
        return F.lit(None).cast("int")
    p = F.array_position(F.transform(values, lambda v: v["id"]), F.lit(code)).cast("int")
    return F.when(p > 0, p - 1)


def _dim_index(ids: Column, name: str) -> Column:
    p = F.array_position(ids, F.lit(name)).cast("int")
    return F.when(p > 0, p - 1)


def norm_sdmx(docs: DataFrame, ref_area: str | None = None, var_code: str | None = None,
              sex: str | None = None, doc_col: str = "doc", fetch_ts=None) -> DataFrame:
    """SDMX-JSON series documents → canonical rows.

    The series key ``"0:1:0:0"`` holds positions into the series dimensions.
    Given filters keep only their country / measure; the sex filter applies only
    when that sex code exists (``T`` is read as ``_T``). ``None`` filters keep
    everything (then the decoded codes are output). Keys shorter than the
    dimension list are skipped; a missing citizenship dimension gives ``UNK``;
    NULL values are dropped.
    """
    d = docs.select(F.from_json(F.col(doc_col), SDMX_SCHEMA)["data"].alias("d"))
    dims = F.get(F.col("d.structures"), F.lit(0))["dimensions"]
    sdims = dims["series"]
    ids = F.transform(sdims, lambda x: x["id"])
    sex_norm = None if sex is None else ("_T" if sex in ("T", "_T") else sex)
    base = d.select(
        sdims.alias("sd"), F.transform(F.get(dims["observation"], F.lit(0))["values"], lambda v: v["id"]).alias("times"),
        F.size(sdims).alias("nd"), _dim_index(ids, "REF_AREA").alias("ra_i"), _dim_index(ids, "MEASURE").alias("me_i"),
        _dim_index(ids, "SEX").alias("sx_i"), _dim_index(ids, "CITIZENSHIP").alias("ci_i"),
        F.map_entries(F.get(F.col("d.dataSets"), F.lit(0))["series"]).alias("series"))
    base = base.select("*",
                       _pos_in(F.get(F.col("sd"), F.col("ra_i"))["values"], ref_area).alias("ra_p"),
                       _pos_in(F.get(F.col("sd"), F.col("me_i"))["values"], var_code).alias("me_p"),
                       _pos_in(F.get(F.col("sd"), F.col("sx_i"))["values"], sex_norm).alias("sx_p"))

    def wanted(s: Column) -> Column:
        ok = F.size(s["pos"]) >= F.col("nd")
        if ref_area is not None:
            ok = ok & (F.get(s["pos"], F.col("ra_i")) == F.col("ra_p"))
        if var_code is not None:
            ok = ok & (F.get(s["pos"], F.col("me_i")) == F.col("me_p"))
        if sex is not None:
            ok = ok & (F.col("sx_p").isNull() | (F.get(s["pos"], F.col("sx_i")) == F.col("sx_p")))
        return F.coalesce(ok, F.lit(False))

    def decoded(s: Column) -> Column:
        def value(i: str) -> Column:
            return F.get(F.get(F.col("sd"), F.col(i))["values"], F.get(s["pos"], F.col(i)))
        return F.struct(value("ra_i")["id"].alias("ra"), value("me_i")["id"].alias("me"), value("sx_i")["id"].alias("sx"),
                        value("ci_i").alias("ci"), s["obs"].alias("obs"))

    # Keys are decoded inside the document, so that neither explode carries its dimension lists.
    series = F.transform("series", lambda e: F.struct(
        F.transform(F.split(e["key"], ":"), lambda p: p.try_cast("int")).alias("pos"),
        F.transform(F.map_entries(e["value"]["observations"]), lambda o: F.struct(
            F.get(F.col("times"), o["key"].try_cast("int")).alias("t"), F.get(o["value"], F.lit(0)).alias("v"),
            F.get(o["value"], F.lit(1)).alias("status"))).alias("obs")))
    base = base.withColumn("series", series).select("sd", "nd", "ra_i", "me_i", "sx_i", "ci_i", "ra_p", "me_p", "sx_p", F.filter("series", wanted).alias("series"))
    s = base.select(F.explode(F.transform("series", decoded)).alias("s"))
    o = s.select("s.ra", "s.me", "s.sx", "s.ci", F.explode("s.obs").alias("o"))
    cit = F.col("ci")
    time_code = F.coalesce(F.col("o.t"), F.lit(""))
    ra_code = F.lit(ref_area) if ref_area is not None else F.col("ra")
    me_code = F.lit(var_code) if var_code is not None else F.col("me")
    sx_id = F.coalesce("sx", F.lit("_T"))
    sx_out = F.lit(sex_norm) if sex_norm is not None else sx_id
    out = o.select(
        ra_code.alias("ref_area"),
        F.coalesce(F.try_element_at(literal_map(AREA_TO_NAME), ra_code), ra_code).alias("ref_area_name"),
        F.when(cit.isNull(), F.lit("UNK")).otherwise(cit["id"]).alias("counterpart"),
        F.when(cit.isNull(), F.lit("Unknown")).otherwise(F.coalesce(cit["name"], cit["id"])).alias("counterpart_name"),
        time_code.alias("time_period"),
        year_of_period(time_code).alias("year"),
        me_code.alias("var_code"),
        F.coalesce(F.try_element_at(literal_map(R.VAR_TO_METRIC), me_code), me_code).alias("metric"),
        sx_out.alias("sex"),
        F.coalesce(F.try_element_at(literal_map(SEX_TO_GENDER), sx_id), F.lit("Total")).alias("gender"),
        F.col("o.v").try_cast("double").alias("obs_value"),
        F.col("o.status").alias("obs_status"),
        F.lit("OECD_MIG").alias("source_dataset"),
        _fetch_ts(fetch_ts).alias("fetch_ts"),
    ).where(F.col("obs_value").isNotNull())
    return to_canonical(out)


def norm_jsonstat(docs: DataFrame, var_code: str = "B11", metric: str = "Inflows of Foreign Population",
                  sex: str | None = "T", ref_area: str = "ITA", ref_area_name: str = "Italy",
                  doc_col: str = "doc", fetch_ts=None) -> DataFrame:
    """JSON-stat 2.0 → canonical rows. The flat value key is decoded with
    row-major strides (stride_i = product of the later sizes); the citizen
    dimension is ``citizen`` else ``cit_go``/``partner``/``c_birth``; time is
    ``time`` else the last dimension; unknown positions give ``UNK`` / ``""``.
    Of a document with a ``sex`` dimension the cells of the sex asked for are
    kept (``None``: all, under their own code); one without is of that sex."""
    j = docs.select(F.from_json(F.col(doc_col), JSONSTAT_SCHEMA).alias("j")).select("j.*")
    n = F.size("id")

    def at(name: str) -> Column:
        return _dim_index(F.col("id"), name)

    def codes(index: Column) -> Column:  # a dimension's codes in the order of their positions
        places = F.try_element_at(F.col("dimension"), F.get(F.col("id"), index))["category"]["index"]
        return F.transform(F.array_sort(F.transform(F.map_entries(places), lambda e: F.struct(e["value"].alias("p"), e["key"].alias("code")))),
                           lambda e: e["code"])

    def labels(index: Column) -> Column:
        return F.try_element_at(F.col("dimension"), F.get(F.col("id"), index))["category"]["label"]

    cit, time, sx_i = F.coalesce(*[at(c) for c in CITIZEN_DIMS]), F.coalesce(at("time"), n - 1), at("sex")
    later = lambda i: F.aggregate(F.slice("size", i + 2, F.greatest(n - i - 1, F.lit(0))), F.lit(1).cast("long"), lambda a, x: a * x)
    base = j.select(
        *[f(i).alias(f"{k}_{name}") for k, i in (("cit", cit), ("time", time), ("sex", sx_i))
          for name, f in (("codes", codes), ("step", later), ("size", lambda i: F.get(F.col("size"), i)))],
        labels(cit).alias("cit_label"), F.map_entries("value").alias("cells"))

    def code(k: str, key: Column) -> Column:
        return F.get(F.col(f"{k}_codes"), F.pmod(F.floor(key / F.col(f"{k}_step")), F.col(f"{k}_size")).cast("int"))

    def cell(e: Column) -> Column:
        key = e["key"].try_cast("long")
        c = code("cit", key)
        return F.struct(c.alias("c"), F.try_element_at(F.col("cit_label"), c).alias("label"), code("time", key).alias("t"),
                        F.col("sex_codes").isNotNull().alias("has_sex"), code("sex", key).alias("sx"), e["value"].alias("v"))

    # Cells are decoded inside the document, so that the explode carries no dimension.
    o = base.select(F.explode(F.transform("cells", cell)).alias("o")).where(F.col("o.v").isNotNull())
    asked = (sex or "T").upper()
    sx = F.when(F.col("o.has_sex"), F.col("o.sx")).otherwise(F.lit(asked))
    if sex is not None:
        o = o.where(~F.col("o.has_sex") | (F.upper("o.sx") == asked))
    time_code = F.coalesce("o.t", F.lit(""))
    out = o.select(
        F.lit(ref_area).alias("ref_area"), F.lit(ref_area_name).alias("ref_area_name"),
        F.coalesce("o.c", F.lit("UNK")).alias("counterpart"),
        F.coalesce("o.label", "o.c", F.lit("Unknown")).alias("counterpart_name"),
        time_code.alias("time_period"), year_of_period(time_code).alias("year"),
        F.lit(var_code).alias("var_code"), F.lit(metric).alias("metric"), sx.alias("sex"),
        F.coalesce(F.try_element_at(literal_map(SEX_TO_GENDER), sx), F.lit("Total")).alias("gender"),
        F.col("o.v").alias("obs_value"), F.lit("EUROSTAT").alias("source_dataset"),
        _fetch_ts(fetch_ts).alias("fetch_ts"))
    return to_canonical(out)


def sheet_rows(sheets: DataFrame, sheet_col: str = "sheet_id", row_col: str = "row_no",
               cells_col: str = "cells", header_row: int = 3, first_data_row: int = 5) -> DataFrame:
    """S10 + N5 core: multi-header sheet rows → (sheet, id_value, year, obs_value).

    Annual columns come from ``header_row`` cells matching ``YYYY Total``; they
    are a per-sheet (column, year) list joined back on the sheet id. Blank ids,
    ``source…``/``note…`` footers, non-numeric and non-positive values are skipped."""
    hdr = (sheets.where(F.col(row_col) == header_row)
           .select(sheet_col, F.posexplode(cells_col).alias("col_idx", "h"))
           .where(F.trim("h").rlike(ANNUAL_TOTAL_PATTERN))
           .select(sheet_col, "col_idx", F.regexp_extract(F.trim("h"), ANNUAL_TOTAL_PATTERN, 1).cast("int").alias("year")))
    data = sheets.where(F.col(row_col) >= first_data_row)
    ident = F.trim(F.get(F.col(cells_col), 0))
    data = (data.select(sheet_col, row_col, cells_col, ident.alias("id_value"))
            .where(F.col("id_value").isNotNull() & (F.col("id_value") != "")
                   & ~F.lower("id_value").startswith("source") & ~F.lower("id_value").startswith("note")))
    j = data.join(hdr, sheet_col)
    val = coerce_numeric(F.get(F.col(cells_col), F.col("col_idx")))
    return (j.select(sheet_col, row_col, "id_value", "year", val.alias("obs_value"))
            .where(F.col("obs_value").isNotNull() & (F.col("obs_value") > 0)))


def norm_sheet(rows: DataFrame, mode: str = "citizenship", iso_lookup: DataFrame | None = None,
               fetch_ts=None) -> DataFrame:
    """Sheet rows → canonical (Canada, permanent residents); ``citizenship``
    maps names to ISO3 codes, ``province`` maps provinces to ISO codes."""
    if mode == "citizenship":
        if iso_lookup is None:
            raise ValueError("citizenship mode needs the name → ISO3 lookup DataFrame")
        lk = iso_lookup  # the planner broadcasts it if its size allows
        j = rows.join(lk, F.col("id_value") == lk.lk_name, "left")
        counterpart = code_or_prefix("id_value", F.col("lk_code"))
        cname = F.col("id_value")
        province = F.lit(None).cast("string")
    elif mode == "province":
        j = rows
        counterpart, cname = F.lit("_T"), F.lit("All Countries")
        province = province_iso("id_value")
    else:
        raise ValueError(f"unsupported sheet mode {mode}")
    out = j.select(
        F.lit("CAN").alias("ref_area"), F.lit("Canada").alias("ref_area_name"),
        counterpart.alias("counterpart"), cname.alias("counterpart_name"),
        F.col("year").cast("string").alias("time_period"), F.col("year").cast("int").alias("year"),
        F.lit("PR").alias("var_code"), F.lit("Permanent Residents").alias("metric"),
        F.lit("_T").alias("sex"), F.lit("Total").alias("gender"), province.alias("province"),
        F.col("obs_value"), F.lit("IRCC").alias("source_dataset"), _fetch_ts(fetch_ts).alias("fetch_ts"))
    return to_canonical(out)


def norm_csv(records: DataFrame, fetch_ts=None, ref_area: str = "ITA", ref_area_name: str = "Italy") -> DataFrame:
    """Positional migration records (11 string fields) → canonical; rows whose
    Value is missing or non-numeric are dropped."""
    v = coerce_numeric("Value")
    out = records.where(v.isNotNull()).select(
        F.lit(ref_area).alias("ref_area"), F.lit(ref_area_name).alias("ref_area_name"),
        F.trim("COU").alias("counterpart"), F.trim("Country").alias("counterpart_name"),
        F.col("Year").cast("string").alias("time_period"), F.col("Year").try_cast("int").alias("year"),
        F.trim("VAR").alias("var_code"),
        F.coalesce(F.try_element_at(literal_map(R.VAR_TO_METRIC), F.col("VAR")), F.col("Variable")).alias("metric"),
        sex_code("GEN").alias("sex"),
        F.coalesce(F.try_element_at(literal_map(R.GEN_TO_GENDER), F.trim("GEN")), F.lit("Total")).alias("gender"),
        v.alias("obs_value"), F.lit("FALLBACK_CSV").alias("source_dataset"), _fetch_ts(fetch_ts).alias("fetch_ts"))
    return to_canonical(out)


def assemble(frames: Sequence[DataFrame | None], unify_sex: bool = True,
             province_in_key: bool = True) -> DataFrame:
    """N6 core: union the available sources (None = unavailable), then priority-merge.

    Two fixes of the original behaviour, each switchable off to reproduce it:
    ``unify_sex`` maps ``_T`` to ``T`` so that sources compete for the same key,
    and ``province_in_key`` keeps one row per province (without it all province
    rows of a year share one key and only one survives)."""
    from lakeloom.operators.observations import priority_merge, union_aligned
    avail = [f for f in frames if f is not None]
    if not avail:
        raise ValueError("no source available")
    u = union_aligned(avail, keep=["row_id"])
    if unify_sex:
        u = u.withColumn("sex", F.when(F.col("sex") == "_T", F.lit("T")).otherwise(F.col("sex")))
    key = list(R.DEDUP_KEY) + (["province"] if province_in_key else [])
    return priority_merge(u, key=key)


# FIXED VALUES — sources of a country in the order of their use, and the variables asked for by default.
COUNTRY_SOURCES = {"ITA": ["OECD_MIG", "EUROSTAT", "FALLBACK_CSV"], "CAN": ["OECD_MIG", "IRCC", "FALLBACK_XLSX"]}
COUNTRY_VARIABLES = {"ITA": ["B11", "B12", "B16"], "CAN": ["B11", "PR"]}
VARIABLE_SOURCES = {"OECD_MIG", "IRCC", "FALLBACK_CSV"}  # asked for, or cut to, the wanted variables


def assemble_country(country: str, sources: dict[str, DataFrame | None], variables: Sequence[str] | None = None, **options) -> DataFrame:
    """The country's sources that are there (absent or None: unavailable), cut to
    the wanted variables where the source holds several, unioned and merged."""
    unknown = set(sources) - set(COUNTRY_SOURCES[country])
    if unknown:
        raise ValueError(f"not sources of {country}: {sorted(unknown)}")
    wanted = list(COUNTRY_VARIABLES[country] if variables is None else variables)
    frames = []
    for label in COUNTRY_SOURCES[country]:
        frame = sources.get(label)
        if frame is not None and label in VARIABLE_SOURCES:
            frame = frame.where(F.col("var_code").isin(wanted))
        frames.append(frame)
    return assemble(frames, **options)
