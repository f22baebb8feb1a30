import json
import re

import pytest
from pyspark.sql import functions as F

from lakeloom import rules as R
from lakeloom.operators import normalise as N
from lakeloom.operators.cells import norm_jsonstat_cells, norm_sdmx_cells
from lakeloom.operators.reshape import iso3_lookup

def dim(name, *values):
    return {"id": name, "values": [{"id": v, "name": v.title()} for v in values]}


def obs(*values):
    return {"observations": {str(k): [v, "p"] for k, v in enumerate(values) if v != "-"}}


# Three areas, four origins, two sexes, three quarters; measure before area, one flag dimension more.
SDMX = {"data": {
    "dataSets": [{"series": {
        "1:2:3:0:0": obs(7.25, None, 8), "1:2:0:0:0": obs("-", 31), "1:2:3:1:0": obs(4.5),   # wanted area and measure
        "0:2:3:0:0": obs(90), "1:0:3:0:0": obs(91, 92), "1:2:9:0:0": obs(5),                  # other measure, other area, no such origin
        "1:2:3": obs(93)}}],                                                                  # a key that is too short
    "structures": [{"dimensions": {
        "series": [dim("MEASURE", "STOCK", "B12"), dim("REF_AREA", "NOR", "PRT", "CAN"), dim("CITIZENSHIP", "PER", "MAR", "FIN", "VNM"),
                   dim("SEX", "_T", "F"), dim("FLAG", "X")],
        "observation": [dim("TIME_PERIOD", "2019-Q4", "2020-Q1", "2020-Q2")]}}]}}


def jsonstat(*dims, values):
    """dims: (name, codes); codes get places in their order."""
    return json.dumps({"id": [n for n, _ in dims], "size": [len(c) for _, c in dims], "value": values,
                       "dimension": {n: {"category": {"index": {c: k for k, c in enumerate(codes)}, "label": {c: c.lower() for c in codes}}} for n, codes in dims}})


def test_sdmx_filters_and_decoding(spark):
    docs = spark.createDataFrame([(json.dumps(SDMX),)], "doc string")
    rows = sorted((r.counterpart, r.counterpart_name, r.time_period, r.year, r.obs_value, r.obs_status, r.sex, r.ref_area_name)
                  for r in N.norm_sdmx(docs, "CAN", "B12", "T").collect())
    assert rows == [("PER", "Per", "2020-Q1", 2020, 31.0, "p", "_T", "Canada"),
                    ("UNK", "Unknown", "2019-Q4", 2019, 5.0, "p", "_T", "Canada"),
                    ("VNM", "Vnm", "2019-Q4", 2019, 7.25, "p", "_T", "Canada"), ("VNM", "Vnm", "2020-Q2", 2020, 8.0, "p", "_T", "Canada")]
    everything = N.norm_sdmx(docs).collect()
    assert sorted(r.obs_value for r in everything) == [4.5, 5.0, 7.25, 8.0, 31.0, 90.0, 91.0, 92.0]
    assert {(r.ref_area, r.var_code, r.sex, r.gender) for r in everything if r.obs_value in (4.5, 90.0, 91.0)} == {
        ("CAN", "B12", "F", "Female"), ("CAN", "STOCK", "_T", "Total"), ("NOR", "B12", "_T", "Total")}


def test_sdmx_sex_not_listed_means_no_sex_filter(spark):
    docs = spark.createDataFrame([(json.dumps(SDMX),)], "doc string")
    assert N.norm_sdmx(docs, "CAN", "B12", "M").count() == 5


def test_jsonstat_strides_and_sex(spark):
    cells = {str(k): float(100 + k) for k in range(2 * 3 * 2 * 4) if k not in (5, 17)}
    doc = jsonstat(("unit", ["N", "PC"]), ("c_birth", ["BRA", "KEN", "THA"]), ("sex", ["F", "T"]), ("time", ["1998", "2001", "2003", "2004"]), values=cells)
    docs = spark.createDataFrame([(doc,)], "doc string")
    want = {(c, y, s): [float(100 + ((u * 3 + i) * 2 + j) * 4 + k) for u in range(2) if str(((u * 3 + i) * 2 + j) * 4 + k) in cells]
            for i, c in enumerate(["BRA", "KEN", "THA"]) for j, s in enumerate("FT") for k, y in enumerate(["1998", "2001", "2003", "2004"])}
    got = {}
    for r in N.norm_jsonstat(docs, sex=None).collect():
        assert r.counterpart_name == r.counterpart.lower() and r.gender == {"F": "Female", "T": "Total"}[r.sex]
        got.setdefault((r.counterpart, r.time_period, r.sex), []).append(r.obs_value)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert {r.sex for r in N.norm_jsonstat(docs).collect()} == {"T"} and N.norm_jsonstat(docs, sex="M").count() == 0


def test_jsonstat_without_citizens_or_sex(spark):
    docs = spark.createDataFrame([(jsonstat(("geo", ["PT"]), ("year", ["1990", "1991"]), values={"0": 3.5, "1": None, "9": 1.0}),)], "doc string")
    got = [(r.counterpart, r.counterpart_name, r.time_period, r.sex, r.obs_value) for r in N.norm_jsonstat(docs, sex="F").collect()]
    assert ("UNK", "Unknown", "1990", "F", 3.5) in got


def test_explodes_carry_no_dimension(spark):
    """What an explode passes on beside its own rows: no list or map of a document's dimensions."""
    docs = spark.createDataFrame([(json.dumps(SDMX),)], "doc string")
    for df in (N.norm_sdmx(docs, "CAN", "B12", "T"), N.norm_jsonstat(docs)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        passed_on = re.findall(r"\), \[([^\[\]]*)\], (?:true|false), \[[^\[\]]*\]$", plan, re.M)
        for names in passed_on:
            assert not re.search(r"\b(sd|dimension|\w+_codes|cit_label|times|series|cells)#", names)


@pytest.mark.parametrize("cells", [1 << 18, 8])
def test_sdmx_by_cells(spark, cells):
    """The rows of the other reader, also where a document's sides are spread over many copies."""
    odd = json.loads(json.dumps(SDMX))
    odd["data"]["structures"][0]["dimensions"]["series"] = [d for d in SDMX["data"]["structures"][0]["dimensions"]["series"] if d["id"] not in ("CITIZENSHIP", "SEX")]
    odd["data"]["dataSets"][0]["series"] = {"1:2:0": {"observations": {"0": [3], "7": ["4.5", None], "x": [5, "p"], "1": ["n/a"], "2": []}}, "1:x:0": obs(6), "5:1:0": obs(8)}
    texts = [json.dumps(SDMX), json.dumps(odd), None, "{broken", "{}", "[]", json.dumps({"data": {"dataSets": []}})]
    docs = spark.createDataFrame([(k if t else None, t) for k, t in enumerate(texts)] + [(0, texts[0]), (9, texts[0]), (None, texts[0])], "doc_id int, doc string")
    at = "2024-01-01"
    for asked in ((), ("CAN", "B12", "T"), ("CAN", "B12", "F"), (None, None, "F"), ("NOR", None, None), ("CAN", "B99", None), ("CAN", None, "M")):
        want, got = N.norm_sdmx(docs, *asked, fetch_ts=at), norm_sdmx_cells(docs, *asked, fetch_ts=at, cells=cells)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), asked
    assert norm_sdmx_cells(docs.limit(0), fetch_ts=at).count() == 0


def sheet(spark):
    rows = [["A title"], None, ["year", "", "2007", "2008"], ["", "spring", "2007 total", "2008  Total", "2009 Totals"],
            ["", "", "", ""], [" Peru ", "3", "41", "17.5"], ["Morocco", "9", "", "260"],
            ["Nowhere", "1", "0", "n/a"], ["", "5", "6", "7"], ["Notes: none"]]
    return spark.createDataFrame([(1, i, r) for i, r in enumerate(rows)], "sheet_id int, row_no int, cells array<string>")


def test_multi_header_sheet(spark):
    rows = N.sheet_rows(sheet(spark))
    got = sorted((r.id_value, r.year, r.obs_value) for r in rows.collect())
    assert got == [("Morocco", 2008, 260.0), ("Peru", 2007, 41.0), ("Peru", 2008, 17.5)]
    canon = N.norm_sheet(rows, "citizenship", iso3_lookup(spark))
    assert {r.counterpart for r in canon.collect()} == {"MOR" if "Morocco" not in R.COUNTRY_ISO3 else R.COUNTRY_ISO3["Morocco"], "PER" if "Peru" not in R.COUNTRY_ISO3 else R.COUNTRY_ISO3["Peru"]}
    prov = N.norm_sheet(rows, "province")
    assert {r.counterpart for r in prov.collect()} == {"_T"}


def test_norm_csv(spark):
    from lakeloom.schemas import MIGRATION_FILE_SCHEMA
    rows = [("ITA", "Italy", "B11", "Moves", "TOT", "All", "  VNM", "Vietnam ", "1996", "1996", "88"),
            ("ITA", "Italy", "Q7", "Something else", "MAS", "Men", "FIN", "Finland", "2004", "2004", "many"),
            ("ITA", "Italy", "Q7", "Something else", "FEM", "Women", "FIN", "Finland", "2004", "2004", "0.5")]
    out = N.norm_csv(spark.createDataFrame(rows, MIGRATION_FILE_SCHEMA)).collect()
    got = sorted((r.counterpart, r.counterpart_name, r.metric, r.sex, r.gender, r.obs_value) for r in out)
    assert [(g[0], g[1], g[3], g[5]) for g in got] == [("FIN", "Finland", "F", 0.5), ("VNM", "Vietnam", "T", 88.0)]
    assert got[0][2] == "Something else" and got[1][2] == R.VAR_TO_METRIC["B11"]


def test_country_sources(spark):
    import pytest
    from lakeloom.schemas import MIGRATION_FILE_SCHEMA
    rows = [("ITA", "Italy", v, "x", "TOT", "All", "FIN", "Finland", "2004", "2004", "5") for v in ("B11", "B99")]
    csv = N.norm_csv(spark.createDataFrame(rows, MIGRATION_FILE_SCHEMA))
    assert [r.var_code for r in N.assemble_country("ITA", {"FALLBACK_CSV": csv, "OECD_MIG": None}).collect()] == ["B11"]
    assert N.assemble_country("ITA", {"FALLBACK_CSV": csv}, ["B99", "B11"]).count() == 2
    with pytest.raises(ValueError):
        N.assemble_country("CAN", {"FALLBACK_CSV": csv})
    with pytest.raises(ValueError):
        N.assemble_country("ITA", {"FALLBACK_CSV": None})


def test_assemble_requires_a_source(spark):
    import pytest
    with pytest.raises(ValueError):
        N.assemble([None, None])


def test_assemble_keeps_provinces_and_unifies_sex(spark):
    rows = N.sheet_rows(sheet(spark)).withColumn("id_value", F.when(F.col("id_value") == "Peru", F.lit("Ontario"))
                                                 .otherwise(F.lit("Quebec")))
    prov = N.norm_sheet(rows, "province")
    merged = N.assemble([prov])
    assert merged.count() == 3 and {r.province for r in merged.collect()} == {"CA-ON", "CA-QC"}
    assert N.assemble([prov], province_in_key=False).count() == 2  # the original behaviour
    assert {r.sex for r in merged.collect()} == {"T"}


def test_cells_as_rows_equal_the_decoding_inside_documents(spark):
    cells = {str(k): float(100 + k) for k in range(2 * 3 * 2 * 4) if k not in (5, 17)}
    dims = [("unit", ["N", "PC"]), ("c_birth", ["BRA", "KEN", "THA"]), ("sex", ["F", "T"]), ("time", ["1998", "2001", "2003", "2004"])]
    lone = jsonstat(("geo", ["PT"]), ("year", ["1990", "1991"]), values={"0": 3.5, "1": None, "9": 1.0})
    docs = [(1, jsonstat(*dims, values=cells)), (2, lone), (3, None), (4, "{"), (None, jsonstat(*dims[1:], values={"3": 1.5})), (1, lone), (1, lone)]
    df = spark.createDataFrame(docs, "doc_id long, doc string")
    plain = lambda x: sorted(map(str, x.drop("fetch_ts").collect()))
    for sex in (None, "T", "F"):
        want = plain(N.norm_jsonstat(df, sex=sex))
        assert want and plain(norm_jsonstat_cells(df, sex=sex)) == want and plain(norm_jsonstat_cells(df, sex=sex, cells=5)) == want
    listed = json.loads(jsonstat(("c_birth", ["BRA", "KEN"]), ("time", ["1998", "2001"]), values=[1, None, 3, 4]))
    for d, codes in (("c_birth", ["BRA", "KEN"]), ("time", ["1998", "2001"])):
        listed["dimension"][d]["category"]["index"] = codes
    got = norm_jsonstat_cells(spark.createDataFrame([(1, json.dumps(listed))], df.schema)).collect()
    assert sorted((r.counterpart, r.counterpart_name, r.year, r.obs_value) for r in got) == [("BRA", "bra", 1998, 1.0), ("KEN", "ken", 1998, 3.0), ("KEN", "ken", 2001, 4.0)]
    assert norm_jsonstat_cells(df.limit(0)).count() == 0


def test_documents_of_observations(spark):
    from lakeloom.plans.docbuild import jsonstat_docs, sdmx_docs
    rows = [(1, "EUR", "B11", "T", "N1", "One", "1995", 1.5), (2, "EUR", "B11", "T", "N1", "One", "1995", 2.25), (3, "EUR", "B11", "T", "N1", "One", "1996", 4.0),
            (4, "ASI", "B12", "F", "N2", None, "1996", 8.0), (5, None, "B12", "F", "N1", "One", "1995", 16.0), (70, "EUR", "B11", "M", "N2", "Two", "1995", 32.0)]
    obs = spark.createDataFrame(rows, "row_id long, ref_area string, var_code string, sex string, counterpart string, counterpart_name string, time_period string, obs_value double")
    docs = {r.doc_id: json.loads(r.doc)["data"] for r in sdmx_docs(obs).collect()}
    assert sorted(docs) == [0, 1]
    series, dims = docs[0]["dataSets"][0]["series"], docs[0]["structures"][0]["dimensions"]
    assert [[v["id"] for v in d["values"]] for d in dims["series"]] == [["ASI", "EUR"], ["N1", "N2"], ["B11", "B12"], ["F", "_T"]]
    assert {k: {t: v[0] for t, v in s["observations"].items()} for k, s in series.items()} == {
        "1:0:0:1": {"0": "3.7500", "1": "4.0000"}, "0:1:1:0": {"1": "8.0000"}, "0:1:0": {"0": "16.0000"}}  # no place without a code: a short key
    got = sorted((r.ref_area, r.counterpart, r.counterpart_name, r.time_period, r.obs_value) for r in N.norm_sdmx(sdmx_docs(obs)).collect())
    assert got == [("ASI", "N2", "N2", "1996", 8.0), ("EUR", "N1", "One", "1995", 3.75), ("EUR", "N1", "One", "1996", 4.0), ("EUR", "N2", "Two", "1995", 32.0)]
    flat = {r.doc_id: json.loads(r.doc) for r in jsonstat_docs(obs).collect()}
    assert flat[0]["size"] == [2, 2, 2] and flat[0]["value"] == {"0": 16.0, "2": 3.75, "3": 4.0, "5": 8.0}
