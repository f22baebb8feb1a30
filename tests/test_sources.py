import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.sources import files as FS
from lakeloom.sources import text as TXT


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        FS.read_claims(spark, str(tmp_path / "nope.csv")).collect()


def test_csv_round_trip_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("Europe 3", "a;b", 1), ("Asia Pacific 1", "c", 2)], "REGION string, t string, n int")
    out = str(tmp_path / "out")
    FS.write_csv(df, out, mode="overwrite", sep=";", partition_by=["REGION"])
    back = FS.read_csv(spark, out, sep=";", infer_schema=True)
    assert back.count() == 2 and set(back.columns) == {"t", "n", "REGION"}


def test_positional_parse_strict_and_lenient(spark):
    lines = spark.createDataFrame([("ITA,Italy,B11,Inflows,TOT,Total,DEU,Germany,2010,2010,1000",),
                                   ("ITA,Italy,B11,Inflows,TOT,Total,DEU,Germany,2010,2010,x",)], "value string")
    p = TXT.parse_positional(lines).collect()
    assert p[0].Value == 1000 and p[0].Country == "Germany" and p[1].Value is None and p[1]._bad_fields == 1
    with pytest.raises(Exception):
        TXT.parse_positional(lines, strict=True).collect()


def test_characters(spark):
    df = spark.createDataFrame([("ab😀",)], "t string")
    assert [r[0] for r in df.select(TXT.characters(F.col("t"))).collect()] == ["a", "b", "😀"]


def test_discovery_and_layouts(spark, tmp_path):
    row = "ITA,Italy,B11,Moves,TOT,All,FIN,Finland,2004,2004,{}\n"
    (tmp_path / "oecd_italy.csv").write_text(row.format(1))
    (tmp_path / "oecd_italy2.csv").write_text(row.format(2))
    (tmp_path / "un_canada.csv").write_text("obs_value,ref_area,time_period\n3,CAN,1999\n")
    (tmp_path / "who_peru.csv").write_text("x\n")
    (tmp_path / "un_peru.xlsx").write_text("not read")
    found = FS.discover(spark, str(tmp_path), "oecd", None)
    assert {r.file_name for r in found.collect()} == {"oecd_italy.csv", "oecd_italy2.csv"}
    assert {(r.file_src, r.file_country) for r in FS.discover(spark, str(tmp_path)).collect()} == {
        ("oecd", "italy"), ("oecd", "italy2"), ("un", "canada"), ("who", "peru"), ("un", "peru")}
    assert [r.obs_value for r in FS.load_fallback(spark, str(tmp_path), "oecd", "italy*").collect()] == [1.0]  # the first file wins
    un = FS.load_fallback(spark, str(tmp_path), "un", "canada").collect()
    assert [(r.ref_area, r.time_period, r.obs_value, r.source_dataset) for r in un] == [("CAN", "1999", 3.0, "FALLBACK_CSV")]
    for src, country, error in (("un", "peru", ValueError), ("who", "peru", ValueError), ("un", "chile", FileNotFoundError)):
        with pytest.raises(error):
            FS.load_fallback(spark, str(tmp_path), src, country)


def test_canonical_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ref_area,counterpart,obs_value\nITA,FIN,1\n")
    (tmp_path / "b.csv").write_text("counterpart,obs_value,ref_area\nFIN,2,ITA\n")
    with pytest.raises(Exception):
        FS.read_canonical_csv(spark, str(tmp_path)).collect()


def test_file_beyond_the_limit_is_listed(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"abcdef")
    got = {r.file_name: (r.size_bytes, r.md5 is None) for r in FS.file_audit(spark, str(tmp_path / "*.bin"), max_bytes=3).collect()}
    assert got == {"a.bin": (3, False), "b.bin": (6, True)}


def test_file_audit(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"abc")
    r = FS.file_audit(spark, str(tmp_path / "*.txt")).first()
    assert (r.file_name, r.size_bytes, r.md5) == ("a.txt", 3, "900150983cd24fb0d6963f7d28e17f72")
    assert r.sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_file_audit_of_files_too_large_for_one_value(spark, tmp_path):
    import hashlib
    data = {"a.bin": b"abc", "b c%20.bin": b"x" * 9_000_001}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = {r.file_name: (r.size_bytes, r.md5, r.sha256) for r in FS.file_audit(spark, str(tmp_path / "*.bin"), whole_bytes=3).collect()}
    assert got == {n: (len(c), hashlib.md5(c).hexdigest(), hashlib.sha256(c).hexdigest()) for n, c in data.items()}


def _digests(files):
    return {n: (len(c), hashlib.md5(c).hexdigest(), hashlib.sha256(c).hexdigest()) for n, c in files.items()}


def _audited(spark, path, **options):
    rows = FS.file_audit(spark, path, **options).collect()
    got = {r.file_name: (r.size_bytes, r.md5, r.sha256) for r in rows}
    assert len(got) == len(rows) and all(r.modified_at and r.path.endswith("/" + r.file_name) for r in rows)
    return got


@pytest.fixture
def store(spark, tmp_path):
    """tmp_path as a store that only Spark's readers open."""
    name = tmp_path.name.replace("_", "-")
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}")
    return f"viewfs://{name}/in"


@pytest.mark.parametrize("local", [True, False])
def test_file_audit_holds_no_large_file(spark, tmp_path, store, local):
    # maxLength fails any read of more as one value, of any file
    files = {"a.bin": b"abc", "b.bin": random.Random(1).randbytes(FS._DIGEST_BLOCK + 1)}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", FS._DIGEST_BLOCK)
    try:
        assert _audited(spark, f"{tmp_path if local else store}/*.bin") == _digests(files)
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_file_audit_of_a_store_puts_split_files_together(spark, tmp_path, store):
    noise, mark = random.Random(2).randbytes(200_000), b"\xef\xbb\xbf"
    files = {"noise.bin": noise, "one line.bin": b"x" * 200_000, "line ends%20.bin": b"\n" * 200_000, "\u00e9 +.bin": noise + b"\r\n", "returns.bin": b"\r" * 9,
             "mark.bin": mark + noise, "mark end.bin": mark + noise + b"\n", "two marks.bin": mark * 2, "a mark.bin": mark, "a mark end.bin": mark + b"\n",
             "part.bin/part-0.bin": noise[:9], "part.bin/_SUCCESS": b"long enough"}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    wanted = {n.rsplit("/", 1)[-1]: d for n, d in _digests(files).items() if "_SUCCESS" not in n}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16_384)
    try:
        assert _audited(spark, f"{store}/*.bin", whole_bytes=3) == wanted
        modified = [{(r.file_name, r.modified_at) for r in FS.file_audit(spark, f"{at}/*.bin", whole_bytes=3).collect()} for at in (tmp_path, store)]
        assert modified[0] == modified[1]
        short = _audited(spark, f"{store}/*.bin", whole_bytes=3, max_bytes=9)
        assert short == {n: d if d[0] <= 9 else (d[0], None, None) for n, d in wanted.items()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_audit_of_a_store_reads_packed_files_as_they_are(spark, tmp_path, store):
    import gzip
    files = {"a.gz": gzip.compress(random.Random(3).randbytes(FS._DIGEST_BLOCK)), "b.bz2": b"not packed" * 500_000, "c.GZ": b"c" * (FS._DIGEST_BLOCK + 1)}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    assert _audited(spark, f"{store}/*") == _digests(files)


def test_pieces_that_do_not_add_up_fail():
    part = FS._PieceDigests("x", 0, 9)
    part.add(b"abc\n")
    with pytest.raises(OSError, match="9 bytes listed, 4 read"):
        part.row()


def test_snapshot_manifest_and_freshness(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    FS.write_snapshot(df, str(tmp_path), "OECD_MIG", {"ref_area": "ITA"}, t0, spark)
    FS.write_snapshot(df.union(df), str(tmp_path), "OECD_MIG", {"ref_area": "ITA"}, t0 + dt.timedelta(hours=10), spark)
    FS.write_snapshot(df, str(tmp_path), "EUROSTAT", {"dataset": "x"}, t0, spark)
    manifest = spark.read.parquet(str(tmp_path / "manifest")).withColumn("source", F.col("fetcher"))
    assert spark.read.parquet(str(tmp_path / "snapshots" / "OECD_MIG")).count() == 6
    fresh = FS.fresh_snapshots(manifest, t0 + dt.timedelta(hours=20), key=("fetcher", "params")).collect()
    # OECD (24 h) keeps its latest snapshot; EUROSTAT (12 h) is stale after 20 h
    assert [(r.fetcher, r.row_count) for r in fresh] == [("OECD_MIG", 4)]


def test_json_and_canonical_and_migration_readers(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"name": "x", "stars": 4.5, "attributes": {"a": "1"}}\n{"name": "y", "stars": 3}\n')
    j = FS.read_json(spark, str(tmp_path / "b.json"))
    assert j.count() == 2 and "attributes" in j.columns
    (tmp_path / "canon.csv").write_text("ref_area,time_period,year,obs_value,source_dataset\nCAN,2020,2020,5.5,UN\n")
    c = FS.read_canonical_csv(spark, str(tmp_path / "canon.csv"), fetch_ts=dt.datetime(2024, 1, 1)).first()
    assert (c.ref_area, c.time_period, c.obs_value, c.source_dataset) == ("CAN", "2020", 5.5, "FALLBACK_CSV")
    (tmp_path / "m.csv").write_text("ITA,Italy,B11,Inflows,TOT,Total,DEU,Germany,2010,2010,1000\n")
    assert FS.read_migration_csv(spark, str(tmp_path / "m.csv")).first().Value == "1000"
