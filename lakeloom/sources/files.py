"""File sources and sinks: CSV (S1, S2, S6, S7, S15), JSON (S3), file discovery
(S8), binary-file audit (S13), snapshots with a manifest (S16) and the
freshness rule (S17).

Readers take declared schemas; discovery is a glob listing.
"""

from __future__ import annotations

import datetime as _dt
import functools
import getpass
import hashlib
import itertools
import re
from typing import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import rules as R
from lakeloom.schemas import CANONICAL_SCHEMA, CLAIMS_SCHEMA, MIGRATION_FILE_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True,
             sep: str = ",", infer_schema: bool = False) -> DataFrame:
    """CSV with a declared schema (all strings by default for claim files);
    a missing path fails with Spark's own PATH_NOT_FOUND error."""
    r = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def read_claims(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return read_csv(spark, path, CLAIMS_SCHEMA, header=True, sep=sep)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: JSON lines."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_migration_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 11-field migration file; rows without a numeric Value are
    dropped later by the normaliser (N1)."""
    return spark.read.schema(MIGRATION_FILE_SCHEMA).option("header", "false").csv(path)


def read_canonical_csv(spark: SparkSession, path: str, source: str = "FALLBACK_CSV",
                       fetch_ts: _dt.datetime | None = None) -> DataFrame:
    """Canonical CSV with a header, columns matched by NAME (any order, missing
    ones NULL); every field read as text, so ``time_period`` stays text; year and
    value are coerced (non-numeric → NULL); source and fetch time overwritten. Of
    several files all must have the same header: another one fails the job."""
    ts = fetch_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    names = spark.read.option("header", "true").csv(path).columns  # no inference: all strings
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(path)
    cols = []
    for f in CANONICAL_SCHEMA.fields:
        if f.name == "source_dataset":
            cols.append(F.lit(source).alias(f.name))
        elif f.name == "fetch_ts":
            cols.append(F.lit(ts).cast("timestamp").alias(f.name))
        elif f.name in raw.columns:
            c = F.col(f.name)
            cols.append((c if f.dataType == T.StringType() else c.try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


MAX_RECORDS = 5_000_000  # of a file


def bounded_writer(df: DataFrame, partition_by: Sequence[str] = (), max_records: int = MAX_RECORDS) -> DataFrameWriter:
    """A writer whose folders hold no more files than their rows ask for, and no file above ``max_records``.

    ``rebalance`` deals the rows by folder into tasks of the advisory size: a hot
    folder is parted among tasks, small ones share one. Without it every task
    writes a file into every folder.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.option("maxRecordsPerFile", max_records)
    return w.partitionBy(*partition_by) if partition_by else w


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True, sep: str = ",",
              partition_by: Sequence[str] = (), max_records: int = MAX_RECORDS, compression: str = "none") -> None:
    """CSV directory output (no single-file coalesce: the last stage keeps
    all its tasks). ``partition_by`` writes one folder per value, e.g. region."""
    w = bounded_writer(df, partition_by, max_records).mode(mode).option("header", str(header).lower()).option("sep", sep)
    w.option("compression", compression).csv(path)


def discover(spark: SparkSession, folder: str, src: str | None = None, country: str | None = None) -> DataFrame:
    """Files (or folders of part files) named ``{src}_{country}.{ext}`` (None = any):
    file_name, path, file_src, file_country. A listing; nothing is opened."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{src or '*'}_{country or '*'}.*")
    listed = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    rows = sorted((str(f.getPath().getName()), str(f.getPath())) for f in listed or [])
    found = spark.createDataFrame(rows, "file_name string, path string")
    return found.select("*", F.regexp_extract("file_name", r"^([^_]+)_", 1).alias("file_src"),
                        F.regexp_extract("file_name", r"^[^_]+_(.+)\.[^.]+$", 1).alias("file_country"))


def load_fallback(spark: SparkSession, folder: str, src: str, country: str, fetch_ts: _dt.datetime | None = None) -> DataFrame:
    """The alphabetically first file of a source and country as canonical rows, by
    the source's layout: ``oecd`` headerless migration records, ``un`` canonical with
    a header. No file, or another extension or source, is an error."""
    from lakeloom.operators.normalise import norm_csv
    first = discover(spark, folder, src, country).orderBy("file_name").first()
    if first is None:
        raise FileNotFoundError(f"no file {src}_{country}.* in {folder}")
    if not first.file_name.lower().endswith(".csv") or src not in ("oecd", "un"):
        raise ValueError(f"{first.file_name}: only .csv files of the sources oecd and un can be read")
    if src == "oecd":
        return norm_csv(read_migration_csv(spark, first.path), fetch_ts=fetch_ts)
    return read_canonical_csv(spark, first.path, fetch_ts=fetch_ts)


MAX_BINARY_FILE = 2**31 - 1
_DIGEST_BLOCK = 1 << 22
#: Ten thousand pieces, Spark's rows of an Arrow batch, are some 20 MB.
_PIECE_BYTES = 1 << 11
_BYTE_ORDER_MARK = b"\xef\xbb\xbf"
_DIGEST_SCHEMA = "path string, modificationTime timestamp_ltz, length long, md5 string, sha256 string"
_PIECE_SCHEMA = "path string, modified long, length long, start long, place long, content binary"


def _streamed_digests(path: str) -> tuple[str, str]:
    """MD5 and SHA-256 of a file read in blocks through its file system."""
    from pyarrow import fs

    if path.startswith("file:"):  # Spark gives local paths unescaped
        system, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(path)
    md5, sha256 = hashlib.md5(usedforsecurity=False), hashlib.sha256()
    with system.open_input_stream(name) as f:
        while block := f.read(_DIGEST_BLOCK):
            md5.update(block)
            sha256.update(block)
    return md5.hexdigest(), sha256.hexdigest()


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        md5, sha256 = zip(*map(_streamed_digests, batch.column("path").to_pylist())) if batch.num_rows else ((), ())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(md5, pa.string()), pa.array(sha256, pa.string())],
                                         names=[*batch.schema.names, "md5", "sha256"])


def _runs(*columns: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of rows, first and end, that agree in all columns."""
    if len(columns[0]):
        new = functools.reduce(pc.or_, (pc.not_equal(c[1:], c[:-1]) for c in columns))
        cuts = [0, *(new.to_numpy(zero_copy_only=False).nonzero()[0] + 1).tolist(), len(columns[0])]
        yield from zip(cuts, cuts[1:])


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one split of a file joined again, each with a line end, and cut into pieces
    of ``_PIECE_BYTES``; ``place`` counts up within the split."""
    places = itertools.count()
    for batch in batches:
        row, pieces = [], []
        for i, j in _runs(batch.column("path"), batch.column("start")):
            joined = b"\n".join([*batch.column("content")[i:j].to_pylist(), b""])
            pieces += [joined[at:at + _PIECE_BYTES] for at in range(0, len(joined), _PIECE_BYTES)]
            row += [i] * (len(pieces) - len(row))
        head = batch.select(["path", "modified", "length", "start"]).take(pa.array(row, pa.int64()))
        place = pa.array(itertools.islice(places, len(row)), pa.int64())
        yield pa.RecordBatch.from_arrays([*head.columns, place, pa.array(pieces, pa.binary())], names=[*head.schema.names, "place", "content"])


class _PieceDigests:
    """Digests of a file from its pieces. The reader gives neither the file's last line
    end nor a byte order mark before its first line: the file's length tells at
    the end whether they were there, so both starts are kept until then."""

    def __init__(self, path: str, modified: int, length: int) -> None:
        self.file, self.read, self.held = (path, modified, length), 0, b""
        self.starts = [[hashlib.md5(start, usedforsecurity=False), hashlib.sha256(start)] for start in (b"", _BYTE_ORDER_MARK)]

    def add(self, piece: bytes) -> None:
        self._update(self.held)
        self._update(memoryview(piece)[:-1])
        self.read, self.held = self.read + len(piece), piece[-1:]

    def _update(self, content: bytes | memoryview) -> None:
        for digest in (d for start in self.starts for d in start):
            digest.update(content)

    def row(self) -> tuple[str, int, int, str, str]:
        path, _, length = self.file
        # length - read: 0 and 3 with a line end at the end, -1 and 2 without
        marked, ended = {0: (0, True), -1: (0, False), 3: (1, True), 2: (1, False)}.get(length - self.read, (None, None))
        if marked is None:
            raise OSError(f"{path}: {length} bytes listed, {self.read} read with a line end after each line")
        if ended:
            self._update(self.held)
        return *self.file, *(d.hexdigest() for d in self.starts[marked])


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of sorted pieces, one after the other; a piece is dropped once it is added."""
    def row(done: _PieceDigests) -> pa.RecordBatch:
        path, modified, *others = done.row()
        return pa.RecordBatch.from_arrays([pa.array([unquote(path)]), pa.array([modified], pa.timestamp("us", "UTC")), *(pa.array([x]) for x in others)],
                                          names=["path", "modificationTime", "length", "md5", "sha256"])

    now = None
    for batch in batches:
        path, content = batch.column("path"), batch.column("content")
        for i, j in _runs(path):
            if now is None or now.file[0] != path[i].as_py():
                if now is not None:
                    yield row(now)
                now = _PieceDigests(*(batch.column(c)[i].as_py() for c in ("path", "modified", "length")))
            now.add(b"".join(content[i:j].to_pylist()))
    if now is not None:
        yield row(now)


def _store(spark: SparkSession, path_glob: str) -> tuple[bool, str]:
    """Whether the files are local, and a pattern of the names that Hadoop takes for compressed."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    local = hadoop.fs.Path(path_glob).getFileSystem(conf).getUri().getScheme() == "file"
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    endings = {hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs}
    return local, "(?i)(" + "|".join(re.escape(x) for x in sorted(endings)) + ")$"


def file_audit(spark: SparkSession, path_glob: str, load_ts: _dt.datetime | None = None, max_bytes: int | None = None,
               whole_bytes: int = MAX_BINARY_FILE) -> DataFrame:
    """Size, modification time, MD5 and SHA-256 of each file, plus load time
    and user. One row per file. A file of up to ``_DIGEST_BLOCK`` is one value in its task's
    memory. A larger local one is read by its task in blocks. A larger one of another
    store, which perhaps only Spark can open, is read as lines, split like any text, and put
    together again by a sort: a task holds a batch of lines or pieces, so only a line
    that is itself too large for memory fails. Names that Hadoop takes for compressed
    can't be read as lines: in another store they are one value up to ``whole_bytes``,
    and beyond that a file system that pyarrow cannot open is an error. Only a caller's
    own ``max_bytes`` leaves digests out."""
    ts = load_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    b = spark.read.format("binaryFile").load(path_glob)
    size, none = F.col("length"), F.lit(None).cast("string")
    wanted = F.lit(True) if max_bytes is None else size <= max_bytes
    columns = ["path", "modificationTime", "length"]
    held = max(min(whole_bytes, _DIGEST_BLOCK), len(_BYTE_ORDER_MARK))  # a lone mark is no line
    local, packed = _store(spark, path_glob)

    def whole(files: DataFrame) -> DataFrame:
        return files.select(*columns, F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))

    digests = whole(b.where(wanted & (size <= held)))
    large = b.where(wanted & (size > held))
    if not local:
        # conditions on _metadata choose files in the listing: no other file is opened
        is_packed, file_size = F.col("_metadata.file_name").rlike(packed), F.col("_metadata.file_size")
        lines = spark.read.format("text").option("lineSep", "\n").load(path_glob).where(~is_packed & (file_size > held))
        if max_bytes is not None:
            lines = lines.where(file_size <= max_bytes)
        pieces = lines.select(F.col("_metadata.file_path").alias("path"), F.unix_micros("_metadata.file_modification_time").alias("modified"),
                              file_size.alias("length"), F.col("_metadata.file_block_start").alias("start"),
                              F.col("value").cast("binary").alias("content")).mapInArrow(_piece_rows, _PIECE_SCHEMA)
        in_order = pieces.repartition("path").sortWithinPartitions("path", "start", "place")
        digests = digests.unionByName(in_order.mapInArrow(_digest_pieces, _DIGEST_SCHEMA))
        digests = digests.unionByName(whole(large.where(is_packed & (size <= whole_bytes))))
        large = large.where(is_packed & (size > whole_bytes))
    digests = digests.unionByName(large.select(*columns).mapInArrow(_digest_rows, _DIGEST_SCHEMA))
    if max_bytes is not None:
        digests = digests.unionByName(b.where(~wanted).select(*columns, none.alias("md5"), none.alias("sha256")))
    return digests.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("path"),
                         F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), "md5", "sha256",
                         F.lit(ts).cast("timestamp").alias("loaded_at"), F.lit(getpass.getuser()).alias("loaded_by"))


def write_snapshot(df: DataFrame, base: str, fetcher: str, params: dict, snapshot_ts: _dt.datetime,
                   spark: SparkSession) -> DataFrame:
    """Append a snapshot partition and one manifest row (file, fetcher,
    params, row count, time). The row count comes from an ``Observation`` on the
    write itself — no second pass over the data."""
    from pyspark.sql import Observation
    obs = Observation(f"snapshot_{fetcher}")
    stamp = snapshot_ts.strftime("%Y%m%d_%H%M%S")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows")).withColumn("snapshot_ts", F.lit(stamp))
    observed.write.mode("append").partitionBy("snapshot_ts").parquet(f"{base}/snapshots/{fetcher}")
    import json
    manifest = spark.createDataFrame(
        [(f"{fetcher}/snapshot_ts={stamp}", fetcher, json.dumps(params, sort_keys=True),
          int(obs.get["rows"]), snapshot_ts)],
        "file string, fetcher string, params string, row_count long, fetched_at timestamp")
    manifest.write.mode("append").parquet(f"{base}/manifest")
    return manifest


def write_snapshots(df: DataFrame, base: str, fetcher: str, by: str, snapshot_ts: _dt.datetime, max_records: int = MAX_RECORDS) -> DataFrame:
    """S16 for all periods at once: a snapshot for each value of ``by``, one write, and a manifest row each.

    The manifest counts what was written (the files' footers, no data column).
    """
    spark = df.sparkSession
    stamp = snapshot_ts.strftime("%Y%m%d_%H%M%S")
    run = f"{base}/snapshots/{fetcher}/snapshot_ts={stamp}"
    period = F.col("snapshot_period")
    bounded_writer(df.withColumn("snapshot_period", F.col(by)), ["snapshot_period"], max_records).parquet(run)
    counted = spark.read.parquet(run).groupBy(period).agg(F.count("*").alias("row_count"))
    manifest = counted.select(F.concat(F.lit(f"{fetcher}/snapshot_ts={stamp}/snapshot_period="), period.cast("string")).alias("file"), F.lit(fetcher).alias("fetcher"),
                              F.concat(F.lit(f'{{"{by}": '), F.regexp_extract(F.to_json(F.struct(period.alias("p"))), r'^\{"p":(.*)\}$', 1), F.lit("}")).alias("params"),
                              "row_count", F.lit(snapshot_ts).cast("timestamp").alias("fetched_at"))
    manifest.write.mode("append").parquet(f"{base}/manifest")
    return manifest


def fresh_snapshots(manifest: DataFrame, now: _dt.datetime | Column, key: Sequence[str] = ("fetcher", "params"),
                    source_col: str = "source", ttl_hours: dict[str, int] | None = None,
                    default_ttl: int = 24) -> DataFrame:
    """Per key, the latest snapshot whose age is within its source's TTL.
    The TTL table is the rule table (literal map); latest-per-key is a max_by
    aggregate (map-side combined), not a window."""
    ttl = ttl_hours or R.SOURCE_TTL_HOURS
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    ttl_col = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in ttl.items() for x in (F.lit(k), F.lit(v))]),
                                          F.col(source_col)), F.lit(default_ttl))
    age_h = (F.unix_micros(now_col) - F.unix_micros(F.col("fetched_at"))) / F.lit(3_600_000_000)
    fresh = manifest.where(age_h <= ttl_col)
    others = [c for c in manifest.columns if c not in key]
    latest = fresh.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct("fetched_at", *others)).alias("_r"))
    return latest.select(*key, *[F.col(f"_r.{c}").alias(c) for c in others])
