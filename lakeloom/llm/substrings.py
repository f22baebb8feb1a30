"""Operator 5: removal of repeated word windows behind a count-min prefilter.

1. Every task keeps partial sketches of the windows it reads: per hash row the
   sorted cells and whether a cell was hit once or more often. The partial
   sketches are cut into slices of cells, shuffled by slice and merged. Only one
   bit a cell is left, "hit at least twice", an overestimate.
2. A second pass over the texts keeps the windows whose cells say "repeated" in
   every row, drops all but the first of equal windows inside a task (those are
   known repeats) and sends the rest, packed, to buckets of their 96-bit
   fingerprint. A bucket finds the first start of each window; all others are
   repeats. A window that occurs everywhere reaches its bucket once a task.
3. Repeats go back to blocks of documents, which cut the covered words.

The sketch holds about two cells a window and row, up to ``MAX_CELLS`` (128 MB
a row), which bounds the broadcast. Beyond that it lets more unrepeated windows
through to the exact pass, which stays linear in the input; nothing is lost.

Defined cases: a null text has no words; a null doc_id orders before all
others; rows that share a doc_id and text get one and the same result each;
rows that share a doc_id but not their text are told apart by a hash of the
text (which is carried only if some doc_id is repeated), and equal starts of
theirs are ties, none of which removes another; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeloom.llm.words import find_words, hash_windows, hash_words, mix, runs, slices

WINDOW = 20
ROWS = 2
MIN_CELLS, MAX_CELLS = 1 << 22, 1 << 30
SLICE_CELLS = 1 << 22
FLUSH_WINDOWS = 500_000
SKETCH_WINDOWS = 3_000_000  # of a partial sketch: the more, the smaller its gaps and so its bytes
BUCKET_WINDOWS = 1_000_000
BLOCK_BYTES = 8 << 20
BYTES_A_WORD = 6  # of prose, only to size the sketch
_NO_ID = np.iinfo(np.int64).min


def _windows(part: pa.RecordBatch, second: bool, size: int):
    """First word, row and hash of each window; with ``second`` also 32 further bits of fingerprint."""
    w = find_words(part.column("_text"))
    at, h = hash_windows(hash_words(w), w.row, size)
    more = (hash_windows(hash_words(w, 1), w.row, size)[1] >> np.uint64(32)).astype(np.uint32) if second else None
    return w, at, h, more


def _cells(h: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(h + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(cells - 1)).astype(np.uint32)


def _pack(cell: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells as gaps, with a bit each."""
    gaps = np.diff(cell, prepend=0).astype(np.uint32)
    return zlib.compress(np.uint32(len(cell)).tobytes() + gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + np.packbits(twice).tobytes(), 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(blob)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    gaps = np.ascontiguousarray(np.frombuffer(raw[4:4 + 4 * n], np.uint8).reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(gaps), np.unpackbits(np.frombuffer(raw[4 + 4 * n:], np.uint8), count=n).astype(bool)


def sketch_cells(total_bytes: int) -> int:
    want = 2 * total_bytes // BYTES_A_WORD
    return min(MAX_CELLS, max(MIN_CELLS, 1 << max(0, int(want - 1).bit_length())))


def repeated_cells(texts: DataFrame, cells: int, size: int = WINDOW) -> list[np.ndarray]:
    """Per row a bitmap of the cells hit at least twice, merged from the tasks' partial sketches."""
    n_slices = cells // SLICE_CELLS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(found: list[np.ndarray]) -> pa.RecordBatch:
            h = np.concatenate(found)
            part, blob = [], []
            for row in range(ROWS):
                cell = np.sort(_cells(h, row, cells))
                first = runs(cell)
                twice = np.diff(first, append=len(cell)) > 1
                cell = cell[first]
                cuts = np.searchsorted(cell, np.arange(n_slices + 1, dtype=np.uint64) * SLICE_CELLS)
                for k in np.flatnonzero(np.diff(cuts)):
                    lo, hi = cuts[k], cuts[k + 1]
                    part.append(row * n_slices + int(k))
                    blob.append(_pack(cell[lo:hi] - np.uint32(k * SLICE_CELLS), twice[lo:hi]))
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(blob, pa.binary())], names=["part", "blob"])

        found, n = [], 0
        for batch in batches:
            for piece in slices(batch, "_text"):
                h = _windows(piece, False, size)[2]
                found.append(h)
                n += len(h)
                if n >= SKETCH_WINDOWS:
                    yield flush(found)
                    found, n = [], 0
        if n:
            yield flush(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams a partition's partial sketches, sorted by slice, into one slice of counters after another."""
        part, hits = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(np.packbits(hits > 1).tobytes(), 1)], pa.binary())],
                                              names=["part", "blob"])

        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if p != part:
                    if part is not None:
                        yield done()
                    part, hits = p, np.zeros(SLICE_CELLS, dtype=np.uint8)
                cell, twice = _unpack(blob.as_buffer())
                hits[cell] = np.minimum(hits[cell] + 1 + twice, 2)
        if part is not None:
            yield done()

    merged = (texts.mapInArrow(partial, "part int, blob binary").repartition(ROWS * n_slices, "part")
              .sortWithinPartitions("part").mapInArrow(merge, "part int, blob binary"))
    out = [np.zeros(cells // 8, dtype=np.uint8) for _ in range(ROWS)]
    for r in merged.toLocalIterator():
        row, k = divmod(r.part, n_slices)
        out[row][k * SLICE_CELLS // 8:(k + 1) * SLICE_CELLS // 8] = np.frombuffer(zlib.decompress(r.blob), np.uint8)
    return out


def _ids(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("_id").to_numpy(), part.column("_version").to_numpy()


_PLACES = np.dtype([("id", "<i8"), ("version", "<i8"), ("at", "<i4")])
_ENTRIES = np.dtype([("h", "<u8"), ("more", "<u4"), ("id", "<i8"), ("version", "<i8"), ("at", "<i4")])


def _prime(n: int) -> int:
    """The least prime from n on: ids of any stride then spread over so many blocks."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _columns(rows: np.ndarray) -> bytes:
    """Field by field, so that the shuffle's compression sees like beside like."""
    return b"".join([np.uint32(len(rows)).tobytes(), *(np.ascontiguousarray(rows[f]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for f in rows.dtype.names)])


def _rows(blob: bytes, dtype: np.dtype) -> np.ndarray:
    n = int(np.frombuffer(blob[:4], np.uint32)[0])
    out, at = np.zeros(n, dtype), 4
    for f in dtype.names:
        size = dtype[f].itemsize
        out[f] = np.ascontiguousarray(np.frombuffer(blob[at:at + n * size], np.uint8).reshape(size, n).T).view(dtype[f]).ravel()
        at += n * size
    return out


def _places(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), _PLACES)
    for f in _PLACES.names:
        out[f] = rows[f]
    return out


def _dealt(rows: np.ndarray, to: np.ndarray, kind: int) -> list[tuple[int, int, bytes]]:
    order = np.argsort(to, kind="stable")
    rows, to = rows[order], to[order]
    first = runs(to)
    return [(kind, int(to[a]), _columns(rows[a:b])) for a, b in zip(first, [*first[1:], len(to)])]


_MESSAGE = "kind int, dest int, blob binary"


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, to, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(to, pa.int32()), pa.array(blob, pa.binary())], names=["kind", "dest", "blob"])


def _repeats(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over entries: the first of each window in order of (id, at), and those at a later place than it.

    Returns the order that sorts by window and place, and for each sorted entry
    whether its place is later than its window's first.
    """
    order = np.lexsort((rows["at"], rows["id"], rows["more"], rows["h"]))
    r = rows[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r["h"][1:] != r["h"][:-1]) | (r["more"][1:] != r["more"][:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(r) else np.zeros(0, np.int64)
    return order, (r["id"] != r["id"][head]) | (r["at"] != r["at"][head])


def remove_repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = WINDOW,
                    with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text (null unless ``with_text``) of every row."""
    spark = docs.sparkSession
    key, value = F.coalesce(F.col(doc_id).cast("long"), F.lit(int(_NO_ID))), F.coalesce(F.col(text), F.lit(""))
    ids = docs.groupBy(key.alias("_id")).agg(F.sum(F.octet_length(value)).alias("size"), F.count("*").alias("n"))
    total, most = ids.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    version = F.xxhash64(text) if most > 1 else F.lit(0).cast("long")
    src = docs.select(key.alias("_id"), version.alias("_version"), value.alias("_text"))
    cells = sketch_cells(total)
    buckets = max(32, total // BYTES_A_WORD // BUCKET_WINDOWS)
    blocks = _prime(max(16, total // BLOCK_BYTES))
    sketch = spark.sparkContext.broadcast(repeated_cells(src.select("_text"), cells, size))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(found: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(found)
            order, later = _repeats(rows)
            first, known = rows[np.sort(order[~later])], rows[np.sort(order[later])]  # in the order of the texts, which packs well
            return _messages(_dealt(first, (first["h"] >> np.uint64(33)).astype(np.int64) % buckets, 0) + _dealt(_places(known), known["id"] % blocks, 1))

        bits = sketch.value
        found, n = [], 0
        for batch in batches:
            for part in slices(batch, "_text"):
                w, at, h, more = _windows(part, True, size)
                again = np.ones(len(h), dtype=bool)
                for row in range(ROWS):
                    cell = _cells(h, row, cells)
                    again &= (bits[row][cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8)) & 1 == 1
                ids, version = _ids(part)
                at, owner = at[again], w.row[at[again]]
                rows = np.zeros(len(at), _ENTRIES)
                rows["h"], rows["more"], rows["id"], rows["version"] = h[again], more[again], ids[owner], version[owner]
                rows["at"] = at - w.first()[owner]
                found.append(rows)
                n += len(rows)
                if n >= FLUSH_WINDOWS:
                    yield flush(found)
                    found, n = [], 0
        if n:
            yield flush(found)

    def exact(table: pa.Table) -> pa.Table:
        """A bucket's windows give their repeats; what is already known passes through."""
        if table.column("kind")[0].as_py() == 1:
            return table.select(["dest", "blob"])
        rows = np.concatenate([_rows(b.as_buffer().to_pybytes(), _ENTRIES) for b in table.column("blob")])
        order, later = _repeats(rows)
        hit = rows[order[later]]
        hit = hit[np.lexsort((hit["at"], hit["version"], hit["id"]))]
        return pa.Table.from_batches([_messages(_dealt(_places(hit), hit["id"] % blocks, 1))]).select(["dest", "blob"])

    back = src.mapInArrow(candidates, _MESSAGE).groupBy("kind", "dest").applyInArrow(exact, "dest int, blob binary")

    result = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                           T.StructField("kept_text", T.StringType())])
    arrow = to_arrow_schema(result)

    def cut(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        out = []
        places = [_rows(b.as_buffer().to_pybytes(), _PLACES) for b in repeats.column("blob")]
        places = np.concatenate(places) if places else np.zeros(0, _PLACES)
        places = places[np.argsort(places["id"], kind="stable")]
        for batch in texts.to_batches():
            for part in slices(batch, "_text"):
                ids, version = _ids(part)
                low, high = (np.searchsorted(places["id"], ids, side) for side in ("left", "right"))
                n_words, n_removed, digest, kept = [], [], [], []
                for k, value in enumerate(part.column("_text").to_pylist()):
                    words = value.encode().split()
                    own = places[low[k]:high[k]]
                    own = own["at"][own["version"] == version[k]]
                    gone = 0
                    if len(own):
                        edge = np.zeros(len(words) + 1, dtype=np.int64)
                        np.add.at(edge, own, 1)
                        np.add.at(edge, own + size, -1)
                        covered = np.cumsum(edge[:-1]) > 0
                        gone = int(covered.sum())
                        n_words.append(len(words))
                        words = [words[i] for i in np.flatnonzero(~covered)]
                    else:
                        n_words.append(len(words))
                    rest = b" ".join(words)
                    n_removed.append(gone)
                    digest.append(hashlib.sha256(rest).hexdigest())
                    kept.append(rest.decode() if with_text else None)
                out.append(pa.RecordBatch.from_arrays([pc.if_else(pc.equal(part.column("_id"), int(_NO_ID)), None, part.column("_id")).cast(arrow.field(0).type), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                                       pa.array(digest, pa.string()), pa.array(kept, pa.string())], schema=arrow))
        return pa.Table.from_batches(out, arrow)

    block = F.pmod("_id", F.lit(blocks)).cast("int")
    return (src.withColumn("dest", block).groupBy("dest").cogroup(back.groupBy("dest"))
            .applyInArrow(cut, result))
