"""Operator 2: byte-level BPE encoding and decoding by tree concatenation.

Texts of up to ``PIECE`` characters are encoded in one go. Longer ones are cut
into pieces, which Spark encodes apart from each other, and joined pairwise in
a tree. A cut after a word and before white space needs no work, since every
pre-token ends there. Any other cut lies in long unsplit text: there the text
around the join is encoded again in a window that grows until it starts and
ends on a boundary of both the window and the side it reaches into. Inside one
pre-token (a run of letters, say, of any length) the same is done with tokens:
a window around the join grows until its first token is a token of the left
side and its last one of the right side. Two neighbouring tokens of a BPE
encoding stay neighbours whatever follows, so agreement of one token on either
side proves the whole. Pre-tokens beyond ``LEAF`` characters are halved in this
way as well, which keeps the merge loop's quadratic cost to a leaf.

Defined cases: a null text counts as empty (no ids); special tokens written in a
text get their id, as the tokenizers library does by default; repeated rows each
get their own result; an empty table gives an empty result; only doc_id and the
text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeloom.llm.common import per_process

PIECE = 32_768
LEAF = 512
#: The pattern that byte-level vocabularies of this family are made with (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        to_byte, vocab = _byte_of_char(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): k for token, k in vocab.items() if token not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        if [vocab[a + b] for a, b in merges] != list(range(256, 256 + len(merges))):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        self.words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.run = tiktoken.Encoding("run", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.kind = regex.compile(r"(\p{L})|(\p{N})|(\s)")
        self.special = special
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.bytes = {k: b for b, k in ranks.items()} | {k: s.encode() for s, k in special.items()}
        self.sizes = np.zeros(max(self.bytes) + 1, dtype=np.int64)
        for k, b in self.bytes.items():
            self.sizes[k] = len(b)

    # -- one task ---------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        if self.split is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[int] = []
        for part in self.split.split(text):
            out += [self.special[part]] if part in self.special else self._plain(part)
        return out

    def _plain(self, text: str) -> list[int]:
        if max(map(len, text.split()), default=0) <= LEAF and not re.search(r"\s{%d}" % LEAF, text):
            return self.words.encode_ordinary(text)
        return [k for m in self.pattern.finditer(text) for k in self._run(m.group())]

    def _run(self, text: str) -> list[int]:
        """One pre-token, whatever its length."""
        if len(text) <= LEAF:
            return self.run.encode_ordinary(text)
        half = len(text) // 2
        return self.join_runs(text[:half], self._run(text[:half]), text[half:], self._run(text[half:]))

    def join_runs(self, left: str, lids: list[int], right: str, rids: list[int]) -> list[int]:
        """Ids of ``left + right`` as one pre-token, from the ids of either part as one."""
        lb, rb = left.encode(), right.encode()
        k = 4
        while True:
            a, b = max(0, len(lids) - k), min(len(rids), k)
            tail, head = int(self.sizes[lids[a:]].sum()), int(self.sizes[rids[:b]].sum())
            while a > 0 and lb[len(lb) - tail] & 0xC0 == 0x80:  # a token may begin inside a character
                a -= 1
                tail += int(self.sizes[lids[a]])
            while b < len(rids) and head < len(rb) and rb[head] & 0xC0 == 0x80:
                head += int(self.sizes[rids[b]])
                b += 1
            window = self.run.encode_ordinary((lb[len(lb) - tail:] + rb[:head]).decode())
            if (a == 0 or window[:2] == lids[a:a + 2]) and (b == len(rids) or window[-2:] == rids[b - 2:b]):
                return lids[:a] + window + rids[b:]
            k *= 2

    def _class(self, c: str) -> int:
        m = self.kind.match(c)
        return m.lastindex if m else 0

    def boundary(self, text: str, at: int) -> bool:
        """Whether a pre-token begins at ``at`` whatever stands around these two characters.

        Pre-tokens hold one class of characters, but for a space before it and
        for the endings after an apostrophe.
        """
        before, after = self._class(text[at - 1]), self._class(text[at])
        return before != after and before != 3 and text[at - 1] != "'"

    def join(self, left: str, lids: list[int], right: str, rids: list[int]) -> list[int]:
        """Ids of ``left + right`` from the ids of either part."""
        if not left or not right:
            return lids + rids
        # Special tokens stand for themselves and part what is around them; no cut falls into one.
        low = max([left.rfind(s) + len(s) for s in self.special if s in left], default=0)
        high = min([right.find(s) for s in self.special if s in right], default=len(right))
        if low == len(left) or high == 0 or self.boundary(left[-1] + right[0], 1):
            return lids + rids
        a, b = len(left) - 1, 1
        while a > low and not self.boundary(left, a):
            a -= 1
        while b < high and not self.boundary(right, b):
            b += 1
        tail, head = left[a:], right[:b]
        nl, nr = self._tokens(lids, len(tail.encode()), True), self._tokens(rids, len(head.encode()), False)
        lkeep, lrun, rrun, rkeep = lids[:len(lids) - nl], lids[len(lids) - nl:], rids[:nr], rids[nr:]
        if len(tail) + len(head) > 2 * LEAF and all(self.pattern.match(t).end() == len(t) for t in (tail, head, tail + head)):
            return lkeep + self.join_runs(tail, lrun, head, rrun) + rkeep
        return lkeep + self._plain(tail + head) + rkeep

    def _tokens(self, ids: list[int], size: int, from_end: bool) -> int:
        """How many ids at that end make up ``size`` bytes."""
        n = 0
        while size > 0:
            size -= int(self.sizes[ids[-1 - n] if from_end else ids[n]])
            n += 1
        if size:
            raise AssertionError("a boundary falls inside a token")
        return n

    def pieces(self, text: str, size: int) -> Iterator[str]:
        """Cuts of about ``size`` characters: after a word if one ends near, and never inside a special token."""
        at = 0
        while len(text) - at > size:
            cut = at + size
            for k in range(cut, max(at + 1, cut - 1024), -1):
                if text[k].isspace() and not text[k - 1].isspace() and self._class(text[k]) == 3 and self._class(text[k - 1]) != 3:
                    cut = k
                    break
            for s in self.special:
                hit = text.find(s, max(at, cut - len(s) + 1), cut + len(s) - 1)
                if 0 <= hit < cut < hit + len(s):
                    cut = hit + len(s)
            yield text[at:cut]
            at = cut
        yield text[at:]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace").encode()


def codec(path: str) -> Codec:
    return per_process(f"bpe {path}", lambda: Codec(path))


def tree(c: Codec, parts: list[tuple[str, list[int]]]) -> list[int]:
    """Joins neighbours pairwise until one is left."""
    while len(parts) > 1:
        parts = [(parts[k][0] + parts[k + 1][0], c.join(*parts[k], *parts[k + 1])) if k + 1 < len(parts) else parts[k]
                 for k in range(0, len(parts), 2)]
    return parts[0][1]


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id", piece: int = PIECE,
                  with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (little-endian uint32, null unless ``with_ids``) of every row.

    ``vocabulary`` is the path of a vocabulary file that every executor can open.
    """
    result = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                           T.StructField("ids", T.BinaryType())])
    arrow = to_arrow_schema(result)

    def rows(ids: pa.Array, encoded: list[list[int]], c: Codec) -> pa.RecordBatch:
        raw = [np.array(x, dtype="<u4").tobytes() for x in encoded]
        return pa.RecordBatch.from_arrays([
            ids.cast(arrow.field(0).type), pa.array([len(x) for x in encoded], pa.int64()),
            pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string()),
            pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in encoded], pa.string()),
            pa.array(raw if with_ids else [None] * len(raw), pa.binary())], schema=arrow)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield rows(part.column("_id"), [c.encode(t) for t in part.column("_text").to_pylist()], c)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for k in range(batch.num_rows):
                row, value = batch.column("_row")[k].as_py(), batch.column("_text")[k].as_py()
                for n, p in enumerate(c.pieces(value, piece)):
                    yield pa.RecordBatch.from_arrays([pa.array([row]), batch.column("_id").slice(k, 1), pa.array([n], pa.int32()), pa.array([p])],
                                                     names=["_row", "_id", "_piece", "_text"])

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                ids = np.array(c.encode(part.column("_text")[0].as_py()), dtype="<u4").tobytes()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([ids], pa.binary())], names=[*part.schema.names, "_ids"])

    def concatenate(table: pa.Table) -> pa.Table:
        c = codec(vocabulary)
        table = table.sort_by("_piece")
        parts = [(t, np.frombuffer(i, "<u4").tolist()) for t, i in zip(table.column("_text").to_pylist(), table.column("_ids").to_pylist())]
        return pa.Table.from_batches([rows(table.column("_id").combine_chunks().slice(0, 1), [tree(c, parts)], c)], arrow)

    src = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    long = src.withColumn("_row", F.monotonically_increasing_id()).filter(F.length("_text") > piece)
    id_type = docs.schema[doc_id].dataType.simpleString()
    pieces = long.mapInArrow(cut, f"_row long, _id {id_type}, _piece int, _text string").repartition("_row", "_piece")
    coded = pieces.mapInArrow(encode_pieces, f"_row long, _id {id_type}, _piece int, _text string, _ids binary")
    return (src.filter(F.length("_text") <= piece).mapInArrow(whole, result)
            .unionByName(coded.groupBy("_row").applyInArrow(concatenate, result)))
