"""Identifier hashes.

Built-in ``md5`` / ``sha2`` stay in codegen and are the default. MD4 (RFC 1320)
has no Spark or OpenSSL-3 implementation here, so it is an Arrow-batched
pandas UDF that hashes a whole batch at once with numpy: messages are grouped
by padded block count and every round runs as array operations over the group.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_M32 = np.uint32(0xFFFFFFFF)

# FIXED VALUES — RFC 1320 round constants and shift schedule.
_R2 = np.uint32(0x5A827999)
_R3 = np.uint32(0x6ED9EBA1)
_S1 = (3, 7, 11, 19)
_S2 = (3, 5, 9, 13)
_S3 = (3, 9, 11, 15)
_ORDER3 = (0, 8, 4, 12, 2, 10, 6, 14, 1, 9, 5, 13, 3, 11, 7, 15)
_INIT = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _rotl(x: np.ndarray, s: int) -> np.ndarray:
    return (x << np.uint32(s)) | (x >> np.uint32(32 - s))


def _md4_same_length(msgs: list[bytes]) -> list[str]:
    """MD4 of messages that all pad to the same number of 64-byte blocks."""
    n = len(msgs)
    ml = len(msgs[0])
    nblocks = (ml + 8) // 64 + 1
    buf = np.zeros((n, nblocks * 64), dtype=np.uint8)
    flat = np.frombuffer(b"".join(msgs), dtype=np.uint8).reshape(n, ml) if ml else None
    if ml:
        buf[:, :ml] = flat
    buf[:, ml] = 0x80
    buf[:, -8:] = np.frombuffer((ml * 8).to_bytes(8, "little"), dtype=np.uint8)
    words = buf.view("<u4").reshape(n, nblocks, 16).astype(np.uint32)
    a, b, c, d = (np.full(n, v, dtype=np.uint32) for v in _INIT)
    with np.errstate(over="ignore"):
        for blk in range(nblocks):
            x = words[:, blk, :]
            aa, bb, cc, dd = a, b, c, d
            for i in range(16):
                f = (b & c) | (~b & d)
                a, b, c, d = d, _rotl((a + f + x[:, i]) & _M32, _S1[i % 4]), b, c
            for i in range(16):
                k = (i % 4) * 4 + i // 4
                g = (b & c) | (b & d) | (c & d)
                a, b, c, d = d, _rotl((a + g + x[:, k] + _R2) & _M32, _S2[i % 4]), b, c
            for i in range(16):
                h = b ^ c ^ d
                a, b, c, d = d, _rotl((a + h + x[:, _ORDER3[i]] + _R3) & _M32, _S3[i % 4]), b, c
            a, b, c, d = a + aa, b + bb, c + cc, d + dd
    digest = np.stack([a, b, c, d], axis=1).astype("<u4").view(np.uint8).reshape(n, 16)
    return [bytes(r).hex() for r in digest]


def md4_hex_batch(values: pd.Series) -> pd.Series:
    """MD4 hex of the UTF-8 text of each value; NULL stays NULL."""
    out = pd.Series([None] * len(values), index=values.index, dtype=object)
    present = values.dropna()
    if present.empty:
        return out
    encoded = present.astype(str).map(lambda s: s.encode("utf-8"))
    lengths = encoded.map(len)
    for _, idx in lengths.groupby(lengths).groups.items():
        out.loc[idx] = _md4_same_length(list(encoded.loc[idx]))
    return out


@F.pandas_udf(StringType())
def md4_hex(values: pd.Series) -> pd.Series:
    return md4_hex_batch(values)


HASHERS: dict[str, Callable[[Column], Column]] = {
    "md5": lambda c: F.md5(c.cast("string")),
    "sha256": lambda c: F.sha2(c.cast("string"), 256),
    "md4": lambda c: md4_hex(c.cast("string")),
}


def hash_id(c: Column, algorithm: str | Callable[[Column], Column] = "md5") -> Column:
    """Injectable id hash: a name from ``HASHERS`` or any ``Column -> Column``."""
    fn = HASHERS[algorithm] if isinstance(algorithm, str) else algorithm
    return fn(c)
