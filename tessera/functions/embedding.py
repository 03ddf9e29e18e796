"""UDF6: text -> vector through a user-supplied encoder, batch-wise (Arrow).

The default encoder is feature hashing of lower-case word tokens (CRC32 into
``dim`` buckets, L2-normalised): deterministic and dependency-free.  A user
can pass any ``encoder(texts: list[str]) -> np.ndarray (n, dim)`` -- e.g. a
sentence-embedding model loaded once per Python worker.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = re.compile(r"\w+", re.UNICODE)


def hashing_encoder(dim: int = 64):
    def enc(texts):
        out = np.zeros((len(texts), dim), dtype=np.float32)
        index: dict[str, int] = {}
        words = [[index.setdefault(w, len(index)) for w in _WORD.findall((t or "").lower())] for t in texts]
        h = np.array([zlib.crc32(w.encode("utf-8")) for w in index], dtype=np.int64)  # each word once
        at = np.array([i for ws in words for i in ws], dtype=np.int64)
        row = np.repeat(np.arange(len(texts)), [len(ws) for ws in words])
        if len(at):
            np.add.at(out, (row, h[at] % dim), np.where(h[at] >> 31 & 1, -1.0, 1.0))
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n == 0, 1.0, n)
    return enc


def embed(text_col, encoder=None, dim: int = 64) -> Column:
    """Column of ``array<float>`` vectors computed by a pandas UDF."""
    enc = encoder or hashing_encoder(dim)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(s: pd.Series) -> pd.Series:
        m = enc(s.tolist())
        return pd.Series([row.astype(np.float32) for row in np.asarray(m)])

    return _embed(F.col(text_col) if isinstance(text_col, str) else text_col)
