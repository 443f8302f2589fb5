"""Embedding a text column with a user-supplied encoder, in Arrow batches.

The encoder is built once per Python worker (``loader()`` runs on the
executor, not the driver) and called on whole batches, the way a sentence
encoder is meant to be used; rows stream through an iterator pandas UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.vectors import l2_normalize


def embed(df: DataFrame, text_col: str, loader: Callable[[], object], out: str = "embedding",
          normalize: bool = True) -> DataFrame:
    """Add ``out`` = encoder(text) as ``array<float>``; L2-normalised unless told otherwise.

    ``loader`` returns an object with ``encode(list[str]) -> array (n, dim)``.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader()
        for texts in batches:
            vecs = np.asarray(model.encode(texts.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(vecs))

    col: Column = encode(F.col(text_col))
    out_df = df.withColumn(out, col)
    if normalize:
        out_df = out_df.withColumn(out, l2_normalize(out).cast("array<float>"))
    return out_df


class HashingCharEncoder:
    """A deterministic stand-in encoder for tests: hashed character trigram counts."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def encode(self, texts: list[str]) -> np.ndarray:
        import zlib
        m = np.zeros((len(texts), self.dim), dtype=np.float32)
        for r, t in enumerate(texts):
            s = f"  {t.lower()}  "
            for i in range(len(s) - 2):
                m[r, zlib.crc32(s[i:i + 3].encode()) % self.dim] += 1.0
        return m
