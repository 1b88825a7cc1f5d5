"""Text to vector: a plug-in seam and a deterministic hashing encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import tokens

MOST_CELLS = 1 << 18  # numbers of vectors that a task makes at a time, whatever the size of an Arrow batch


def embed_hashing(df: DataFrame, key: list[str], text: str, dim: int = 768) -> DataFrame:
    """Vectors of texts by signed word hashing, scaled to length 1.

    Words are cut and hashed inside the JVM; a task only adds up the hashes of an Arrow batch.
    """
    types = dict(df.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in key) + ", vec array<float>, n_tokens int"
    hashed = df.select(*key, F.coalesce(F.transform(tokens(text), lambda t: F.xxhash64(t)),
                                        F.array().cast("array<bigint>")).alias("_h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, MOST_CELLS // dim)
        for b in (b.slice(a, step) for b in batches for a in range(0, b.num_rows, step)):
            col = b.column("_h")
            sizes = col.value_lengths().to_numpy(zero_copy_only=False)
            h = col.flatten().to_numpy(zero_copy_only=False)
            slot = np.repeat(np.arange(len(sizes)), sizes) * dim + np.mod(h, dim)
            sign = np.where((h >> 32) & 1, -1.0, 1.0)
            m = np.bincount(slot, weights=sign, minlength=len(sizes) * dim).reshape(len(sizes), dim)
            n = np.linalg.norm(m, axis=1, keepdims=True)
            m = (m / np.where(n == 0, 1, n)).astype(np.float32)
            offsets = np.arange(0, (len(sizes) + 1) * dim, dim, dtype=np.int32)
            vec = pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in key], vec, pa.array(sizes.astype(np.int32))], names=[*key, "vec", "n_tokens"])

    return hashed.mapInArrow(run, schema)


def embed_with(df: DataFrame, key: list[str], text: str,
               encoder: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """Vectors from a plug-in encoder called once per Arrow batch."""
    types = dict(df.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in key) + ", vec array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            res = b[key].copy()
            res["vec"] = [list(map(float, v)) for v in encoder(b[text].fillna("").tolist())]
            yield res

    return df.select(*key, text).mapInPandas(run, schema)
