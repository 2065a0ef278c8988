"""Hooks for user models: embedding and batch inference, fed in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType

VECTOR = ArrayType(FloatType())


def unit_rows(m: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(size > 0, size, 1)


def embedding_udf(model: Callable[[Sequence[str]], Sequence], normalise: bool = True, batch_size: int = 32):
    """Column function around a callable or an object with ``embed_documents``.

    A batch whose result has another length than its input stays without
    vectors; null texts are not sent to the model.
    """
    encode = getattr(model, "embed_documents", model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = pd.Series([None] * len(texts), dtype=object)
            present = [i for i, t in enumerate(texts) if t is not None]
            for at in range(0, len(present), batch_size):
                part = present[at : at + batch_size]
                vectors = encode([texts.iloc[i] for i in part])
                if len(vectors) != len(part):
                    continue
                m = np.asarray(vectors, dtype="float64")
                for i, row in zip(part, unit_rows(m) if normalise else m):
                    out.iat[i] = row.astype("float32")
            yield out

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, VECTOR)


def hash_embedding(dimensions: int) -> Callable[[Sequence[str]], np.ndarray]:
    """Deterministic stand-in model: signed word hashes added up."""

    def encode(texts: Sequence[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), dimensions))
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                out[i, h % dimensions] += 1 if h & 0x10000 else -1
        return out

    return encode


def hashing_embedder(dimensions: int):
    return embedding_udf(hash_embedding(dimensions))


def batch_inference(fn: Callable[[np.ndarray], Sequence], returns: DataType, batch_size: int = 32):
    """``fn`` gets up to ``batch_size`` stacked inputs and must return one result for each."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for inputs in batches:
            results = []
            for at in range(0, len(inputs), batch_size):
                part = inputs.iloc[at : at + batch_size]
                got = list(fn(np.stack(part.to_numpy())))
                if len(got) != len(part):
                    raise ValueError(f"model returned {len(got)} results for {len(part)} inputs")
                results.extend(got)
            yield pd.Series(results)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, returns)
