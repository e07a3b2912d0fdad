"""Vector functions: cosine similarity and the signed feature-hash embedding."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-12


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def cosine(vector: Column, reference: Column) -> Column:
    """Cosine similarity whose denominator never reaches zero (JVM-side; best for short vectors)."""
    norms = F.sqrt(dot(vector, vector)) * F.greatest(F.sqrt(dot(reference, reference)), F.lit(TINY))
    return dot(vector, reference) / F.greatest(norms, F.lit(TINY))


def to_matrix(vectors: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(dtype)


def cosine_arrow(vector: Column, reference: Column) -> Column:
    """Same as :func:`cosine` in Arrow batches; the better choice for wide vectors."""

    @F.pandas_udf("double")
    def similarity(v: pd.Series, r: pd.Series) -> pd.Series:
        a, b = to_matrix(v), to_matrix(r)
        norms = np.linalg.norm(a, axis=1) * np.maximum(np.linalg.norm(b, axis=1), TINY)
        return pd.Series(np.einsum("ij,ij->i", a, b) / np.maximum(norms, TINY))

    return similarity.asNondeterministic()(vector, reference)


#: Characters of text that are cut into tokens at once, about; one longer text stands alone.
BLOCK_CHARS = 1 << 20


def text_blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Rows in order, cut so that about ``BLOCK_CHARS`` characters are together."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        held = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, held + BLOCK_CHARS, "right")))
        yield slice(begin, end)
        begin = end


def hash_vectors(texts: list[str], dimensions: int = 64) -> np.ndarray:
    """Signed token counts hashed into ``dimensions`` buckets, L2-normalised, float32.

    The bucket comes from the first eight hex digits of the token's SHA-1, the
    sign from the last one.  Texts are cut into tokens a block at a time, so the
    memory does not grow with their number.  Each distinct token of a block is hashed once.
    """
    width = max(8, dimensions)
    out = np.zeros((len(texts), width), dtype=np.float32)
    for part in text_blocks(np.array([len(str(text)) for text in texts], dtype=np.int64)):
        tokens = [str(text).lower().split() for text in texts[part]]
        rows = np.repeat(np.arange(part.start, part.stop), [len(t) for t in tokens])
        flat = [token for ts in tokens for token in ts]
        if flat:
            codes, distinct = pd.factorize(np.array(flat, dtype=object))
            digests = np.frombuffer(b"".join([hashlib.sha1(token.encode("utf-8")).digest() for token in distinct]), np.uint8).reshape(-1, 20)
            buckets = np.ascontiguousarray(digests[:, :4]).view(">u4")[:, 0].astype(np.int64) % width
            signs = np.where(digests[:, -1] % 2, -1, 1).astype(np.float32)
            np.add.at(out, (rows, buckets[codes]), signs[codes])
    norms = np.sqrt((out * out).sum(axis=1, dtype=np.float32))
    blank = norms == 0
    out[blank, 0] = 1.0
    norms[blank] = 1.0
    return out / norms[:, None]


class HashProvider:
    """Deterministic embedding provider for tests and smoke runs; no model needed."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = max(8, dimensions)

    def __call__(self, texts: list[str]) -> np.ndarray:
        return hash_vectors(texts, self.dimensions)


def release() -> None:
    """Give memory that this worker's earlier tasks have freed back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def hash_embedding(text: Column, dimensions: int = 64) -> Column:
    """Feature-hash embedding as a column; map-only, no shuffle.

    A task holds one Arrow batch of texts and the tokens of one block of them; workers live on, so each batch tidies up first.
    """

    @F.arrow_udf("array<float>")
    def embed(texts: pa.Array) -> pa.Array:
        release()
        texts = texts.fill_null("")
        blocks = text_blocks(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        parts = [hash_vectors(texts[part].to_pylist(), dimensions) for part in blocks]
        numbers = np.concatenate([np.zeros((0, max(8, dimensions)), np.float32), *parts])
        return pa.ListArray.from_arrays(np.arange(len(numbers) + 1, dtype=np.int32) * numbers.shape[1], numbers.ravel())

    # Declared non-deterministic so that the optimiser never evaluates it a second time in a filter.
    return embed.asNondeterministic()(text)
