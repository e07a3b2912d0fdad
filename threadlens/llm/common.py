"""Helpers that the training-data operators share: staged tables, shared files, batches of text as bytes."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import release
from ..session import ensure_checkpoint_dir

#: Bytes of text that a task turns into arrays at once; one longer text stands alone.
BLOCK_BYTES = 2 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the written table.

    This cuts the lineage: a lost executor costs only the tasks that read it.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids that a filter may send to every task (about 100 MB); longer lists are joined by an exchange.
MAX_SENT = 4_000_000


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``column`` is none of the written ``ids`` (one column of that name), null like any value.

    The ids are counted: a short list goes to every task, and the texts stay where they are.
    """
    listed = ids.select(F.col(column).alias("__id"))
    listed = F.broadcast(listed) if ids.count() <= MAX_SENT else listed
    return docs.join(listed, docs[column].eqNullSafe(listed["__id"]), "left_anti")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder, the same on driver and executors."""
    return fs.FileSystem.from_uri("file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offsets of each text in them; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of text at most (``BLOCK_BYTES``); workers live on, so each task tidies up first."""
    release()
    size = size or BLOCK_BYTES
    for batch in batches:
        _, offsets = utf8(batch[text])
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the spans, both ends included."""
    member = np.zeros(256, bool)
    for first, last in spans:
        member[first : last + 1] = True
    return member


#: Bytes of the words ``[^\x20\x09-\x0D]+``, and what turns A-Z into a-z.
DARK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of all texts, and for each text the number of words before it (and at last all)."""
    inside = member[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (border[:-1] | ~before))
    ends = np.flatnonzero(inside & (border[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the whole number."""
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(29))) * _M2
    return h ^ (h >> np.uint64(32))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes of all spans at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    length = ends - starts
    hashes = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, done = np.arange(len(starts)), 0
    while len(at := at[length[at] > done]):
        piece = np.ascontiguousarray(eights[starts[at] + done]).view("<u8")[:, 0]
        piece = piece & _MASK[np.minimum(length[at] - done, 8)]
        hashes[at] = mix(hashes[at] * np.uint64(0x9E3779B97F4A7C15) ^ piece)
        done += 8
    return hashes


def heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span as a number; shorter spans are filled up with zeros."""
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    piece = np.ascontiguousarray(eights[np.minimum(starts, len(data))]).view("<u8")[:, 0]
    return piece & _MASK[np.minimum(ends - starts, 8)]


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word sequences at each word; the last ``k - 1`` words begin none."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
        out ^= out >> np.uint64(31)
    return mix(out)


def owners(first: np.ndarray) -> np.ndarray:
    """For each word the index of its text, from ``word_spans``' third result."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))
