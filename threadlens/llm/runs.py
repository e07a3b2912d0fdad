"""Periodic stretches of words, caught by dyadic catchers.

A run is a stretch of words with a smallest period q, at least three periods long, that neither neighbour extends.
Every completed block of a power of two of words (at a multiple of its length from the start of the text) gets a catcher,
which watches for periods from its length up to twice that, the smallest blocks for all shorter periods too.  When a
word is appended, a catcher whose block lies d words behind compares its block with the words that end there: if they are
equal, d is the distance of a square's halves.  A run of period d repeats at least two periods of words at distance
d, which holds a whole block of the catcher's size, so no run is missed; catches in neighbouring blocks merge, the first of
them is extended to both sides, and of equal stretches the smallest period is the run's.

The comparisons of all words of a block of texts are made level by level in arrays: a text of n words costs n of them on each
of log n levels, and a number of comparisons in proportion to log n for each extension.  Words are told apart by 64-bit hashes,
longer stretches by two prefix sums modulo primes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DARK, blocks, hash_words, mix, utf8, word_spans

MODULI = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_299_709_321))
#: Comparisons of catchers that are held at once.
AT_ONCE = 1 << 20
#: The contract's least length and least number of periods.
MIN_LENGTH, MIN_PERIODS = 24, 3
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Stretches:
    """Tells whether two equally long stretches of words are equal, and how far two places go on equally."""

    def __init__(self, words: np.ndarray):
        self.sums, self.powers = [], []
        for p, r in MODULI:
            powers, step, p = np.ones(1, np.uint64), r, np.uint64(p)
            while len(powers) <= len(words):
                powers = np.concatenate([powers, powers * np.uint64(step) % p])
                step = step * step % int(p)
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words % p * powers[: len(words)] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether ``size`` words from each ``a`` equal those from ``b``, which is behind."""
        same = np.ones(len(a), bool)
        for (p, _), sums, powers in zip(MODULI, self.sums, self.powers, strict=True):
            p = np.uint64(p)
            left, right = (sums[a + size] + p - sums[a]) % p, (sums[b + size] + p - sums[b]) % p
            same &= left * powers[b - a] % p == right
        return same

    def reach(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, sign: int) -> np.ndarray:
        """How many words from ``a`` and ``b`` on (sign 1) or before them (sign -1) are equal, ``limit`` at most."""
        far = np.zeros(len(a), np.int64)
        size = 1 << int(limit.max(initial=1)).bit_length()
        while size:
            at = np.flatnonzero(far + size <= limit)
            shift = far[at] if sign > 0 else -far[at] - size
            far[at[self.equal(a[at] + shift, b[at] + shift, size)]] += size
            size >>= 1
        return far


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of twice as long windows, from those of ``size`` words."""
    return mix(hashes[:-size] * np.uint64(0x9E3779B97F4A7C15) + hashes[size:])


def catches(words: np.ndarray, first: np.ndarray, base: int, min_length: int, min_periods: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, block, distance) of every catch whose neighbour before it has none of that distance."""
    lengths, hashes, size = np.diff(first), words, 1
    while size < base:
        hashes, size = windows(hashes, size), 2 * size
    low = 1
    while len(deep := np.flatnonzero(lengths >= max(min_length, min_periods * low))):
        count = np.maximum((lengths[deep] - size - low) // size + 1, 0)
        text = np.repeat(deep, count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        at = first[text] + nth * size
        span = 2 * size - low
        for begin in range(0, len(at), rows := max(1, AT_ONCE // span)):
            block, owner = at[begin : begin + rows], text[begin : begin + rows]
            for nearest in range(low, 2 * size, AT_ONCE):
                distance = np.arange(nearest, min(2 * size, nearest + AT_ONCE))
                later = block[:, None] + distance
                inside = later + size <= first[owner + 1][:, None]
                hit = inside & (hashes[np.minimum(later, len(hashes) - 1)] == hashes[block][:, None])
                i, j = np.nonzero(hit)
                where, d, who = block[i], distance[j], owner[i]
                before = where - size
                new = before < first[who]
                new[~new] = hashes[before[~new]] != hashes[before[~new] + d[~new]]
                yield who[new], where[new], d[new]
        if 2 * size > len(hashes):
            return
        hashes, low = windows(hashes, size), 2 * size
        size = low


def runs_of(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, ...]:
    """Runs (text, start, end, period) in order of text, start and period; places count from the first text's first word.

    ``words`` are hashes of the words of all texts, ``first`` the place of each text's first word (and at last the end).
    """
    if min_periods < 3 or min_length < 1:
        raise ValueError("catchers find stretches of three periods or more")
    base = 1 << (max(1, (min_length + 2) // 3).bit_length() - 1)
    found: list[tuple[np.ndarray, ...]] = []
    stretches = None
    for text, block, d in catches(words, first, base, min_length, min_periods):
        if len(text):
            stretches = stretches or Stretches(words)
            start = block - stretches.reach(block, block + d, block - first[text], -1)
            end = block + d + stretches.reach(block, block + d, first[text + 1] - block - d, 1)
            long = end - start >= np.maximum(min_length, min_periods * d)
            found.append((text[long], start[long], end[long], d[long]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    text, start, end, d = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((d, end, start, text))
    text, start, end, d = (part[order] for part in (text, start, end, d))
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    text, start, end, d = (part[fresh] for part in (text, start, end, d))
    order = np.lexsort((d, start, text))
    return tuple(part[order] for part in (text, start, end, d))


def _collapsed(words: list[bytes], runs: list[dict]) -> bytes:
    """The words that no run contains after its first period, joined by a space."""
    kept, at = [], 0
    for begin, end in sorted((r["start"] + r["period"], r["start"] + r["length"]) for r in runs):
        kept += words[at : max(at, begin)]
        at = max(at, end)
    return b" ".join(kept + words[at:])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` has each run's start (word number), length and smallest period, ordered by start and period; ``collapsed``
    is the text's words, without those that a run contains after its first period, joined by a space.  Words are
    ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts have none, no run and an empty collapsed text.  Rows are scored
    one by one: repeated rows and rows without a doc_id are kept as they come, other columns are not looked at.
    """
    shape = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, offsets = utf8(batch["text"])
            starts, ends, first = word_spans(data, offsets, DARK)
            text, start, end, period = runs_of(hash_words(data, starts, ends), first, min_length, min_periods)
            runs: dict[int, list[dict]] = {}
            for t, s, e, q in zip(text.tolist(), (start - first[text]).tolist(), (end - first[text]).tolist(), period.tolist(), strict=True):
                runs.setdefault(t, []).append({"start": s, "length": e - s, "period": q})
            raw, at = data.tobytes(), offsets.tolist()
            said = []
            for i in range(batch.num_rows):
                words = raw[at[i] : at[i + 1]].split()
                said.append(_collapsed(words, runs[i]) if i in runs else b" ".join(words))
            arrays = [batch["doc_id"], pa.array(np.diff(first)), pa.array([runs.get(i, []) for i in range(batch.num_rows)], shape), pa.array(said, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_words bigint, runs {RUN}, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``periodic_runs``: the run of the greatest exponent, compared exactly, and digests."""
    top = F.expr(
        """aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),
           (best, run) -> CASE WHEN best IS NULL OR run.length * best.period > best.length * run.period THEN run ELSE best END)"""
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: The contract's planted repetition: in one document of ten the words from a on repeat the p words at a.
WORDS = r"regexp_extract_all(coalesce(text, ''), '([^\\x20\\x09-\\x0D]+)', 1)"


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's repetitions: rows without a doc_id or a word keep their text."""
    chosen = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = chosen.withColumn("words", F.expr(f"CASE WHEN h % 10 = 0 THEN {WORDS} END")).withColumn("n", F.size("words").cast("bigint"))
    chosen = chosen.withColumn("a", F.expr("CASE WHEN n > 0 THEN (h div 10) % n END")).withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    again = "array_join(transform(words, (w, i) -> CASE WHEN i < a THEN w ELSE words[CAST(a + (i - a) % p AS INT)] END), ' ')"
    return chosen.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN {again} ELSE text END").alias("text"))
