"""Near-duplicates by 64-bit SimHash fingerprints: generalised pigeonhole search, verified links, components.

Bits that vary together are put into the same partition.  A query that differs from a fingerprint in at most ``d``
bits differs from it by at most ``t[i]`` bits in some partition ``i``, for any thresholds with
``sum(t) = d - parts + 1`` (-1: partition not probed).  Dynamic programming chooses the thresholds of every single
fingerprint, by the numbers of candidates estimated from statistics over all fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import release, staged, without
from .graph import components

BITS = 64
DISTANCE = 2
#: Probes of a bucket are compared with its members one by one up to this size; larger buckets are linked by flipped bits.
BUCKET = 256


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text: bit b is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1]) if words else ends
    k = min(shingle, len(words))
    if not k:
        return 0
    digest, spans = xxhash.xxh64_intdigest, zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], 42) for s, e in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number.  Null and wordless texts have 0; rows are kept as they are."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(score, "doc_id bigint, fp bigint")


# --- statistics ---------------------------------------------------------------------


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both set (64 x 64 sums leave each task)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = _bits(_numbers(batch)).astype(np.float32)
            total += x.T @ x
            rows += len(x)
        values = np.append(total.ravel(), rows).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["pair", "n"])

    sums = dict(fps.select("fp").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n")).collect())
    both = np.array([sums.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)
    return int(sums.get(BITS * BITS, 0)), both


def partition_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Groups of correlated bits, of equal size but for one: each group grows by the bit that goes best with it."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    close = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0)
    left, groups = list(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        group = [max(left, key=lambda b: close[b, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: close[b, group].sum()))
            left.remove(group[-1])
        groups.append(group)
    return groups


def extract(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint, packed."""
    out = np.zeros(len(fps), np.int64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    return out


def _halves(groups: list[list[int]]) -> list[list[list[int]]]:
    return [[g[i : i + 11] for i in range(0, len(g), 11)] for g in groups]


def near_counts(fps: DataFrame, groups: list[list[int]], distance: int) -> list[list[np.ndarray]]:
    """For each block of at most 11 bits of each group and each value of it: the share of fingerprints at 0, 1 ... bits."""
    halves = _halves(groups)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[np.zeros(1 << len(h), np.int64) for h in hs] for hs in halves]
        for batch in batches:
            x = _numbers(batch)
            for g, hs in enumerate(halves):
                for j, h in enumerate(hs):
                    sums[g][j] += np.bincount(extract(x, h), minlength=1 << len(h))
        for g, hs in enumerate(sums):
            for j, s in enumerate(hs):
                at = np.flatnonzero(s)
                keys = pa.array((g << 20) + (j << 16) + at)
                yield pa.RecordBatch.from_arrays([keys, pa.array(s[at])], ["key", "n"])

    sums = dict(fps.select("fp").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n")).collect())
    out = []
    for g, hs in enumerate(halves):
        out.append([])
        for j, h in enumerate(hs):
            hist = np.array([sums.get((g << 20) + (j << 16) + v, 0) for v in range(1 << len(h))], float)
            values, shells = np.arange(1 << len(h)), []
            for d in range(distance + 1):
                flips = [sum(1 << b for b in c) for c in combinations(range(len(h)), d)]
                shells.append(sum((hist[values ^ f] for f in flips), np.zeros(len(hist))))
            out[-1].append(np.stack(shells, axis=1) / max(hist.sum(), 1))
    return out


# --- thresholds and signatures --------------------------------------------------------


def thresholds(fps: np.ndarray, n: int, groups: list[list[int]], near: list[list[np.ndarray]], distance: int) -> np.ndarray:
    """Thresholds of each fingerprint's partitions, by dynamic programming over the partitions.

    The cost of threshold t is the number of keys that are looked up and the number of candidates expected behind them.
    """
    parts, budget = len(groups), distance - len(groups) + 1
    choices = range(-1, distance + 1)
    low, high = -parts, max(budget + parts, distance)
    best = np.full((len(fps), high - low + 1), np.inf)
    best[:, -low] = 0
    picks = []
    for group, tables, blocks in zip(groups, near, _halves(groups), strict=True):
        shells = np.zeros((len(fps), distance + 1))
        shells[:, 0] = 1
        for table, bits in zip(tables, blocks, strict=True):
            own, joint = table[extract(fps, bits)], np.zeros_like(shells)
            for d in range(distance + 1):
                for e in range(d + 1):
                    joint[:, d] += shells[:, e] * own[:, d - e]
            shells = joint
        cost = np.zeros((len(fps), distance + 2))
        for t in range(distance + 1):
            cost[:, t + 1] = n * shells[:, : t + 1].sum(axis=1) + sum(comb(len(group), i) for i in range(t + 1))
        nxt, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for t in choices:
            for s in range(low, high + 1):
                if low <= s - t <= high:
                    value = best[:, s - t - low] + cost[:, t + 1]
                    better = value < nxt[:, s - low]
                    nxt[better, s - low], pick[better, s - low] = value[better], t
        best = nxt
        picks.append(pick)
    out, at = np.zeros((len(fps), parts), np.int8), np.full(len(fps), budget)
    for i in range(parts - 1, -1, -1):
        out[:, i] = picks[i][np.arange(len(fps)), at - low]
        at = at - out[:, i]
    return out


def signatures(fps: DataFrame, n: int, groups: list[list[int]], near: list[list[np.ndarray]], distance: int) -> DataFrame:
    """Rows (probe, part, key, fp): where a fingerprint is kept (probe false) and where it looks (probe true)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 20_000):
                x = _numbers(batch.slice(i, 20_000))
                chosen = thresholds(x, n, groups, near, distance)
                for g, bits in enumerate(groups):
                    keys = extract(x, bits)
                    looks = [(False, keys, x)]
                    for d in range(distance + 1):
                        who = chosen[:, g] >= d
                        for flip in combinations(range(len(bits)), d):
                            looks.append((True, keys[who] ^ sum(1 << b for b in flip), x[who]))
                    for probe, key, fp in looks:
                        if len(key):
                            arrays = [pa.array(np.full(len(key), probe)), pa.array(np.full(len(key), g, np.int32)), pa.array(key), pa.array(fp.view(np.int64))]
                            yield pa.RecordBatch.from_arrays(arrays, ["probe", "part", "key", "fp"])

    return fps.select("fp").mapInArrow(sign, "probe boolean, part int, key bigint, fp bigint")


# --- links ------------------------------------------------------------------------------


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, parts: int | None = None) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fps`` (fp) that differ in ``distance`` bits or fewer.

    Probes meet the members of buckets of up to ``bucket`` fingerprints, and each pair is verified.  Whoever is kept in
    or looks into a larger bucket is linked through the numbers one flipped bit away: two fingerprints differ in at most
    two bits if and only if they share such a number, at most 65 of them share one, and all that share one are linked.
    """
    if distance != DISTANCE:
        raise ValueError("large buckets are linked exactly for a distance of two bits")
    n, both = bit_counts(fps)
    groups = partition_bits(n, both, parts or (3 if n >> 21 <= 32 else 2))
    signs = staged(signatures(fps, n, groups, near_counts(fps, groups, distance), distance), "signatures")
    kept = signs.where("NOT probe").drop("probe")
    looks = signs.where("probe").drop("probe")
    large = staged(kept.groupBy("part", "key").count().where(F.col("count") > bucket).drop("count"), "buckets")
    pairs = (
        looks.withColumnRenamed("fp", "a")
        .join(kept.join(large, ["part", "key"], "left_anti").withColumnRenamed("fp", "b"), ["part", "key"])
        .where(F.col("a") < F.col("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select("a", "b")
    )
    return pairs.unionByName(flip_links(signs.join(large, ["part", "key"], "left_semi").select("fp").distinct()))


def flip_links(fps: DataFrame) -> DataFrame:
    """Links between fingerprints at two bits or fewer, by what they share one bit away."""
    near = "concat(array(fp), transform(sequence(0, 63), b -> fp ^ shiftleft(1L, b)))"
    shared = fps.selectExpr("fp", f"explode({near}) AS number").groupBy("number").agg(F.collect_set("fp").alias("fps"))
    stars = shared.where("size(fps) > 1").selectExpr("array_min(fps) AS a", "explode(fps) AS b")
    return stars.where("a <> b").distinct()


def grouped(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, shingle: int = 3) -> tuple[DataFrame, DataFrame]:
    """Written tables (doc_id, fp) of every row and (fp, root, component_id) of every fingerprint.

    ``root`` tells components apart; ``component_id`` is the smallest doc_id of one, null if no row of it has an id.
    """
    own = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    reached = staged(components(links(distinct, distance, bucket)), "reached").withColumnRenamed("node", "fp")
    firsts = reached.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("named"))
    named = distinct.join(reached.join(firsts, "root"), "fp", "left")
    return own, staged(named.select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("named", "first").alias("component_id")), "named")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of at most ``distance`` differing bits.  Null and empty
    texts have fingerprint zero and link like others; repeated rows are returned as often as they come; rows without a
    doc_id are linked but never name a component (null if no other row does).  Ids are whole numbers: an id that cannot
    be cast to one is an error.
    """
    own, named = grouped(docs, distance, bucket, shingle)
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, shingle: int = 3) -> DataFrame:
    """One row of each component of ``docs`` (doc_id, text): one with the smallest doc_id in it; columns as given.

    Verdicts are by row: of rows that share a doc_id, those in a component that the id names are told apart by their
    fingerprints and one of each such component stays, so a unique text under a repeated id stays too.  Of a component
    without any id one row stays.  Null and empty texts are one component.
    """
    own, named = grouped(docs, distance, bucket, shingle)
    names = F.expr("doc_id <=> component_id")
    ids = staged(own.join(named, "fp").groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_or(names).alias("names")), "ids")
    kept = without(docs, staged(ids.where("NOT names OR rows > 1 OR doc_id IS NULL").select("doc_id"), "leaving"))
    shared = staged(ids.where("names AND (rows > 1 OR doc_id IS NULL)").select(F.col("doc_id").alias("__id")), "shared")
    if shared.isEmpty():
        return kept
    # Only rows of shared ids have to meet, as (fingerprint, whole row).
    met = docs.join(shared, docs["doc_id"].eqNullSafe(shared["__id"]), "left_semi")
    kinds = met.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], pa.array(found.view(np.int64))], ["row", "doc_id", "fp"])

    marked = kinds.mapInArrow(mark, StructType([kinds.schema["row"], kinds.schema["doc_id"], StructField("fp", LongType())]))
    once = marked.join(named, "fp").where(names).dropDuplicates(["root"]).select("row.*")
    return kept.unionByName(once)
