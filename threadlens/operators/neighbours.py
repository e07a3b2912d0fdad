"""Points in blocks along a space-filling curve, and searches that meet only the blocks that can matter.

Blocks hold at most ``BLOCK`` neighbouring points (a sixteenth of that if vectors are short, so that boxes tell more) and know
their bounding box.  A search first pairs blocks by their boxes, so distances between points are only taken inside the chosen
pairs of blocks, as matrices in Arrow tasks; no table of pairs of points exists.  Neighbouring blocks form a chunk, and a chunk
gets each block that any of its own must meet once.  Boxes leave out few pairs of blocks of long vectors, so there a task reads the
blocks that its own must meet from the shared folder and keeps the nearest points only: neither blocks nor candidates are exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, written

#: Points of a block, bits of the curve's numbers, and boxes that are sent to the tasks at once (a few megabytes).
BLOCK, CURVE_BITS, BOXES = 1024, 60, 50_000
#: Numbers of a short vector, all of which the curve uses.
SHORT = CURVE_BITS // 4
#: Bytes of vectors that one group of a search gets from other chunks, and distances that are held at once, about.
SLICE_BYTES, HELD = 1 << 27, 1 << 21
#: Blocks of long vectors that a task holds while it reads all others once, and blocks that are read at once.
OWN, READ = 64, 2


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows; summed dimension by dimension, so that a pair has one value wherever it is met."""
    total = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        gap = x[:, i, None] - y[None, :, i]
        total += gap * gap
    return np.sqrt(total)


def box_gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Least distances between boxes (or points, where low is high): (rows of low) x (rows of lows)."""
    total = np.zeros((len(low), len(lows)))
    for i in range(low.shape[1]):
        gap = np.maximum(0, np.maximum(lows[None, :, i] - high[:, i, None], low[:, i, None] - highs[None, :, i]))
        total += gap * gap
    return np.sqrt(total)


def box_spans(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Greatest distances between points of two boxes."""
    total = np.zeros((len(low), len(lows)))
    for i in range(low.shape[1]):
        span = np.maximum(highs[None, :, i] - low[:, i, None], high[:, i, None] - lows[None, :, i])
        total += span * span
    return np.sqrt(total)


def lists(column: pa.Array) -> list[np.ndarray]:
    """A list column as one array per row."""
    offsets = column.offsets.to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return [values[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:])]


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def rows_of(values: np.ndarray) -> pa.ListArray:
    """A matrix as a column with one list per row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


def distinct_points(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """Written tables (key, node) and (node, vec, copies): equal vectors are one point, however many rows have them.

    Nodes are numbered in the order of their vectors, so ties fall alike however the table is partitioned.
    """
    rows = written(vectors.select(F.col(key), F.col(column).cast("array<double>").alias("vec")), "vectors")
    points = rows.groupBy("vec").agg(F.count(F.lit(1)).alias("copies"))
    points = written(points.orderBy("vec").select(F.monotonically_increasing_id().alias("node"), "vec", "copies"), "points")
    members = written(rows.join(points, "vec").select(key, "node"), "members")
    discard(rows)
    return members, points


def on_curve(points: DataFrame) -> DataFrame:
    """``points`` with ``curve``: interleaved bits of their first coordinates, scaled to the table's bounds."""
    size = F.size("vec")
    shape = points.agg(F.max(size).alias("high"), F.min(size).alias("low")).first()
    if shape.high != shape.low:
        raise ValueError("vectors differ in length")
    used = min(shape.high, SHORT)
    bits = CURVE_BITS // used
    bounds = points.agg(*[f(F.col("vec")[i]).alias(f"{name}{i}") for i in range(used) for name, f in (("low", F.min), ("high", F.max))]).first()
    low = np.array([bounds[f"low{i}"] for i in range(used)])
    width = np.maximum(np.array([bounds[f"high{i}"] for i in range(used)]) - low, 1e-300)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = matrix(batch["vec"], batch.num_rows)[:, :used]
            cells = np.clip((vec - low) / width * (2**bits - 1), 0, 2**bits - 1).astype(np.int64)
            curve = np.zeros(batch.num_rows, np.int64)
            for bit in range(bits - 1, -1, -1):
                for i in range(used):
                    curve = curve << 1 | cells[:, i] >> bit & 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve)], [*batch.schema.names, "curve"])

    return points.select("node", "vec", "copies").mapInArrow(place, "node bigint, vec array<double>, copies bigint, curve bigint")


def halves(vec: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Places of the rows of ``vec`` in parts of at most ``most``: cut at the median of the widest dimension, again and again."""
    todo = [np.arange(len(vec))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            yield rows
            continue
        widest = np.ptp(vec[rows], axis=0).argmax()
        rows = rows[np.argsort(vec[rows, widest], kind="stable")]
        todo += [rows[len(rows) // 2 :], rows[: len(rows) // 2]]


def blocks(points: DataFrame) -> DataFrame:
    """Written rows (block, chunk, node, vec, copies, low, high): lists of at most ``BLOCK`` points, ``vec`` all of them in a row."""
    names = ["block", "chunk", "node", "vec", "copies", "low", "high"]
    most = BLOCK

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.combine_chunks()
            vec, node, copies = matrix(rows["vec"].chunk(0), rows.num_rows), rows["node"].to_numpy(), rows["copies"].to_numpy()
            # Long vectors leave hardly any pair of boxes out, so small boxes would only be more of them.
            for at in halves(vec, max(min(most, 8), most // 16) if vec.shape[1] <= SHORT else most):
                x = vec[at]
                flat = [node[at], x.ravel(), copies[at], x.min(axis=0), x.max(axis=0)]
                chunk = node[0] if vec.shape[1] <= SHORT else node[at[0]]
                yield pa.RecordBatch.from_arrays([pa.array([node[at[0]]]), pa.array([chunk]), *[pa.array([x]) for x in flat]], names)

        pending = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            pending = pa.concat_tables([pending, more]) if pending is not None else more
            # What is left at the end is not much smaller than the others: few points in a block have far neighbours.
            while pending.num_rows >= 8 * most:
                yield from cut(pending.slice(0, 4 * most))
                pending = pending.slice(4 * most)
        if pending is not None and pending.num_rows:
            yield from cut(pending)

    curve = on_curve(points).repartitionByRange("curve", "node").sortWithinPartitions("curve", "node").drop("curve")
    shape = "block bigint, chunk bigint, node array<bigint>, vec array<double>, copies array<bigint>, low array<double>, high array<double>"
    return written(curve.mapInArrow(pack, shape), "blocks")


def boxes(packed: DataFrame, *more: str) -> Iterator[dict[str, np.ndarray]]:
    """Block ids, boxes and further numbers of all blocks, a bounded slice of them at a time."""
    n = packed.count()
    slices = max(1, -(-n // BOXES))
    for i in range(slices):
        part = packed.where(F.pmod(F.xxhash64("block"), F.lit(slices)) == i) if slices > 1 else packed
        found = part.select("block", "low", "high", *more).toArrow().combine_chunks()
        if found.num_rows:
            out = {c: found[c].to_numpy() for c in ("block", *more)}
            yield out | {c: matrix(found[c].chunk(0), found.num_rows) for c in ("low", "high")}


def block_pairs(packed: DataFrame, choose: Callable[[dict[str, np.ndarray], pa.RecordBatch], list[np.ndarray]], *more: str) -> DataFrame:
    """Rows (a, b): for each block of ``packed`` the blocks that ``choose(slice of boxes, rows)`` names, as places in the slice."""
    out = None
    for known in boxes(packed, *more):
        def find(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, 16):
                    batch = whole.slice(i, 16)
                    found = choose(known, batch)
                    a = np.repeat(batch["block"].to_numpy(), [len(f) for f in found])
                    b = known["block"][np.concatenate(found)] if len(a) else a
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        part = packed.mapInArrow(find, "a bigint, b bigint")
        out = part if out is None else out.unionByName(part)
    return out


def spread(packed: DataFrame) -> int:
    """Partitions for pairs of blocks: a pair costs far more time than its bytes tell, so their number is not left to their size."""
    spark = packed.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def met(pairs: DataFrame, packed: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Chosen pairs of blocks with the columns of both, as ``a_...`` and ``b_...``."""
    tasks = spread(packed)

    def side(name: str) -> DataFrame:
        return packed.select(F.col("block").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    return pairs.join(side("b"), "b").repartition(tasks, "a").join(side("a"), "a")


class Side(NamedTuple):
    """Blocks of one group: their points' columns in a row, and where each block's points are."""

    block: np.ndarray
    start: np.ndarray
    size: np.ndarray
    columns: dict[str, np.ndarray]

    def points(self, found: np.ndarray) -> np.ndarray:
        """Places of the points of the blocks ``found``, which are in order here."""
        at = np.searchsorted(self.block, found)
        size = self.size[at]
        return np.repeat(self.start[at] - np.cumsum(size) + size, size) + np.arange(size.sum())


def _side(rows: pa.Table, columns: tuple[str, ...]) -> Side:
    rows = rows.sort_by("block").combine_chunks()
    flat = {c: rows[c].chunk(0).flatten().to_numpy(zero_copy_only=False) for c in columns}
    size = np.array([len(n) for n in lists(rows["node"].chunk(0))])
    flat["vec"] = flat["vec"].reshape(size.sum(), -1)
    return Side(rows["block"].to_numpy(), np.cumsum(size) - size, size, flat)


def compared(pairs: DataFrame, packed: DataFrame, columns: tuple[str, ...], compare: Callable[[Iterator[tuple[dict, dict]]], pa.Table], shape: str) -> DataFrame:
    """What ``compare`` makes of the chosen pairs (a, b) of blocks: of two blocks of long vectors, or of a chunk and all that it must meet.

    It gets for each block the columns of its points, and those of the points of blocks that it is paired with, some of these points at a time.
    """
    shapes = packed.agg(F.coalesce(F.sum(F.size("vec")), F.lit(0)).alias("numbers"), F.max(F.size("low")).alias("width")).first()
    if (shapes.width or 0) > SHORT:
        def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(whole.num_rows):
                    row = whole.slice(i, 1)
                    a, b = ({c: lists(row[f"{side}_{c}"])[0] for c in columns} for side in "ab")
                    for side in (a, b):
                        side["vec"] = side["vec"].reshape(len(side["node"]), -1)
                    yield from compare(iter([(a, b)])).to_batches()

        return met(pairs, packed, columns).mapInArrow(one_by_one, shape)
    tasks, keys, slices = spread(packed), ("chunk", "slice"), 1 + 8 * shapes.numbers // SLICE_BYTES
    pairs = pairs.join(packed.select(F.col("block").alias("a"), "chunk"), "a").withColumn("slice", F.pmod(F.xxhash64("b"), F.lit(slices)))
    held = packed.select("block", *columns)
    ours = pairs.groupBy("a", *keys).agg(F.collect_list("b").alias("others")).withColumnRenamed("a", "block").join(held, "block")
    their_keys = "to_chunk", "of_slice"
    theirs = pairs.select(F.col("b").alias("block"), *[F.col(k).alias(t) for k, t in zip(keys, their_keys, strict=True)]).distinct().join(held, "block")

    def meet(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        def all_met() -> Iterator[tuple[dict, dict]]:
            own, other = _side(a, columns), _side(b, columns)
            a_rows = a.sort_by("block").combine_chunks()
            for block, others in zip(own.block, lists(a_rows["others"].chunk(0)), strict=True):
                at = own.points(np.array([block]))
                x = {c: v[at] for c, v in own.columns.items()}
                to = other.points(np.sort(others))
                for i in range(0, len(to), most := max(1, HELD // len(at))):
                    yield x, {c: v[to[i : i + most]] for c, v in other.columns.items()}

        return compare(all_met())

    first, second = (side.repartition(tasks, *by).groupBy(*by) for side, by in ((ours, keys), (theirs, their_keys)))
    return first.cogroup(second).applyInArrow(meet, shape)


def shared_rows(files: list[str], columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of a written table, some at a time, as a task reads them from the shared folder."""
    for name in files:
        system, path = fs.FileSystem.from_uri(name)
        with system.open_input_file(path) as file:
            yield from pq.ParquetFile(file, buffer_size=1 << 20).iter_batches(rows, columns=columns, use_threads=False)


class Nearest:
    """The nearest points so far of each point of a block of long vectors, up to ``most`` of them, by (gap, node)."""

    def __init__(self, node: np.ndarray, vec: np.ndarray, reach: np.ndarray, most: int):
        self.node, self.vec, self.reach, self.most = node, vec, reach, most
        self.square = (vec * vec).sum(axis=1)
        self.gap = np.full((len(node), most), np.inf)
        self.other = np.full((len(node), most), -1)
        self.copies = np.zeros((len(node), most), np.int64)

    def meet(self, node: np.ndarray, vec: np.ndarray, square: np.ndarray, copies: np.ndarray) -> None:
        """A matrix product tells which points may be near enough; only their distances are taken, with the values of ``distances``."""
        limit = np.minimum(self.reach, self.gap[:, -1])
        rough = self.square[:, None] + square - 2 * (self.vec @ vec.T)
        slack = (vec.shape[1] + 8) * 2.0**-50 * (self.square + square.max())
        at, to = np.nonzero(~(rough > (limit * limit + slack)[:, None]))
        gap = np.zeros(len(at))
        for i in range(vec.shape[1]):
            step = self.vec[at, i] - vec[to, i]
            gap += step * step
        gap = np.sqrt(gap)
        close = gap <= limit[at]
        at, to, gap = at[close], to[close], gap[close]
        rows, places = np.unique(at, return_inverse=True)
        old, held = np.nonzero(self.copies[rows])
        row = np.concatenate([old, places])
        gap = np.concatenate([self.gap[rows][old, held], gap])
        other = np.concatenate([self.other[rows][old, held], node[to]])
        copies = np.concatenate([self.copies[rows][old, held], copies[to]])
        order = np.lexsort([other, gap, row])
        first = np.searchsorted(row[order], np.arange(len(rows)))
        rank = np.arange(len(order)) - first[row[order]]
        order, rank = order[rank < self.most], rank[rank < self.most]
        target = rows[row[order]], rank
        self.gap[target], self.other[target], self.copies[target] = gap[order], other[order], copies[order]

    def found(self, samples: int, keep: int) -> pa.RecordBatch:
        """Rows (node, core, near) of the points that have met any, which a point with a missing number has not."""
        met = self.copies[:, 0] > 0
        gap, other, copies = self.gap[met], self.other[met], self.copies[met]
        reached = np.cumsum(copies, axis=1) >= samples
        core = np.where(reached.any(axis=1), np.take_along_axis(gap, reached.argmax(axis=1)[:, None], axis=1)[:, 0], np.inf)
        near = (copies > 0) & (other != self.node[met][:, None])
        near &= (np.arange(self.most) <= keep) & (np.cumsum(near, axis=1) <= keep)
        entries = pa.StructArray.from_arrays([pa.array(gap[near]), pa.array(other[near])], ["gap", "node"])
        offsets = pa.array(np.concatenate([[0], np.cumsum(near.sum(axis=1))]), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(self.node[met]), pa.array(core), pa.ListArray.from_arrays(offsets, entries)], ["node", "core", "near"])


def _nearest_of_long(pairs: DataFrame, held: DataFrame, samples: int, keep: int) -> DataFrame:
    """``nearest_neighbours`` of long vectors: a task holds some blocks and reads all others that these must meet, a few at a time."""
    files, tasks = held.inputFiles(), spread(held)
    chosen = pairs.repartition(tasks, "a").groupBy("a").agg(F.collect_list("b").alias("others"))
    own = held.select("block", "node", "vec", "reach").repartition(tasks, "block")
    names = ["node", "vec", "reach", "others"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[Nearest, np.ndarray]] = []
        for batch in batches:
            for node, vec, reach, others in zip(*(lists(batch[c]) for c in names), strict=True):
                waiting.append((Nearest(node, vec.reshape(len(node), -1), reach, max(keep + 1, samples)), np.sort(others)))
                if len(waiting) == OWN:
                    yield from ended(waiting)
                    waiting = []
        if waiting:
            yield from ended(waiting)

    def ended(waiting: list[tuple[Nearest, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for batch in shared_rows(files, ["block", "node", "vec", "copies"], READ):
            block = batch["block"].to_numpy()
            node, copies = (batch[c].flatten().to_numpy() for c in ("node", "copies"))
            vec = batch["vec"].flatten().to_numpy().reshape(len(node), -1)
            square, size = (vec * vec).sum(axis=1), [len(n) for n in batch["node"]]
            for mine, others in waiting:
                wanted = np.isin(block, others)
                points = slice(None) if wanted.all() else np.repeat(wanted, size)
                if wanted.any():
                    mine.meet(node[points], vec[points], square[points], copies[points])
        for mine, _ in waiting:
            yield mine.found(samples, keep)

    rows = own.join(chosen, own["block"] == chosen["a"]).select(*names)
    return rows.mapInArrow(search, "node bigint, core double, near array<struct<gap: double, node: bigint>>")


def _own_reach(packed: DataFrame, samples: int, keep: int) -> DataFrame:
    """``packed`` with ``reach``: for each point a distance within which its own block has enough points and neighbours."""
    names = [*packed.columns, "reach"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                row = whole.slice(i, 1)
                copies = lists(row["copies"])[0]
                vec = matrix(row["vec"], len(copies))
                gaps = distances(vec, vec)
                order = np.argsort(gaps, axis=1, kind="stable")
                full = np.cumsum(copies[order], axis=1) >= samples
                last = np.maximum(np.where(full.any(axis=1), full.argmax(axis=1), len(copies)), keep)
                ordered = np.pad(np.take_along_axis(gaps, order, axis=1), ((0, 0), (0, keep + 1)), constant_values=np.inf)
                reach = ordered[np.arange(len(copies)), np.minimum(last, len(copies))]
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([reach])], names)

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema) + ", reach array<double>"
    return written(packed.mapInArrow(add, shape), "reach")


def nearest_neighbours(packed: DataFrame, samples: int, keep: int) -> DataFrame:
    """Written rows (node, core, near: array of (gap, node)): the ``keep`` nearest other points, and the core distance.

    The core distance is the least within which a point has ``samples`` rows, itself and copies counted; infinite if the table
    has fewer.  Ties go to the smaller node.
    """
    held = _own_reach(packed, samples, keep)
    names = ["node", "gap", "other", "copies"]

    def choose(known: dict[str, np.ndarray], batch: pa.RecordBatch) -> list[np.ndarray]:
        out = []
        for vec, reach in zip(lists(batch["vec"]), lists(batch["reach"]), strict=True):
            points = vec.reshape(len(reach), -1)
            low, high = points.min(axis=0)[None], points.max(axis=0)[None]
            near = np.flatnonzero(box_gaps(low, high, known["low"], known["high"])[0] <= reach.max())
            out.append(near[(box_gaps(points, points, known["low"][near], known["high"][near]) <= reach[:, None]).any(axis=0)])
        return out

    def compare(pairs: Iterator[tuple[dict, dict]]) -> pa.Table:
        out, most = [], max(keep + 1, samples)
        for a, b in pairs:
            gaps, limit = distances(a["vec"], b["vec"]), a["reach"]
            if len(b["node"]) > most:
                limit = np.minimum(limit, np.partition(gaps, most, axis=1)[:, most])
            at, to = np.nonzero(gaps <= limit[:, None])
            out.append((a["node"][at], gaps[at, to], b["node"][to], b["copies"][to]))
        return pa.table([np.concatenate(column) for column in zip(*out, strict=True)], names)

    pairs = written(block_pairs(held, choose), "near_blocks")
    if (held.agg(F.max(F.size("low"))).first()[0] or 0) > SHORT:
        near = written(_nearest_of_long(pairs, held, samples, keep), "neighbours")
        discard(held, pairs)
        return near
    found = compared(pairs, held, ("node", "vec", "copies", "reach"), compare, "node bigint, gap double, other bigint, copies bigint")
    order = Window.partitionBy("node").orderBy("gap", "other")
    ranked = found.withColumn("rank", F.row_number().over(order)).withColumn("reached", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    entry = F.when((F.col("other") != F.col("node")) & (F.col("rank") <= keep + 1), F.struct("gap", F.col("other").alias("node")))
    core = F.coalesce(F.min(F.when(F.col("reached") >= samples, F.col("gap"))), F.lit(float("inf")))
    grouped = ranked.where((F.col("rank") <= keep + 1) | (F.col("reached") - F.col("copies") < samples)).groupBy("node")
    near = written(grouped.agg(core.alias("core"), F.slice(F.sort_array(F.collect_list(entry)), 1, keep).alias("near")), "neighbours")
    discard(held, pairs)
    return near
