"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels in a window below.

Scores are inner products.  Anchors stand in blocks; the anchors of a block are joined by a minimum spanning tree.  The root is
scored against every candidate; for a child at distance e from its parent, a candidate of norm n scores within e * n of what it
scores for the parent.  Only candidates whose interval overlaps the anchor's window (what it still looks for) are scored
themselves, which makes their interval a point again for the anchors below.

Every task reads its candidates once and meets the blocks of anchors one after another, from a written table in the
shared folder, so neither anchors nor candidates are ever held or sent as a whole, and only the best rows of each task are
shuffled.  A first search among the anchors alone finds scores that are surely reached, and with them narrower windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import filesystem, shared_path, staged

#: Anchors of a block, candidates that meet a block at once, and bytes of candidates that a task holds while blocks pass by.
BLOCK, CHUNK, HELD_BYTES = 512, 2048, 32 << 20
#: Scores are whole numbers; bounds are widened by this against rounding.
SLACK = 2.0
NO_ID = np.iinfo(np.int64).max
FOUND = "anchor bigint, window int, score bigint, vec_id bigint, row bigint"


def matrix(column: pa.Array, fill: float = 0.0) -> np.ndarray:
    """A column of lists as rows of floats; shorter lists and nulls in them are filled up."""
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    values = column.flatten().cast(pa.float64()).fill_null(fill).to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), fill)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree: the points in an order in which parents come first, each one's parent (-1: root) and edge length."""
    n = len(points)
    squares = (points * points).sum(axis=1)
    root = int(np.argmin(squares - 2 * points @ points.mean(axis=0)))
    near, parent = np.full(n, np.inf), np.full(n, -1)
    out, left, at = [], np.ones(n, bool), root
    for _ in range(n):
        out.append(at)
        left[at] = False
        gaps = squares + squares[at] - 2 * points @ points[at]
        closer = left & (gaps < near)
        near[closer], parent[closer] = gaps[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))
    order = np.array(out, np.int64)
    edges = np.where(parent >= 0, np.linalg.norm(points - points[parent], axis=1), 0.0)
    return order, parent, edges


def trees(anchors: DataFrame, count: int) -> DataFrame:
    """``anchors`` (row, vec_id, label, vec) dealt to blocks of at most ``BLOCK``: block, at (place in the block), parent (a place), edge."""
    names = ["block", "at", "parent", "edge", "row", "vec_id", "label", "vec"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            order, parent, edges = spanning_tree(matrix(rows["vec"].chunk(0)))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            up = np.where(parent[order] >= 0, place[parent[order]], -1)
            rows = rows.take(pa.array(order))
            # The row of the first anchor tells blocks apart.
            own = [pa.array(np.full(len(order), rows["row"][0].as_py())), pa.array(np.arange(len(order), dtype=np.int32)), pa.array(up.astype(np.int32)), pa.array(edges[order])]
            return pa.RecordBatch.from_arrays(own + [rows[c].combine_chunks() for c in names[4:]], names)

        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                pending.append(batch.slice(i, BLOCK))
                if sum(b.num_rows for b in pending) >= BLOCK:
                    rows = pa.Table.from_batches(pending)
                    yield block(rows.slice(0, BLOCK))
                    pending = rows.slice(BLOCK).to_batches()
        if any(b.num_rows for b in pending):
            yield block(pa.Table.from_batches(pending))

    dealt = anchors.select("row", "vec_id", "label", "vec").repartition(max(1, -(-count // BLOCK)))
    return dealt.mapInArrow(grow, "block bigint, at int, parent int, edge double, row bigint, vec_id bigint, label bigint, vec array<double>")


def packed(planted: DataFrame, windows: DataFrame) -> str:
    """Write one row for each block of anchors with its tree and windows (anchor, window, low, high; null: open); returns the folder."""
    lists = windows.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("looks"))
    full = planted.join(lists, "row", "left").withColumn("looks", F.coalesce("looks", F.array().cast("array<struct<window: int, low: bigint, high: bigint>>")))
    parts = F.struct("at", "parent", "edge", "row", "label", "vec", F.col("looks.window").alias("window"), F.col("looks.low").alias("low"), F.col("looks.high").alias("high"))
    path = shared_path(planted.sparkSession, "blocks")
    full.groupBy("block").agg(F.sort_array(F.collect_list(parts)).alias("anchors")).select("anchors").write.parquet(path)
    return path


class Block:
    """The anchors of a block in the order of their tree, their windows, and the best rows found for each window."""

    def __init__(self, anchors: pa.StructArray, same: bool, keep: int):
        field = dict(zip((f.name for f in anchors.type), anchors.flatten(), strict=True))
        numbers = {name: field[name].to_numpy(zero_copy_only=False) for name in ("parent", "edge", "row", "label")}
        self.parent, self.edge, self.row, self.label = numbers.values()
        self.points, self.same, self.keep = matrix(field["vec"]), same, keep
        # A window that does not exist is empty; one without a border is open to that side.
        names = matrix(field["window"], -1)
        absent = np.arange(names.shape[1]) >= np.diff(field["window"].offsets.to_numpy(zero_copy_only=False))[:, None]
        self.window = names.astype(np.int32)
        self.low = np.where(absent, np.inf, matrix(field["low"], -np.inf))
        self.high = np.where(absent, -np.inf, matrix(field["high"], np.inf))
        depth = np.zeros(len(self.parent), np.int64)
        for i in range(1, len(depth)):
            depth[i] = depth[self.parent[i]] + 1
        self.generations = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
        self.best: tuple[np.ndarray, ...] = tuple(np.zeros(0, np.int64) for _ in range(5))

    def meet(self, points: np.ndarray, norms: np.ndarray, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Look for the best rows among these candidates too."""
        width = max(points.shape[1], self.points.shape[1])
        points = np.pad(points, ((0, 0), (0, width - points.shape[1])))
        own = np.pad(self.points, ((0, 0), (0, width - self.points.shape[1])))
        least, most = self.low.min(axis=1, initial=np.inf), self.high.max(axis=1, initial=-np.inf)
        low, high = np.empty((len(own), len(points))), np.empty((len(own), len(points)))
        hits = []
        for depth, group in enumerate(self.generations):
            wanted = (self.label[group][:, None] == labels) == self.same
            if depth:
                reach = self.edge[group][:, None] * norms * (1 + 1e-9) + SLACK
                low[group], high[group] = low[self.parent[group]] - reach, high[self.parent[group]] + reach
                wanted &= (high[group] >= least[group][:, None]) & (low[group] <= most[group][:, None])
            at = np.flatnonzero(wanted.any(axis=0)) if depth else np.arange(len(points))
            if not len(at):
                continue
            # Candidates in the window of any anchor of this generation are scored for all of it.
            scores = own[group] @ (points[at] if len(at) < len(points) else points).T
            low[np.ix_(group, at)] = high[np.ix_(group, at)] = scores
            take = wanted[:, at] & (scores >= least[group][:, None]) & (scores <= most[group][:, None])
            if self.window.shape[1] == 1 and take.shape[1] > 4 * self.keep:
                # Of a single window no more than the best of these candidates, and their equals, can stay.
                top = np.partition(np.where(take, scores, -np.inf), -self.keep - 1, axis=1)[:, -self.keep - 1]
                take &= scores >= top[:, None]
            i, j = np.nonzero(take)
            hits.append((group[i], at[j], scores[i, j]))
        if not hits:
            return
        node, who, score = (np.concatenate(part) for part in zip(*hits, strict=True))
        other = rows[who] != self.row[node]
        node, who, score = node[other], who[other], score[other]
        pair, place = np.nonzero((score[:, None] >= self.low[node]) & (score[:, None] <= self.high[node]))
        fresh = (node[pair], place, score[pair].astype(np.int64), ids[who[pair]], rows[who[pair]])
        node, place, score, number, row = (np.concatenate(part) for part in zip(self.best, fresh, strict=True))
        order = np.lexsort((row, number, -score, place, node))
        group = node[order] * self.window.shape[1] + place[order]
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        rank = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
        order = order[rank < self.keep]
        self.best = tuple(part[order] for part in (node, place, score, number, row))
        # A full window asks for no less than its last row's score.
        last = rank[rank < self.keep] == self.keep - 1
        node, place, score = (part[last] for part in self.best[:3])
        self.low[node, place] = np.maximum(self.low[node, place], score)

    def found(self) -> pa.RecordBatch:
        node, place, score, number, row = self.best
        arrays = [pa.array(self.row[node]), pa.array(self.window[node, place]), pa.array(score), pa.array(number, mask=number == NO_ID), pa.array(row)]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "window", "score", "vec_id", "row"])


def read_blocks(path: str, same: bool, keep: int) -> Iterator[Block]:
    store, folder = filesystem(path)
    for info in sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=1):
                    yield Block(batch["anchors"].flatten(), same, keep)


def search(rows: DataFrame, path: str, same: bool, keep: int) -> DataFrame:
    """The best ``keep`` of ``rows`` (row, vec_id, label, vec) for each window of the written blocks, found task by task and merged."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def meet_all() -> Iterator[pa.RecordBatch]:
            for block in read_blocks(path, same, keep):
                for part in held:
                    block.meet(*part)
                if len(block.best[0]):
                    yield block.found()

        for whole in batches:
            for i in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(i, CHUNK)
                points = matrix(batch["vec"])
                ids = batch["vec_id"].fill_null(int(NO_ID)).to_numpy()
                held.append((points, np.linalg.norm(points, axis=1), batch["label"].to_numpy(), ids, batch["row"].to_numpy()))
                if sum(part[0].nbytes for part in held) >= HELD_BYTES:
                    yield from meet_all()
                    held.clear()
        if held:
            yield from meet_all()

    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    found = rows.select("row", "vec_id", "label", "vec").mapInArrow(scan, FOUND)
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep)


def nearest(rows: DataFrame, planted: DataFrame, windows: DataFrame, same: bool, keep: int) -> DataFrame:
    """The best ``keep`` rows for each window, after a search among the anchors has narrowed the windows."""
    among = search(planted, packed(planted, windows), same, keep)
    sure = among.where(F.col("rank") == keep).select("anchor", "window", F.col("score").alias("sure"))
    narrow = staged(windows.join(sure, ["anchor", "window"], "left").withColumn("low", F.greatest("low", "sure")).drop("sure"), "windows")
    return staged(search(rows, packed(planted, narrow), same, keep), "nearest")


def mine(vectors: DataFrame, anchors: str, n_positives: int = 5, n_negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``vectors`` (vec_id, label, embedding).

    ``anchors`` is an SQL condition on these columns.  An anchor's positives are its ``n_positives`` best other rows of its
    label; for each, the ``n_negatives`` best rows of other labels with share[0] * positive <= share[1] * negative <= share[1] *
    positive are returned (all, if fewer).  Higher scores come first, ties by smaller vec_id.

    Components are whole numbers (as doubles); scores are exact below 2^53.  Rows with a null label, a null vector, or a null or
    non-finite component take no part.  Shorter vectors count as filled up with zeros.  Rows are told apart by themselves:
    of rows that share a vec_id, or a vector, each is a candidate of its own and each anchor is mined; a row without a
    vec_id comes last among ties and has a null id in the result.  No anchors, no rows or one label only: an empty result.
    """
    if n_positives < 1 or n_negatives < 1 or not 0 < share[0] <= share[1]:
        raise ValueError("positives, negatives and shares are positive numbers")
    sound = F.expr("label IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    rows = vectors.where(sound).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.coalesce(F.expr(anchors), F.lit(False)).alias("anchor"),
    )
    rows = staged(rows, "vectors")
    picked = rows.where("anchor")
    planted = staged(trees(picked, picked.count()), "trees")
    none = F.lit(None).cast("bigint")
    whole = planted.select(F.col("row").alias("anchor"), F.lit(1).alias("window"), none.alias("low"), none.alias("high"))
    positives = nearest(rows, planted, whole, True, n_positives)
    least = F.expr(f"({share[0]} * score + {share[1] - 1}) div {share[1]}")
    windows = positives.where("score >= 0").select("anchor", F.col("rank").alias("window"), least.alias("low"), F.col("score").alias("high"))
    negatives = nearest(rows, planted, windows, False, n_negatives)
    pairs = positives.select("anchor", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = negatives.select("anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, ["anchor", "window"])
    found = found.join(planted.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
