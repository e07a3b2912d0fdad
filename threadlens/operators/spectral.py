"""Dimension reduction that keeps neighbourhoods: leading eigenvectors of the normalised neighbour graph.

Points that are near each other are linked by edges whose weight falls with their distance, measured against how far both
points' neighbours are.  The eigenvectors are found by a block iteration (steps towards the residual and along the last step,
with a Rayleigh-Ritz choice in the space that they span): in a step, tasks that hold the edges of some points read the block's rows from the
shared folder, and one table of small products is summed per task.  Only matrices of a few dozen rows come to the driver.  What a
step has written is deleted when the next one has been, so the disk holds two steps however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written
from .neighbours import HELD, blocks, distinct_points, lists, matrix, nearest_neighbours, rows_of, shared_rows, spread

#: Columns beside the wanted ones, which speed the iteration up.
EXTRA = 10


def neighbour_graph(packed: DataFrame, n_neighbours: int) -> DataFrame:
    """Written edges (p, q, weight) in both directions: exp(-gap^2 / (reach of p * reach of q)), reach: the gap to the last neighbour."""
    near = nearest_neighbours(packed, 1, n_neighbours)
    reach = F.greatest(F.array_max(F.transform("near", lambda n: n["gap"])), F.lit(1e-300))
    one = near.select(F.col("node").alias("p"), reach.alias("a"), F.explode("near").alias("n")).select("p", "a", F.col("n.node").alias("q"), F.col("n.gap").alias("gap"))
    ends = one.join(near.select(F.col("node").alias("q"), reach.alias("b")), "q")
    there, back = F.struct("p", "q"), F.struct(F.col("q").alias("p"), F.col("p").alias("q"))
    both = ends.select(F.exp(-F.col("gap") * F.col("gap") / (F.col("a") * F.col("b"))).alias("weight"), F.explode(F.array(there, back)).alias("e"))
    graph = written(both.select("e.p", "e.q", "weight").dropDuplicates(["p", "q"]), "graph")
    discard(near)
    return graph


def normalised(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written edges (p, q, weight / sqrt(degrees)) and (node, degree)."""
    degree = written(graph.groupBy(F.col("p").alias("node")).agg(F.sum("weight").alias("degree")), "degrees")
    ends = graph.join(degree.select(F.col("node").alias("p"), F.col("degree").alias("a")), "p").join(degree.select(F.col("node").alias("q"), F.col("degree").alias("b")), "q")
    return written(ends.select("p", "q", (F.col("weight") / F.sqrt(F.col("a") * F.col("b"))).alias("weight")), "edges"), degree


def gathered(edges: DataFrame) -> DataFrame:
    """Written rows (node, q, weight): the edges of each point as two lists, in the order of the points at their ends."""
    rows = edges.repartition(spread(edges), "p").groupBy(F.col("p").alias("node")).agg(F.sort_array(F.collect_list(F.struct("q", "weight"))).alias("ends"))
    return written(rows.select("node", F.col("ends.q").alias("q"), F.col("ends.weight").alias("weight")), "ends")


def times(ends: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """(node, product): the matrix of the ``gathered`` edges times the written table's rows of numbers.

    A task holds the edges of some points and picks the rows at their other ends while it reads the whole table, some rows at a time.
    """
    files = rows.inputFiles()

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                waiting.append(whole.slice(i, 1024))
                held += len(waiting[-1]["q"].flatten())
                if held >= HELD:
                    yield product(waiting)
                    waiting, held = [], 0
        if waiting:
            yield product(waiting)

    def product(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        size = np.array([len(q) for q in lists(table["q"].chunk(0))])
        q, place = np.unique(table["q"].chunk(0).flatten().to_numpy(), return_inverse=True)
        weight, x = table["weight"].chunk(0).flatten().to_numpy(), None
        for batch in shared_rows(files, ["node", column], 1 << 16):
            node = batch["node"].to_numpy()
            at = np.minimum(np.searchsorted(q, node), len(q) - 1)
            mine = q[at] == node
            values = matrix(batch[column], batch.num_rows)
            x = np.zeros((len(q), values.shape[1])) if x is None else x
            x[at[mine]] = values[mine]
        first = np.cumsum(size) - size
        summed = np.stack([np.add.reduceat(x[place, i] * weight, first) for i in range(x.shape[1])], axis=1)
        return pa.RecordBatch.from_arrays([table["node"].chunk(0), rows_of(summed)], ["node", "product"])

    return ends.mapInArrow(multiply, "node bigint, product array<double>")


def _products(rows: DataFrame, left: tuple[str, ...], right: tuple[str, ...]) -> np.ndarray:
    """Transposed left columns times (left and right) columns, summed over all rows: partial sums leave the tasks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in filter(lambda b: b.num_rows, batches):
            a = np.hstack([matrix(batch[c], batch.num_rows) for c in left])
            b = np.hstack([matrix(batch[c], batch.num_rows) for c in right])
            total = total + np.hstack([a.T @ a, a.T @ b])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "x"])

    sums = rows.select(*dict.fromkeys(left + right)).mapInArrow(count, "at bigint, x double").groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").toArrow()
    values = sums["x"].to_numpy()
    size = round((len(values) / 2) ** 0.5)
    return values.reshape(size, 2 * size)


def _ritz(products: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` largest Ritz values and their coefficients in a space that need not be independent."""
    size = len(products)
    gram, image = products[:, :size], products[:, size:]
    scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
    values, vectors = np.linalg.eigh(gram * scale[:, None] * scale[None])
    keep = values > 1e-11 * values[-1]
    basis = scale[:, None] * vectors[:, keep] / np.sqrt(values[keep])
    small = basis.T @ ((image + image.T) / 2) @ basis
    ritz, chosen = np.linalg.eigh(small)
    return ritz[::-1][:width], basis @ chosen[:, ::-1][:, :width]


def leading_eigenvectors(edges: DataFrame, nodes: DataFrame, count: int, tolerance: float = 1e-7, max_rounds: int = 200) -> tuple[np.ndarray, DataFrame]:
    """The ``count`` largest eigenvalues of the symmetric matrix ``edges`` (p, q, weight), and (node, x) with the vectors' entries.

    The start is drawn from hashes of ``nodes`` (node), so runs agree; each vector's largest entries decide its sign.  ``tolerance`` bounds the
    length of each residual; it is an error if it is not reached.
    """
    n = nodes.count()
    width = min(count + EXTRA, n)
    ends = gathered(edges)
    start = F.array(*[F.xxhash64("node", F.lit(i)) / F.lit(float(2**63)) for i in range(width)])
    def follow(last: DataFrame, found: DataFrame) -> DataFrame:
        new = written(found, "state")
        discard(last)
        return new

    state = written(nodes.select("node", start.alias("x")), "start")
    state = follow(state, state.join(times(ends, state, "x").withColumnRenamed("product", "ax"), "node"))
    values, turn = _ritz(_products(state, ("x",), ("ax",)), width)

    def step(rows: DataFrame, columns: tuple[str, ...], held: int, turn: np.ndarray, values: np.ndarray) -> DataFrame:
        """New x and its image, the step that led there (from ``held`` columns of x) and its image, and the residual w."""
        images = tuple(f"a{c}" for c in columns)
        names = ["node", "x", "ax", "p", "ap", "w"]

        def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in filter(lambda b: b.num_rows, batches):
                z, az = (np.hstack([matrix(batch[c], batch.num_rows) for c in cs]) for cs in (columns, images))
                away = turn.copy()
                away[:held] = 0
                x, ax = z @ turn, az @ turn
                parts = [x, ax, z @ away, az @ away, ax - x * values]
                yield pa.RecordBatch.from_arrays([batch["node"], *map(rows_of, parts)], names)

        return rows.mapInArrow(combine, "node bigint, " + ", ".join(f"{c} array<double>" for c in names[1:]))

    columns, held = ("x",), width
    for done in range(max_rounds):
        state = follow(state, step(state, columns, held, turn, values))
        held = turn.shape[1]
        gaps = np.sqrt(np.diag(_products(state, ("w",), ("w",)))[:count])
        if gaps.max(initial=0) <= tolerance:
            break
        # The first step has no step before it.
        columns = ("x", "w", "p") if done else ("x", "w")
        state = follow(state, state.join(times(ends, state, "w").withColumnRenamed("product", "aw"), "node"))
        values, turn = _ritz(_products(state, columns, tuple(f"a{c}" for c in columns)), width)
    else:
        raise RuntimeError(f"eigenvectors did not settle in {max_rounds} rounds: residual {gaps.max():.2g}")
    discard(ends)
    signs = state.select(*[F.sum(F.pow(F.col("x")[i], 3)).alias(f"s{i}") for i in range(count)]).first()
    found = F.array(*[F.col("x")[i] * F.lit(1.0 if signs[i] >= 0 else -1.0) for i in range(count)])
    return values[:count], state.select("node", found.alias("x"))


def neighbour_coordinates(vectors: DataFrame, components: int, n_neighbours: int = 15, key: str = "unit_id", column: str = "embedding") -> DataFrame:
    """(``key``, reduced): coordinates of each row in which neighbours stay near, ``components`` of them (or as many as there are).

    Vectors are scaled to length one first (null vectors are left as they are); equal ones are one point.  The constant eigenvector is
    left out, and each other one is divided by the root of the degree, which makes it a coordinate.
    """
    if components < 1 or n_neighbours < 1:
        raise ValueError("components and n_neighbours are positive")
    v = F.col(column).cast("array<double>")
    norm = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-300))
    unit = vectors.select(F.col(key), F.transform(v, lambda x: x / norm).alias("unit"))
    members, points = distinct_points(unit, key, "unit")
    if points.count() < 3:
        return members.select(key, F.array_repeat(F.lit(0.0), components).alias("reduced"))
    packed = blocks(points)
    discard(points)
    graph = neighbour_graph(packed, n_neighbours)
    discard(packed)
    edges, degree = normalised(graph)
    discard(graph)
    total = degree.agg(F.sum("degree")).first()[0]
    count = min(components + 1, degree.count())
    _, found = leading_eigenvectors(edges, degree.select("node"), count)
    scale = F.sqrt(F.lit(total) / F.col("degree"))
    placed = found.join(degree, "node").select("node", F.transform(F.slice("x", 2, components), lambda x: x * scale).alias("reduced"))
    placed = written(placed, "coordinates")
    discard(found, degree, edges)
    return members.join(placed, "node").select(key, "reduced")
