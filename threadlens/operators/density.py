"""Density topics: reduced vectors -> grid cells -> connected dense cells -> topics with outliers.

Works on cells instead of pairs of points, so a dense spot costs one counter
however many points it holds, and copies of one text cost nothing extra.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import TopicOptions
from ..session import materialise, written
from .ingest import with_row_id
from .messages import keep_first
from .topics import OUTLIER


def reduce_dimensions(vectors: DataFrame, components: int) -> DataFrame:
    """Principal components of the L2-normalised vectors, as ``reduced``."""
    dense = vectors.withColumn("__v", array_to_vector(F.col("embedding").cast("array<double>")))
    normed = Normalizer(p=2.0, inputCol="__v", outputCol="__u").transform(dense)
    model = PCA(k=components, inputCol="__u", outputCol="__p").fit(normed)
    return model.transform(normed).withColumn("reduced", vector_to_array("__p")).drop("__v", "__u", "__p")


def grid_cell(reduced: Column, width: float) -> Column:
    return F.transform(reduced, lambda x: F.floor(x / F.lit(width)).cast("bigint"))


def neighbour_cells(cell: Column, components: int) -> Column:
    """Cells that share a face or an edge with ``cell`` (one or two coordinates off by one)."""
    steps: list[tuple[int, ...]] = []
    for i in range(components):
        for a in (-1, 1):
            one = [0] * components
            one[i] = a
            steps.append(tuple(one))
            for j in range(i + 1, components):
                for b in (-1, 1):
                    two = list(one)
                    two[j] = b
                    steps.append(tuple(two))
    offsets = F.array(*[F.array(*[F.lit(s).cast("bigint") for s in step]) for step in steps])
    return F.transform(offsets, lambda step: F.zip_with(cell, step, lambda c, s: c + s))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) for ``nodes(node)`` and undirected ``edges(a, b)``; the component is one of its nodes.

    Contraction: every node points to its smallest neighbour, takes that
    neighbour's pointer too, and the graph is rewritten in terms of the targets
    until no edge is left.  Connected nodes stay connected under the rewriting,
    and the edge list shrinks every round; each round is written out.
    """
    labels = nodes.select("node", F.col("node").alias("component"))
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = materialise(both.where("a <> b").distinct())
    while not live.isEmpty():
        pointer = live.groupBy("a").agg(F.min("b").alias("__low")).select("a", F.least("a", "__low").alias("to"))
        onward = pointer.select(F.col("a").alias("to"), F.col("to").alias("__next"))
        target = materialise(pointer.join(onward, "to").select("a", F.col("__next").alias("to")))
        renamed = live.join(target, "a").select(F.col("to").alias("a"), F.col("b").alias("__b"))
        live = materialise(
            renamed.join(target.select(F.col("a").alias("__b"), F.col("to").alias("b")), "__b")
            .select("a", "b")
            .where("a <> b")
            .distinct()
        )
        moved = target.select(F.col("a").alias("component"), "to")
        labels = materialise(
            labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        )
    return labels


def cell_topics(cells: DataFrame, components: int, min_samples: int, min_cluster_size: int) -> DataFrame:
    """(cell, topic_id) for ``cells(cell, n)``.

    Cells with at least ``min_samples`` points are dense; touching dense cells
    form a cluster; a sparser cell joins the densest cluster cell it touches.
    Clusters below ``min_cluster_size`` points and all other cells are outliers.
    Topics are numbered from the largest.
    """
    known = materialise(cells.withColumn("node", F.monotonically_increasing_id()))
    dense = known.where(F.col("n") >= min_samples)
    around = dense.select("node", "n", F.explode(neighbour_cells(F.col("cell"), components)).alias("cell"))
    edges = around.join(dense.select("cell", F.col("node").alias("b")), "cell").select(F.col("node").alias("a"), "b")
    found = connected_components(dense.select("node"), edges.where("a < b"))
    # A cluster is known by its smallest cell, so that equal counts are settled the same way in every run.
    core = materialise(dense.join(found, "node"))
    names = core.groupBy("component").agg(F.min("cell").alias("first_cell"))
    core = core.join(names, "component")
    offers = around.join(core.select("node", "first_cell"), "node").select("cell", "first_cell", F.col("n").alias("__offer"))
    sparse = known.where(F.col("n") < min_samples).select("cell", "n")
    border = keep_first(sparse.join(offers, "cell"), ["cell"], [F.col("__offer").desc(), "first_cell"])
    members = materialise(core.select("cell", "n", "first_cell").unionByName(border.select("cell", "n", "first_cell")))
    sizes = members.groupBy("first_cell").agg(F.sum("n").alias("size")).where(F.col("size") >= min_cluster_size)
    largest_first = sizes.select("first_cell", (-F.col("size")).alias("__back"))
    numbered = with_row_id(largest_first, ["__back", "first_cell"])
    numbered = numbered.select("first_cell", F.col("source_row_id").cast("int").alias("topic_id"))
    return members.join(numbered, "first_cell").select("cell", "topic_id")


def density_topics(vectors: DataFrame, options: TopicOptions = TopicOptions()) -> DataFrame:
    """Adds ``topic_id`` (-1 for outliers) to (unit_id, embedding) rows.

    ``options.clustering`` is ``varying`` (clusters of any density, see ``varying.py``) or ``grid`` (touching cells of one
    width, which also come back as ``cell``); ``options.reduction`` is ``pca`` or ``neighbours`` (see ``spectral.py``).
    """
    # Fitting reads the vectors once more, so an embedding computed on the fly is written out first.
    vectors = written(vectors, "vectors")
    if options.reduction == "neighbours":
        from .spectral import neighbour_coordinates

        placed = neighbour_coordinates(vectors, options.components, options.n_neighbours)
        reduced = written(vectors.join(placed, "unit_id"), "reduced")
    elif options.reduction == "pca":
        reduced = reduce_dimensions(vectors, options.components)
    else:
        raise ValueError(f"unknown reduction: {options.reduction}")
    if options.clustering == "varying":
        from .varying import varying_topics  # it uses this module's components

        reduced = written(reduced, "reduced")
        found = varying_topics(reduced, "reduced", options.min_samples, options.min_cluster_size)
        return reduced.join(found, "unit_id").select(*vectors.columns, "reduced", "topic_id")
    if options.clustering != "grid":
        raise ValueError(f"unknown clustering: {options.clustering}")
    placed = reduced.withColumn("cell", grid_cell(F.col("reduced"), options.cell_width))
    found = assign_cells(placed, options.components, options.min_samples, options.min_cluster_size)
    return found.select(*vectors.columns, "reduced", "cell", "topic_id")


def assign_cells(placed: DataFrame, components: int, min_samples: int, min_cluster_size: int) -> DataFrame:
    """Rows with a ``cell`` -> the same rows with ``topic_id``; only counts of cells are kept in between."""
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    topics = cell_topics(cells, components, min_samples, min_cluster_size)
    return placed.join(topics, "cell", "left").withColumn("topic_id", F.coalesce("topic_id", F.lit(OUTLIER)))
