"""Merging of topics as a table: one tree of average linkage, of which every number of topics is a cut.

The similarity of two topics is the mean inner product of all pairs of their units (for vectors of length one the mean cosine),
which is the inner product of their centroids; that of a merged topic follows from the weighted mean centroid.  Merging never
brings two topics closer than their nearest parts were, so all pairs that are each other's nearest can be merged at once, and
only topics that are new or have lost their nearest look for it again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .density import connected_components

OUTLIER = -1
#: Decimals that similarities are compared with, numbers of a task's score matrix, and bytes of centroids that are sent at once.
DECIMALS, SCORES, BLOCK_BYTES = 12, 4_000_000, 64 << 20
MERGES = "round int, a int, b int, similarity double, n_units bigint"


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def nearest_topics(askers: DataFrame, live: DataFrame) -> DataFrame:
    """(topic_id, nearest, similarity) of ``askers`` among ``live`` (topic_id, vec): another topic, the smaller id if equal.

    Centroids go to the tasks as matrices, in blocks of a bounded size.
    """
    shape = live.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    parts = max(1, math.ceil(shape.n * (shape.width or 1) * 8 / BLOCK_BYTES))
    found = None
    for i in range(parts):
        block = live.where(F.pmod(F.xxhash64("topic_id"), F.lit(parts)) == i).select("topic_id", "vec").orderBy("topic_id").toArrow().combine_chunks()
        if not block.num_rows:
            continue
        ids, known = block["topic_id"].to_numpy(), _matrix(block["vec"].chunk(0), block.num_rows)

        def look(batches: Iterator[pa.RecordBatch], ids=ids, known=known) -> Iterator[pa.RecordBatch]:
            rows = max(1, SCORES // len(ids))
            for whole in batches:
                for begin in range(0, whole.num_rows, rows):
                    batch = whole.slice(begin, rows)
                    own = batch["topic_id"].to_numpy()
                    scores = np.round(_matrix(batch["vec"], len(own)) @ known.T, DECIMALS)
                    scores[own[:, None] == ids] = -np.inf
                    at = scores.argmax(axis=1)
                    best = scores[np.arange(len(own)), at]
                    some = pa.array(np.isfinite(best))
                    yield pa.RecordBatch.from_arrays([batch["topic_id"], pa.array(ids[at]), pa.array(best)], ["topic_id", "nearest", "similarity"]).filter(some)

        part = askers.select("topic_id", "vec").mapInArrow(look, "topic_id int, nearest int, similarity double")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("similarity", (-F.col("nearest")).alias("back"))).alias("best")
    return found.groupBy("topic_id").agg(best).select("topic_id", (-F.col("best.back")).alias("nearest"), F.col("best.similarity").alias("similarity"))


def topic_tree(centroids: DataFrame) -> DataFrame:
    """Written merges (round, a, b, similarity, n_units) of ``centroids`` (topic_id, centroid, n_units), outliers left out.

    Topic b goes into a, the smaller id, which then has ``n_units`` units.  Similarities never rise from a merge to those
    above it.  One topic or none: no merges.  Centroids that are not finite numbers are an error.
    """
    spark = centroids.sparkSession
    live = centroids.where(F.col("topic_id") != OUTLIER).select("topic_id", F.col("centroid").cast("array<double>").alias("vec"), F.col("n_units").cast("bigint").alias("n_units"))
    live = written(live.withColumn("ceiling", F.lit(float("inf"))), "topics")
    if not live.where(F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).isEmpty():
        raise ValueError("centroids hold values that are not finite numbers")
    merges, known, step, left = None, None, 0, live.count()
    while left > 1:
        askers = live if known is None else live.join(known.select("topic_id"), "topic_id", "left_anti")
        found = nearest_topics(askers, live)
        known = written(found if known is None else known.unionByName(found), "nearest")
        back = known.select(F.col("topic_id").alias("nearest"), F.col("nearest").alias("topic_id"))
        pairs = known.join(back, ["topic_id", "nearest"]).where("topic_id < nearest")
        pairs = written(pairs.select(F.col("topic_id").alias("a"), F.col("nearest").alias("b"), "similarity"), "pairs")
        into = F.coalesce("a", "topic_id")
        moved = live.join(pairs.select("a", F.col("b").alias("topic_id"), "similarity"), "topic_id", "left")
        weighted = array_to_vector(F.transform("vec", lambda x: x * F.col("n_units")))
        summed = moved.groupBy(into.alias("topic_id")).agg(Summarizer.sum(weighted).alias("s"), F.sum("n_units").alias("n_units"), F.min("ceiling").alias("ceiling"), F.max("similarity").alias("similarity"))
        vec = F.transform(vector_to_array("s"), lambda x: x / F.col("n_units"))
        # Rounding must not lift a merge above those below it.
        live = written(summed.select("topic_id", vec.alias("vec"), "n_units", F.least("ceiling", F.coalesce("similarity", "ceiling")).alias("ceiling")), "topics")
        made = pairs.select("a", "b").join(live.select(F.col("topic_id").alias("a"), "ceiling", "n_units"), "a")
        made = written(made.select(F.lit(step).alias("round"), "a", "b", F.col("ceiling").alias("similarity"), "n_units"), "merges")
        merges = made if merges is None else merges.unionByName(made)
        gone = pairs.select(F.explode(F.array("a", "b")).alias("gone"))
        stays = known.join(gone.select(F.col("gone").alias("topic_id")), "topic_id", "left_anti")
        known = written(stays.join(gone.select(F.col("gone").alias("nearest")), "nearest", "left_anti").select("topic_id", "nearest", "similarity"), "known")
        before, left = left, live.count()
        if left >= before:
            raise RuntimeError("merging topics made no progress")
        step += 1
    return written(merges.coalesce(1), "topic_tree") if merges is not None else spark.createDataFrame([], MERGES)


def cut_tree(tree: DataFrame, topics: DataFrame, nr_topics: int) -> DataFrame:
    """(topic_id, merged_topic) of ``topics`` (topic_id): the tree's most similar merges until ``nr_topics`` are left; -1 stays."""
    if nr_topics < 1:
        raise ValueError("nr_topics must be at least 1")
    named = topics.select("topic_id").distinct()
    real = written(named.where(F.col("topic_id") != OUTLIER), "named")
    taken = max(0, real.count() - nr_topics)
    edges = tree.orderBy(F.desc("similarity"), "round", "a", "b").limit(taken).select("a", "b")
    found = written(connected_components(real.select(F.col("topic_id").alias("node")), edges), "cut")
    names = found.groupBy("component").agg(F.min("node").alias("merged_topic"))
    merged = found.join(names, "component").select(F.col("node").alias("topic_id"), "merged_topic")
    return merged.unionByName(named.where(F.col("topic_id") == OUTLIER).select("topic_id", F.col("topic_id").alias("merged_topic")))


def reduce_topics(centroids: DataFrame, nr_topics: int) -> DataFrame:
    """(topic_id, merged_topic): the cut of the topics' tree that leaves ``nr_topics`` (all, if there are fewer)."""
    if nr_topics < 1:
        raise ValueError("nr_topics must be at least 1")
    return cut_tree(topic_tree(centroids), centroids, nr_topics)
