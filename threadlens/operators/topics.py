"""Topic assignment: priority labels, centroids, outlier reassignment."""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.flags import priority_label
from ..functions.text import ngrams
from ..functions.vectors import TINY, to_matrix
from ..session import materialise, written
from .ingest import with_row_id
from .messages import keep_first

OUTLIER = -1


# --- label backend ---------------------------------------------------------------


def label_topics(labelled: DataFrame) -> DataFrame:
    """(label, topic_id): 0-based rank of each label that occurs, in code-point order.

    Labels come from the flag registry, so there are never more of them than
    registered flags plus the default.
    """
    present = labelled.select("label").distinct()
    return present.select("label", (F.row_number().over(Window.orderBy("label")) - 1).alias("topic_id"))


def simple_topics(
    units: DataFrame, labels: Mapping[str, str] = fixed.FLAG_LABELS, default: str = fixed.DEFAULT_LABEL
) -> DataFrame:
    """Units with ``label`` and ``topic_id`` from the first matching flag."""
    labelled = units.withColumn("label", priority_label(units.columns, labels, default))
    return labelled.join(F.broadcast(label_topics(labelled)), "label")


def with_topics(units: DataFrame, assignments: DataFrame) -> DataFrame:
    """Units joined to their topic; units without one are dropped."""
    return units.join(assignments.select("unit_id", "topic_id"), "unit_id")


# --- centroids --------------------------------------------------------------------


def topic_centroids(vectors: DataFrame) -> DataFrame:
    """(topic_id, centroid, n_units): element-wise mean per topic, combined before the shuffle."""
    return vectors.groupBy("topic_id").agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))).alias("centroid"),
        F.count(F.lit(1)).alias("n_units"),
    )


def centroid_bytes(centroids: DataFrame) -> int:
    shape = centroids.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("centroid")).alias("width")).first()
    return (shape.n or 0) * (shape.width or 0) * 8


#: Numbers that a task's score matrix holds at most, and decimals that similarities are compared with.
SCORES, DECIMALS = 4_000_000, 12


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), TINY)


def best_of(values: np.ndarray, banned: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Highest rounded cosine and its place among the unit vectors for each row; -inf where none is allowed."""
    top, choice = np.full(len(values), -np.inf), np.zeros(len(values), np.int64)
    rows = max(1, SCORES // max(len(ids), 1))
    for begin in range(0, len(values) if len(ids) else 0, rows):
        part = slice(begin, begin + rows)
        scores = np.round(unit_rows(values[part]) @ unit.T, DECIMALS)
        scores[banned[part, None] == ids[None, :]] = -np.inf
        choice[part] = scores.argmax(axis=1)
        top[part] = scores[np.arange(len(scores)), choice[part]]
    return top, choice


def _best_topic(model: Broadcast):
    """Arrow function (embedding, banned topic) -> best (similarity, topic) over the broadcast blocks of centroids."""

    @F.pandas_udf("similarity double, topic int")
    def best(embedding: pd.Series, banned: pd.Series) -> pd.DataFrame:
        ids, unit = model.value
        top, choice = best_of(to_matrix(embedding).astype(np.float64), banned.to_numpy(), ids, unit)
        found = np.isfinite(top)
        topics = [int(ids[c]) if ok else None for c, ok in zip(choice, found)]
        return pd.DataFrame({"similarity": np.where(found, top, np.nan), "topic": pd.array(topics, dtype="Int32")})

    return best.asNondeterministic()


def _block(part: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Topic ids in order and their centroids as unit rows; raises on centroids that are not numbers."""
    table = part.select("topic_id", F.col("centroid").cast("array<double>").alias("centroid")).orderBy("topic_id").toArrow()
    matrix = table["centroid"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 1))
    if not np.isfinite(matrix).all():
        raise ValueError("centroids hold values that are not finite numbers")
    return table["topic_id"].to_numpy(), unit_rows(matrix)


def nearest_centroid(
    vectors: DataFrame, centroids: DataFrame, exclude: str | None = None, block_bytes: int = 256 << 20
) -> DataFrame:
    """Adds ``nearest_topic`` and ``similarity``: the centroid with the highest cosine.

    Centroids are shipped to the tasks as a matrix.  Their size is checked first:
    what exceeds ``block_bytes`` is shipped in blocks, one pass each, keeping the
    best so far; the result is the same.  Equal similarity: lowest topic id.
    ``exclude`` names a column with one topic id a row may not choose.
    """
    spark = vectors.sparkSession
    centroids = materialise(centroids)
    blocks = max(1, math.ceil(centroid_bytes(centroids) / block_bytes))
    result = vectors.withColumns(
        {"similarity": F.lit(None).cast("double"), "nearest_topic": F.lit(None).cast("int")}
    )
    for block in range(blocks):
        part = centroids.where(F.pmod(F.xxhash64("topic_id"), F.lit(blocks)) == block)
        ids, unit = _block(part)
        if not len(ids):
            continue
        model = spark.sparkContext.broadcast((ids, unit))
        best = _best_topic(model)
        banned = F.col(exclude) if exclude else F.lit(OUTLIER - 1)
        challenger = result.withColumn("__best", best("embedding", banned))
        better = F.col("__best.topic").isNotNull() & (
            F.col("similarity").isNull()
            | (F.col("__best.similarity") > F.col("similarity"))
            | ((F.col("__best.similarity") == F.col("similarity")) & (F.col("__best.topic") < F.col("nearest_topic")))
        )
        result = challenger.withColumns(
            {
                "similarity": F.when(better, F.col("__best.similarity")).otherwise(F.col("similarity")),
                "nearest_topic": F.when(better, F.col("__best.topic")).otherwise(F.col("nearest_topic")),
            }
        ).drop("__best")
        if blocks > 1:
            result = materialise(result)
            model.destroy()
    return result


def reassign_outliers(vectors: DataFrame, centroids: DataFrame | None = None) -> DataFrame:
    """(unit_id, topic_id) with every -1 moved to the topic of the nearest centroid."""
    real = vectors.where(F.col("topic_id") != OUTLIER)
    centroids = topic_centroids(real) if centroids is None else centroids
    moved = nearest_centroid(vectors.where(F.col("topic_id") == OUTLIER), centroids)
    return real.select("unit_id", "topic_id").unionByName(
        moved.select("unit_id", F.coalesce("nearest_topic", F.lit(OUTLIER)).alias("topic_id"))
    )


#: Scores are compared with bounds up to this relative error, and with each other up to so many decimals.
ROUNDING, SCORE_DECIMALS = 1e-9, 9


def term_winners(counts: DataFrame, postings: DataFrame, head: int = 8) -> DataFrame:
    """(unit_id, topic_id): the topic of the highest score, the sum of a unit's (unit_id, term, n) times (term, topic_id, impact).

    Equal scores: lowest topic id; a unit without a known term has no row.  A unit first meets the ``head`` topics of each of its terms
    that the term counts most for.  The next impact of each term bounds what all others can have; a unit is settled when
    no topic that it has not met can win, and only topics that still can are scored in full.  Units that are
    not settled look four times as far, so a term that is in all topics costs ``head`` rows a unit and not one for every topic.
    """
    by_impact = Window.partitionBy("term").orderBy(F.col("impact").desc(), "topic_id")
    ranked = written(postings.withColumn("place", F.row_number().over(by_impact)), "postings")
    deepest = ranked.agg(F.max("place")).first()[0] or 0
    left, found = written(counts.join(ranked.select("term").distinct(), "term", "left_semi"), "terms"), None
    while True:
        lists = ranked.where(F.col("place") <= head + 1).groupBy("term").agg(F.sort_array(F.collect_list(F.struct("place", "topic_id", "impact"))).alias("list"))
        lists = lists.select("term", F.slice("list", 1, head).alias("first"), F.coalesce(F.try_element_at("list", F.lit(head + 1))["impact"], F.lit(0.0)).alias("next"))
        met = left.join(lists, "term").select("unit_id", "n", "first", (F.col("n") * F.col("next")).alias("open"))
        unmet = met.groupBy("unit_id").agg(F.sum("open").alias("unmet"))
        seen = met.select("unit_id", "n", "open", F.explode("first").alias("f")).groupBy("unit_id", "f.topic_id")
        seen = seen.agg(F.sum(F.col("n") * F.col("f.impact")).alias("low"), F.sum("open").alias("own")).join(unmet, "unit_id")
        seen = written(seen.withColumn("high", F.col("low") + F.col("unmet") - F.col("own")), "seen")
        best = seen.groupBy("unit_id").agg(F.max("low").alias("best"))
        still = seen.join(best, "unit_id").where(F.col("high") * (1 + ROUNDING) + ROUNDING >= F.col("best"))
        settled = still if head >= deepest else still.where(F.col("unmet") < F.col("best") * (1 - ROUNDING) - ROUNDING)
        settled = written(settled.select("unit_id", "topic_id"), "candidates")
        scores = settled.join(left, "unit_id").join(ranked.select("term", "topic_id", "impact"), ["term", "topic_id"])
        scores = scores.groupBy("unit_id", "topic_id").agg(F.round(F.sum(F.col("n") * F.col("impact")), SCORE_DECIMALS).alias("score"))
        winners = keep_first(scores, ["unit_id"], [F.col("score").desc(), "topic_id"]).select("unit_id", "topic_id")
        found = winners if found is None else found.unionByName(winners)
        if head >= deepest:
            return found
        left = written(left.join(settled.select("unit_id").distinct(), "unit_id", "left_anti"), "terms")
        if left.isEmpty():
            return found
        head *= 4


def reassign_outliers_by_terms(
    units: DataFrame, weights: DataFrame, text: str, ngram_min: int = 1, ngram_max: int = 1, head: int = 8
) -> DataFrame:
    """(unit_id, topic_id) with every -1 moved to the topic whose weighted terms fit its text best.

    A unit's term counts are weighted like the topics' terms; the score is the
    cosine over shared terms.  A unit that shares no term stays an outlier.
    """
    topics = weights.where(F.col("topic_id") != OUTLIER)
    norms = topics.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("__norm"))
    impact = F.col("weight") / F.col("tf") * F.col("weight") / F.greatest("__norm", F.lit(TINY))
    postings = topics.join(norms, "topic_id").select("term", "topic_id", impact.alias("impact"))
    lost = units.where(F.col("topic_id") == OUTLIER)
    grams = lost.select("unit_id", F.explode(ngrams(F.col(text), ngram_min, ngram_max)).alias("term"))
    counts = grams.groupBy("unit_id", "term").agg(F.count(F.lit(1)).alias("n"))
    stay = lost.select("unit_id").join(term_winners(counts, postings, head), "unit_id", "left")
    return (
        units.where(F.col("topic_id") != OUTLIER)
        .select("unit_id", "topic_id")
        .unionByName(stay.select("unit_id", F.coalesce("topic_id", F.lit(OUTLIER)).alias("topic_id")))
    )


def rank_topics(assignments: DataFrame) -> DataFrame:
    """Renumber topics 0, 1, ... from the largest to the smallest; -1 stays."""
    sizes = assignments.where(F.col("topic_id") != OUTLIER).groupBy("topic_id").count()
    largest_first = sizes.select("topic_id", (-F.col("count")).alias("__back"))
    ranks = with_row_id(largest_first, ["__back", "topic_id"]).select("topic_id", F.col("source_row_id").alias("__rank"))
    return assignments.join(ranks, "topic_id", "left").select(
        "unit_id", F.coalesce("__rank", F.lit(OUTLIER)).cast("int").alias("topic_id")
    )
