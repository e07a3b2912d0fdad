"""Topic metrics: summary, shares, trends, growth, representative examples."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.vectors import cosine_arrow
from ..session import materialise
from .topics import centroid_bytes, topic_centroids

BROADCAST_BYTES = 128 << 20


def topic_aggregates(units: DataFrame, shares: Mapping[str, str] = fixed.FLAG_SHARES) -> DataFrame:
    """Counts, distinct users and chats, mean length and flag shares per topic.

    Counts are first combined per (topic, user, chat): the two distinct counts
    then multiply only those few rows, and a topic holding a large part of the
    data is spread over its users and chats.  A null topic forms its own group;
    a flag the table lacks has share 0.
    """
    present = [flag for flag in shares if flag in units.columns]
    pairs = units.groupBy("topic_id", "user", "chat_uuid").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("text_len_chars").alias("chars"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in present],
    )
    n = F.sum("n")
    rates = [
        (F.sum(flag) / n).alias(share) if flag in present else F.lit(0.0).alias(share)
        for flag, share in shares.items()
    ]
    return pairs.groupBy("topic_id").agg(
        n.alias("n_units"),
        F.count_distinct("user").alias("n_users"),
        F.count_distinct("chat_uuid").alias("n_chats"),
        (F.sum("chars") / n).alias("avg_len_chars"),
        *rates,
    )


def topic_summary(
    units: DataFrame, titles: DataFrame | None = None, shares: Mapping[str, str] = fixed.FLAG_SHARES
) -> DataFrame:
    """One row per topic, largest first.  ``titles`` is (topic_id, keywords, title)."""
    return summarise(topic_aggregates(units, shares), titles, shares)


def summarise(
    aggregates: DataFrame, titles: DataFrame | None = None, shares: Mapping[str, str] = fixed.FLAG_SHARES
) -> DataFrame:
    # Topic grain from here on.  The total is one number, so no task has to hold all topics.
    aggregates = materialise(aggregates)
    total = max(aggregates.agg(F.sum("n_units")).first()[0] or 0, 1)
    result = aggregates.withColumn("share_of_total", F.col("n_units") / F.lit(total))
    fallback = F.concat(F.lit("topic_"), F.col("topic_id").cast("string"))
    if titles is None:
        result = result.withColumns({"topic_title_auto": fallback, "topic_keywords": F.lit("")})
    else:
        result = result.join(titles, "topic_id", "left").withColumns(
            {
                "topic_title_auto": F.coalesce("title", fallback),
                "topic_keywords": F.coalesce(F.array_join("keywords", ", "), F.lit("")),
            }
        )
    return result.select(
        "topic_id", "topic_title_auto", "topic_keywords", "n_units", "n_users", "n_chats", "share_of_total",
        "avg_len_chars", *shares.values(),
    ).orderBy(F.col("n_units").desc(), "topic_id")


def domain_breakdown(summary: DataFrame, shares: Mapping[str, str] = fixed.FLAG_SHARES) -> DataFrame:
    """The flag shares alone, by topic id; a projection of the summary."""
    return summary.select("topic_id", *shares.values()).orderBy("topic_id")


def topic_trends(units: DataFrame) -> DataFrame:
    """Units per week and topic; ties in a week go by topic id."""
    counts = units.groupBy("week", "topic_id").agg(F.count(F.lit(1)).alias("n_units"))
    return counts.orderBy("week", F.col("n_units").desc(), "topic_id")


def last_periods(trends: DataFrame, periods: int = 4) -> DataFrame:
    """The last ``periods`` weeks in which a topic occurred."""
    latest = Window.partitionBy("topic_id").orderBy(F.col("week").desc())
    return trends.withColumn("__rank", F.row_number().over(latest)).where(F.col("__rank") <= periods).drop("__rank")


def growth_scores(trends: DataFrame, periods: int = 4) -> DataFrame:
    """Mean change from one observed week to the next; 0 with fewer than two weeks.

    The mean of consecutive differences is (last - first) / (weeks - 1).
    """
    weeks = F.count(F.lit(1))
    change = F.max_by("n_units", "week") - F.min_by("n_units", "week")
    scored = last_periods(trends, periods).groupBy("topic_id").agg(
        F.when(weeks > 1, change / (weeks - 1)).otherwise(F.lit(0.0)).alias("growth_score")
    )
    return scored.orderBy(F.col("growth_score").desc(), "topic_id")


def centroid_similarity(vectors: DataFrame, centroids: DataFrame | None = None) -> DataFrame:
    """Adds each vector's ``similarity`` to the centroid of its own topic.

    The centroids are written out and measured: small enough they go to every
    task and the vectors stay where they are; otherwise both sides are shuffled
    and adaptive execution splits the large topics.
    """
    centroids = materialise(topic_centroids(vectors) if centroids is None else centroids.select("topic_id", "centroid"))
    side = centroids.select("topic_id", "centroid")
    if centroid_bytes(centroids) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    joined = vectors.join(side, "topic_id")
    return joined.withColumn("similarity", cosine_arrow(F.col("embedding"), F.col("centroid"))).drop("centroid")


def rank_examples(vectors: DataFrame, top_n: int, centroids: DataFrame | None = None) -> DataFrame:
    """(topic_id, unit_id, similarity, example_rank): the units nearest to their topic's centroid."""
    scored = centroid_similarity(vectors, centroids).select("topic_id", "unit_id", "similarity")
    nearest = Window.partitionBy("topic_id").orderBy(F.col("similarity").desc(), "unit_id")
    return scored.withColumn("example_rank", F.row_number().over(nearest)).where(F.col("example_rank") <= top_n)


def representative_examples(
    units: DataFrame, vectors: DataFrame, top_n: int = 12, centroids: DataFrame | None = None
) -> DataFrame:
    """Example units per topic, best first.  ``vectors`` is (topic_id, unit_id, embedding).

    Ranking moves ids and vectors only; the texts are fetched for the winners.
    """
    ranked = rank_examples(vectors, top_n, centroids).select("topic_id", "unit_id", "example_rank")
    text = units.select("unit_id", "chat_uuid", "user", F.col("timestamp").cast("string").alias("timestamp"), "text")
    return ranked.join(text, "unit_id").select(
        "topic_id", "unit_id", "chat_uuid", "user", "timestamp", "text", "example_rank"
    ).orderBy("topic_id", "example_rank")


def topic_count(units: DataFrame) -> DataFrame:
    return units.agg(F.count_distinct("topic_id").alias("n_topics"))
