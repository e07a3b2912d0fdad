"""Terms of topics: keyword counts and class-based TF-IDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import auto_title, keyword_tokens, words
from ..session import written

# Room for token positions below a unit's order number in one decimal key.
POSITIONS = 10**9


def ranked_lists(ranked: DataFrame, value: str, name: str) -> DataFrame:
    """Rows already cut to top-n per topic -> one ordered array per topic."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", value)))
    return ranked.groupBy("topic_id").agg(pairs.alias("__pairs")).select("topic_id", F.col(f"__pairs.{value}").alias(name))


def keyword_counts(units: DataFrame, text: str, order: Column) -> DataFrame:
    """Occurrences of every (topic, keyword) and where it was first seen.

    ``order`` is the BIGINT order number of a unit.  It shares one decimal with
    the token position, which keeps the aggregation a hash aggregation with
    map-side combining (a struct would force a sort of all tokens).
    """
    tokens = units.select("topic_id", order.alias("__order"), F.posexplode(keyword_tokens(F.col(text))).alias("__pos", "keyword"))
    seen = F.col("__order").cast("decimal(19,0)") * F.lit(POSITIONS).cast("decimal(10,0)") + F.col("__pos")
    return tokens.groupBy("topic_id", "keyword").agg(
        F.count(F.lit(1)).alias("n"), F.min(seen.cast("decimal(38,0)")).alias("first_seen")
    )


def top_keywords(units: DataFrame, top_n: int = 10, text: str = "modeling_text", order: Column | None = None) -> DataFrame:
    """(topic_id, keyword, n, rank): most frequent keywords; ties go to the one seen first."""
    order = F.col("source_row_ids")[0] if order is None else order
    by_count = Window.partitionBy("topic_id").orderBy(F.col("n").desc(), "first_seen")
    counts = keyword_counts(units, text, order)
    return counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= top_n).drop("first_seen")


def topic_keywords(ranked: DataFrame) -> DataFrame:
    """(topic_id, keywords array) from ranked keywords or terms."""
    return ranked_lists(ranked, "keyword" if "keyword" in ranked.columns else "term", "keywords")


def topic_titles(topics: DataFrame, keywords: DataFrame, fallback: Column) -> DataFrame:
    """(topic_id, keywords, title); topic -1 is titled ``outliers``."""
    empty = F.array().cast("array<string>")
    joined = topics.join(keywords, "topic_id", "left").withColumn("keywords", F.coalesce("keywords", empty))
    title = F.when(F.col("topic_id") == -1, F.lit("outliers")).otherwise(auto_title(F.col("keywords"), fallback))
    return joined.select("topic_id", "keywords", title.alias("title"))


# --- class-based TF-IDF -------------------------------------------------------


def topics_needed(min_df: int | float, n_units: int, n_topics: int) -> Column:
    """The number of topics that a term must be in, for a threshold that was given for units.

    A topic is the text of many units, so the request is carried over in proportion: as the same part of all topics.  That
    part is one unit's at least and all at most.  A count below two asks for any topic.
    """
    if isinstance(min_df, int) and min_df < 2:
        return F.lit(1.0)
    one = 1.0 / max(n_units, 1)
    part = F.lit(min_df if isinstance(min_df, float) else min_df * one)
    return F.least(F.greatest(part, F.lit(one)), F.lit(1.0)) * F.lit(n_topics)


def term_counts(units: DataFrame, text: str, ngram_min: int = 1, ngram_max: int = 1) -> DataFrame:
    """(topic_id, term, tf): n-gram counts per topic, combined before the shuffle.

    Only the longest n-grams are counted over the text, one for each word (shorter at the end of a text); the count of a shorter
    n-gram is the sum over those that begin with it.  Terms are joined once for each distinct n-gram.
    """
    # An outer explode keeps the optimiser from cutting each text into words a second time in a filter on their number.
    found = units.select("topic_id", words(F.col(text)).alias("__words"))
    found = found.select("topic_id", "__words", F.posexplode_outer("__words").alias("__pos", "__0")).where("__0 IS NOT NULL")
    names = [f"__{i}" for i in range(max(ngram_max, 1))]
    following = [F.get("__words", F.col("__pos") + i).alias(name) for i, name in enumerate(names) if i]
    longest = found.select("topic_id", "__0", *following).groupBy("topic_id", *names).agg(F.count(F.lit(1)).alias("tf"))
    parts = []
    for n in range(ngram_min, ngram_max + 1):
        # A condition with the count stays above the counting, so that all lengths read one exchange.
        of_length = longest.where(F.when(F.col("tf") > 0, F.col(names[n - 1]).isNotNull()))
        if n < ngram_max:
            of_length = of_length.groupBy("topic_id", *names[:n]).agg(F.sum("tf").alias("tf"))
        parts.append(of_length.select("topic_id", F.concat_ws(" ", *names[:n]).alias("term"), "tf"))
    return reduce(DataFrame.unionByName, parts)


def term_weights(counts: DataFrame, min_df: int | float, n_units: int) -> DataFrame:
    """(topic_id, term, tf, weight) with weight = tf * ln(1 + A / f).

    f is the term's count over all topics and A the mean number of terms per
    topic, both over the terms that reach the threshold.  If no term reaches it,
    the threshold falls back to one topic.  The (topic, term) counts are written
    out once because two small scalars have to be known before weighting.
    """
    counts = written(counts, "term_counts")
    n_topics = counts.select("topic_id").distinct().count()
    per_term = written(counts.groupBy("term").agg(F.sum("tf").alias("__f"), F.count(F.lit(1)).alias("__df")), "terms")
    common = per_term.where(F.col("__df") >= topics_needed(min_df, n_units, n_topics))
    size = common.agg(F.sum("__f")).first()[0]
    if size is None and n_topics:
        common = per_term
        size = common.agg(F.sum("__f")).first()[0]
    kept = counts.join(common.drop("__df"), "term")
    mean = int((size or 0) / max(n_topics, 1))
    weight = F.col("tf") * F.log(F.lit(1.0) + F.lit(float(mean)) / F.col("__f"))
    return kept.select("topic_id", "term", "tf", weight.alias("weight"))


def top_terms(weights: DataFrame, top_n: int = 10) -> DataFrame:
    """(topic_id, term, tf, weight, rank); equal weights are ordered by term."""
    by_weight = Window.partitionBy("topic_id").orderBy(F.col("weight").desc(), "term")
    return weights.withColumn("rank", F.row_number().over(by_weight)).where(F.col("rank") <= top_n)
