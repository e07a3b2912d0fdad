"""Report tables and the text report.  Everything here works on one row per topic."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import display_title
from ..options import ReportOptions
from .enrich import no_enrichment
from .metrics import growth_scores


def final_summary(summary: DataFrame, enrichment: DataFrame | None = None) -> DataFrame:
    """Summary with enrichment; the published title falls back to the automatic one."""
    enriched = summary.join(no_enrichment(summary) if enrichment is None else enrichment, "topic_id", "left")
    title = F.coalesce("topic_title", "topic_title_auto")
    return (
        enriched.withColumn("topic_title_llm", title)
        .drop("topic_title")
        .orderBy(F.col("n_units").desc(), "topic_id")
    )


def published_examples(examples: DataFrame) -> DataFrame:
    return examples.select("topic_id", "chat_uuid", "user", F.col("timestamp").cast("string").alias("timestamp"), "text")


def totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.coalesce(F.sum("n_units"), F.lit(0)).alias("n_units"), F.count_distinct("topic_id").alias("n_topics")
    )


def top_by(summary: DataFrame, column: str, n: int) -> DataFrame:
    """First ``n`` topics by a column; ties by size, then topic id."""
    order = {column: F.col(column).desc(), "n_units": F.col("n_units").desc()}
    return summary.orderBy(*order.values(), "topic_id").limit(n)


def fastest_growing(summary: DataFrame, trends: DataFrame, n: int, periods: int = 4) -> DataFrame:
    """The first ``n`` growth scores; a score whose topic has no summary row is skipped."""
    top = growth_scores(trends, periods).limit(n)
    return top.join(summary, "topic_id").orderBy(F.col("growth_score").desc(), "topic_id")


def domain_highlights(summary: DataFrame, domains: Mapping[str, str] = fixed.REPORT_DOMAINS) -> DataFrame:
    """The topic with the highest share of each listed domain, where that share is above zero."""
    present = [(share, label) for share, label in domains.items() if share in summary.columns]
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("domain_no"), F.lit(label).alias("domain"), F.col(share).alias("share"))
            for i, (share, label) in enumerate(present)
        ]
    )
    long = summary.select("*", F.inline(entries))
    best = Window.partitionBy("domain_no").orderBy(F.col("share").desc(), F.col("n_units").desc(), "topic_id")
    return long.withColumn("__rank", F.row_number().over(best)).where("__rank = 1 AND share > 0").drop("__rank")


def product_hypotheses(summary: DataFrame, n: int) -> DataFrame:
    return top_by(summary.where(F.col("suspected_product_action").isNotNull()), "n_units", n)


def figure_sizes(summary: DataFrame, n: int = 15) -> DataFrame:
    """Data of the topic size chart."""
    return top_by(summary, "n_units", n).select("topic_id", "n_units")


# --- text report --------------------------------------------------------------------


def percent(share: Column) -> Column:
    return F.format_string("%.2f%%", F.bround(share * 100, 2))


def _title() -> Column:
    return display_title(F.col("topic_title_llm"), F.col("topic_title_auto"), F.col("topic_id"))


def _lines(frame: DataFrame, section: int, line: Column, *order: Column | str) -> DataFrame:
    """(section, rank, line) of an already small, ordered table."""
    ranked = frame.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.select(F.lit(section).alias("section"), "rank", line.alias("line"))


def report_lines(
    summary: DataFrame,
    trends: DataFrame,
    examples: DataFrame,
    quality: DataFrame | None = None,
    options: ReportOptions = ReportOptions(),
) -> DataFrame:
    """(section, rank, line) of the whole report; ``summary`` is the final summary.

    ``examples`` needs its ``example_rank``.  Without ``quality`` the counters are left out.
    """
    spark, n = summary.sparkSession, options.top_n_topics
    topic = F.concat(F.lit("- Topic "), F.col("topic_id").cast("string"), F.lit(": "))
    size, tid = F.col("n_units").desc(), F.col("topic_id")

    heads = [(0, -2, fixed.REPORT_TITLE)]
    for number, name in enumerate(fixed.REPORT_SECTIONS):
        heads += [(number, -1, ""), (number, 0, f"## {name}"), (number, 0, "")]
    parts = [
        spark.createDataFrame(
            [(s, r * 1000 + i, text) for i, (s, r, text) in enumerate(heads)], "section int, rank int, line string"
        )
    ]
    if quality is not None:
        counters = F.array(
            *[
                F.concat(F.lit(f"- {label}: "), F.coalesce(F.col(name).cast("string"), F.lit("n/a")))
                if name in quality.columns
                else F.lit(f"- {label}: n/a")
                for name, label in fixed.REPORT_COUNTERS.items()
            ]
        )
        parts.append(
            quality.select(F.posexplode(counters).alias("__p", "line")).select(
                F.lit(0).alias("section"), (F.col("__p") + 100).alias("rank"), "line"
            )
        )
    result = F.array(
        F.concat(F.lit("- Analysis units: "), F.col("n_units").cast("string")),
        F.concat(F.lit("- Topics: "), F.col("n_topics").cast("string")),
    )
    parts.append(
        totals(summary).select(F.posexplode(result).alias("__p", "line")).select(
            F.lit(1).alias("section"), (F.col("__p") + 100).alias("rank"), "line"
        )
    )
    shown = {
        2: (
            top_by(summary, "n_units", n),
            F.concat(
                topic, _title(),
                F.format_string(" (units=%d, users=%d, keywords=%s)", "n_units", "n_users", "topic_keywords"),
            ),
            (size, tid),
        ),
        3: (
            top_by(summary, "n_users", n),
            F.concat(topic, _title(), F.format_string(" (users=%d, units=%d)", "n_users", "n_units")),
            (F.col("n_users").desc(), size, tid),
        ),
        4: (
            fastest_growing(summary, trends, n, options.growth_periods),
            F.concat(topic, _title(), F.format_string(" (growth_score=%.2f)", F.bround("growth_score", 2))),
            (F.col("growth_score").desc(), tid),
        ),
        5: (
            top_by(summary, "has_error_terms_share", n),
            F.concat(topic, _title(), F.lit(" (error_share="), percent(F.col("has_error_terms_share")), F.lit(")")),
            (F.col("has_error_terms_share").desc(), size, tid),
        ),
        6: (
            domain_highlights(summary),
            F.concat(
                F.lit("- "), F.col("domain"), F.lit(": topic "), tid.cast("string"), F.lit(" ("), _title(),
                F.lit(") with share "), percent(F.col("share")),
            ),
            (F.col("domain_no"),),
        ),
        7: (
            product_hypotheses(summary, n),
            F.concat(
                topic, F.col("suspected_product_action"), F.lit(" (JTBD: "),
                F.coalesce("suspected_jtbd", F.lit("None")), F.lit(")"),
            ),
            (size, tid),
        ),
        8: (
            examples.orderBy("topic_id", "example_rank").limit(options.top_n_examples),
            F.concat(
                F.lit("- Topic "), tid.cast("string"), F.lit(" | "), F.col("user"), F.lit(" | "),
                F.col("timestamp"), F.lit(": "), F.col("text"),
            ),
            (tid, F.col("example_rank")),
        ),
    }
    for section, (frame, line, order) in shown.items():
        body = _lines(frame, section, line, *order)
        parts.append(body.withColumn("rank", F.col("rank") + 99))
    return reduce(DataFrame.unionByName, parts).orderBy("section", "rank")
