"""The whole run: each stage is written and the next one reads it back.

Stages can be run one by one from the written tables; a lost executor or a
restarted driver costs at most the stage in progress.  A resumed run skips
stages whose input and options are those of their last finished run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.flags import check_registry
from ..functions.vectors import HashProvider
from ..operators import dendrogram, density, embed, enrich, ingest, messages, metrics, report, terms, topics, units
from ..options import (
    EmbeddingOptions,
    EnrichmentOptions,
    MessageOptions,
    ReportOptions,
    TopicOptions,
    UnitOptions,
)
from ..sources.tables import write_report, write_table


STARTED, FINISHED = "0 started", "1 finished"


def table_fingerprint(df: DataFrame) -> str:
    """Row count and sum of row hashes: the same for any order and partitions of the rows."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row = df.select(F.xxhash64(*columns).cast("decimal(38,0)").alias("h")).agg(F.count("h").alias("n"), F.sum("h").alias("h")).first()
    return f"{sorted(df.dtypes)} {row.n} {row.h}"


@dataclass(frozen=True)
class TopicRun:
    """Parameters and providers of a run; ``folder`` is a path all machines share."""

    spark: SparkSession
    folder: str
    messages: MessageOptions = field(default_factory=MessageOptions)
    units: UnitOptions = field(default_factory=UnitOptions)
    embeddings: EmbeddingOptions = field(default_factory=EmbeddingOptions)
    topics: TopicOptions = field(default_factory=TopicOptions)
    enrichment: EnrichmentOptions = field(default_factory=EnrichmentOptions)
    report: ReportOptions = field(default_factory=ReportOptions)
    embed_factory: embed.ProviderFactory = HashProvider
    enrich_factory: enrich.EnrichFactory | None = None

    # --- tables -----------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _store(self, stage: str, name: str, df: DataFrame) -> DataFrame:
        """Write a stage table, counting its rows on the way, and append to the run log."""
        seen = Observation()
        write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), self.path(name))
        self._log(stage, {name: int(seen.get["rows"])})
        return self.read(name)

    def _log(self, stage: str, numbers: Mapping[str, int]) -> None:
        """Row counts of tables and other numbers of a stage."""
        entries = [(stage, name, value) for name, value in numbers.items()]
        log = self.spark.createDataFrame(entries, "stage string, table string, rows bigint")
        log.withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(self.path("run_log"))

    # --- finished stages --------------------------------------------------------

    def _finished(self) -> dict[str, str]:
        """Key of each stage's last run, if it was finished; a started one takes its stage's place."""
        log = embed.read_or_empty(self.spark, self.path("manifest"), "stage string, key string, state string, at timestamp")
        last = log.groupBy("stage").agg(F.max_by(F.struct("key", "state"), F.struct("at", "state")).alias("last"))
        return {r.stage: r.last.key for r in last.collect() if r.last.state == FINISHED}

    def _mark(self, stage: str, key: str, state: str) -> None:
        row = self.spark.createDataFrame([(stage, key, state)], "stage string, key string, state string")
        row.withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.path("manifest"))

    # --- stages -----------------------------------------------------------------

    def ingest(
        self, raw: DataFrame, mapping: Mapping[str, str] = fixed.EXPORT_HEADER, on_error: str = "raise", **options
    ) -> DataFrame:
        rows = ingest.canonical_rows(raw, mapping, **options)
        if on_error == "quarantine":
            self._store("ingest", "ingest_rejects", ingest.rejects(rows))
        canonical = self._store("ingest", "raw_normalized", ingest.validate(rows, on_error))
        write_table(ingest.quality_report(canonical), self.path("ingest_quality"), "json", single_file=True)
        return canonical

    def preprocess(self) -> DataFrame:
        check_registry(self.messages.flags, fixed.FLAG_SHARES)
        cleaned = messages.user_messages(self.read("raw_normalized"), self.messages)
        return self._store("preprocess", "user_messages", cleaned)

    def build_units(self) -> DataFrame:
        source = self.read("user_messages")
        built = self._store("units", "units", units.units_from_messages(source, self.units, tuple(self.messages.flags)))
        self._store("units", "unit_message_map", units.unit_message_map(built))
        return built

    def embed(self) -> DataFrame:
        vectors = embed.cached_embeddings(
            self.read("units"), self.path("embedding_cache"), self.embed_factory, self.embeddings
        )
        stored = self._store("embed", "embeddings", vectors)
        texts = embed.preparation_counters(self.read("units"), self.embeddings).first()
        width = stored.select(F.size("embedding").alias("width")).first()
        self._log(
            "embed",
            {"sanitized_texts": texts.sanitized, "truncated_texts": texts.truncated, "vector_width": width.width if width else 0},
        )
        return stored

    def assign_topics(self) -> DataFrame:
        built, vectors, o = self.read("units"), self.read("embeddings"), self.topics
        embed.check_alignment(built, vectors)
        if o.backend == "simple":
            labelled = topics.simple_topics(built)
            assigned = self._store("topics", "assignments", labelled.select("unit_id", "topic_id", "label"))
            ranked = terms.top_keywords(topics.with_topics(built, assigned), o.keyword_top_n)
            names = assigned.select("topic_id", "label").distinct()
            fallback = F.col("label")
        elif o.backend == "density":
            assigned, ranked = self._density(built, vectors)
            names = assigned.select("topic_id").distinct()
            fallback = F.concat(F.lit("topic_"), F.col("topic_id").cast("string"))
        else:
            raise ValueError(f"unknown topic backend: {o.backend}")
        counts = assigned.agg(F.countDistinct(F.when(F.col("topic_id") != topics.OUTLIER, F.col("topic_id"))).alias("topics"), F.count_if(F.col("topic_id") == topics.OUTLIER).alias("outliers")).first()
        self._log("topics", {"topics": counts.topics, "outliers": counts.outliers})
        titles = terms.topic_titles(names, terms.topic_keywords(ranked), fallback)
        return self._store("topics", "topic_titles", titles.select("topic_id", "keywords", "title"))

    def _density(self, built: DataFrame, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
        o = self.topics
        found = density.density_topics(vectors, o).select("unit_id", "embedding", "topic_id")
        if o.nr_topics is not None:
            tree = self._store("topics", "topic_tree", dendrogram.topic_tree(topics.topic_centroids(found)))
            merged = dendrogram.cut_tree(tree, found, o.nr_topics)
            found = found.join(merged, "topic_id").select("unit_id", "embedding", F.col("merged_topic").alias("topic_id"))
        found = self._store("topics", "clusters", found)
        assigned = found.select("unit_id", "topic_id")
        if o.reduce_outliers:
            if o.reduce_outliers_strategy == "embeddings":
                assigned = topics.reassign_outliers(found)
            elif o.reduce_outliers_strategy == "c-tf-idf":
                weights = self._weights(built, assigned)
                assigned = topics.reassign_outliers_by_terms(
                    topics.with_topics(built, assigned), weights, "modeling_text", o.ngram_min, o.ngram_max
                )
            else:
                raise ValueError(f"unknown outlier strategy: {o.reduce_outliers_strategy}")
        assigned = self._store("topics", "assignments", topics.rank_topics(assigned))
        weights = self._store("topics", "topic_terms", self._weights(built, assigned))
        clustered = terms.top_terms(weights.where(F.col("topic_id") != topics.OUTLIER), o.keyword_top_n)
        lost = topics.with_topics(built, assigned).where(F.col("topic_id") == topics.OUTLIER)
        ranked = clustered.select("topic_id", F.col("term").alias("keyword"), "rank").unionByName(
            terms.top_keywords(lost, o.keyword_top_n).select("topic_id", "keyword", "rank")
        )
        return assigned, ranked

    def _weights(self, built: DataFrame, assigned: DataFrame) -> DataFrame:
        o = self.topics
        counts = terms.term_counts(topics.with_topics(built, assigned), "modeling_text", o.ngram_min, o.ngram_max)
        return terms.term_weights(counts, o.min_df, built.count())

    def measure(self) -> DataFrame:
        placed = topics.with_topics(self.read("units"), self.read("assignments"))
        vectors = self.read("embeddings").join(self.read("assignments").select("unit_id", "topic_id"), "unit_id")
        centroids = self._store("topics", "topic_centroids", topics.topic_centroids(vectors))
        summary = self._store("topics", "summary_base", metrics.topic_summary(placed, self.read("topic_titles")))
        self._store("topics", "domain_breakdown", metrics.domain_breakdown(summary))
        self._store("topics", "trends", metrics.topic_trends(placed))
        shown = metrics.representative_examples(
            self.read("units"), vectors, self.topics.representative_examples, centroids
        )
        self._store("topics", "examples", shown)
        return summary

    def enrich(self) -> DataFrame:
        result = enrich.enrich_topics(
            self.read("summary_base"),
            self.read("examples"),
            self.enrich_factory,
            self.enrichment,
            self.path("enrichment_cache"),
        )
        return self._store("enrich", "enrichment", result)

    def _quality(self) -> DataFrame | None:
        """The counters that the ingest stage stored, if it ran in this folder."""
        try:
            return self.spark.read.json(self.path("ingest_quality"))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in (error.getCondition() or ""):
                return None
            raise

    def publish(self, quality: DataFrame | None = None) -> dict[str, DataFrame]:
        examples, trends = self.read("examples"), self.read("trends")
        quality = self._quality() if quality is None else quality
        enrichment = embed.read_or_empty(self.spark, self.path("enrichment"), enrich.RESULT_SCHEMA)
        summary = self._store("report", "summary", report.final_summary(self.read("summary_base"), enrichment))
        tables = {
            "summary": summary.orderBy(F.col("n_units").desc(), "topic_id"),
            "examples": report.published_examples(examples.orderBy("topic_id", "example_rank")),
            "trends": trends.orderBy("week", F.col("n_units").desc(), "topic_id"),
            "domain_breakdown": metrics.domain_breakdown(summary),
            "figure_sizes": report.figure_sizes(summary, self.report.figure_topics),
            "figure_growth": metrics.growth_scores(trends, self.report.growth_periods),
        }
        for name, table in tables.items():
            write_table(table, self.path(f"published/{name}"), "csv")
        lines = report.report_lines(summary, trends, examples, quality, self.report)
        write_report(lines, self.path("published/report"))
        return tables

    def run(self, raw: DataFrame, mapping: Mapping[str, str] = fixed.EXPORT_HEADER, resume: bool = False, **options) -> dict[str, DataFrame]:
        """All stages; with ``resume`` those are skipped that the folder holds for this input and these options.

        A stage's key hashes the fingerprint of ``raw``, the options of the stage and the keys before it, so a changed option runs
        its stage and those behind it again.  A stage is marked as started before it writes and as finished behind
        that, so what a killed run has half written is written anew.  The providers are known by their options alone.
        """
        t = self.topics
        stages = {
            "ingest": (lambda: self.ingest(raw, mapping, **options), (sorted(mapping.items()), sorted(options.items()))),
            "preprocess": (self.preprocess, self.messages),
            "build_units": (self.build_units, self.units),
            "embed": (self.embed, self.embeddings),
            "assign_topics": (self.assign_topics, replace(t, representative_examples=0)),
            "measure": (self.measure, t.representative_examples),
            "enrich": (self.enrich, self.enrichment),
        }
        key, finished = table_fingerprint(raw), self._finished() if resume else {}
        for name, (stage, chosen) in stages.items():
            key = hashlib.sha256(f"{key} {name} {chosen!r}".encode()).hexdigest()
            if finished.get(name) == key:
                continue
            self._mark(name, key, STARTED)
            stage()
            self._mark(name, key, FINISHED)
        return self.publish(ingest.quality_report(self.read("raw_normalized")))
