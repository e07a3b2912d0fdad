"""The registered queries: every operator over the given tables, with its SQL check where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..functions.flags import flag_columns, priority_label
from ..functions.vectors import HashProvider, cosine, hash_embedding
from ..operators import dendrogram, density, embed, enrich, ingest, messages, metrics, report, spectral, terms, topics, units
from ..options import EmbeddingOptions, EnrichmentOptions, MessageOptions, ReportOptions, TopicOptions, UnitOptions
from ..session import ensure_checkpoint_dir, materialise, written
from ..sources.adapters import WORD_FLAGS, dialogs, labelled_vectors, language_topics, raw_export, table
from ..sources.tables import read_csv, write_report, write_table
from . import check_sql as q

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

MESSAGES = MessageOptions(flags=WORD_FLAGS)
FLAGS = tuple(WORD_FLAGS)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the storage that all machines share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


# --- inputs shared by several queries --------------------------------------------


def built_units(spark: SparkSession, folder: str) -> DataFrame:
    return units.build_units(dialogs(spark, folder), MESSAGES, UnitOptions())


def placed_units(spark: SparkSession, folder: str) -> DataFrame:
    """Units with their topic, written out once because several branches read them."""
    return topics.simple_topics(materialise(built_units(spark, folder)))


def titled_summary(placed: DataFrame) -> DataFrame:
    ranked = terms.top_keywords(placed)
    names = placed.select("topic_id", "label").distinct()
    titles = terms.topic_titles(names, terms.topic_keywords(ranked), F.col("label"))
    return metrics.topic_summary(placed, titles)


def base_summary(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    placed = placed_units(spark, folder)
    return materialise(titled_summary(placed)), placed


def mock_enriched(summary: DataFrame, placed: DataFrame) -> DataFrame:
    """Final summary with the deterministic provider, examples taken by unit order."""
    examples = hashed_examples(placed, 3)
    return report.final_summary(summary, enrich.enrich_topics(summary, examples))


def hashed_vectors(placed: DataFrame) -> DataFrame:
    return placed.select("topic_id", "unit_id", hash_embedding(F.col("modeling_text")).alias("embedding"))


def hashed_examples(placed: DataFrame, n: int) -> DataFrame:
    return metrics.representative_examples(placed, materialise(hashed_vectors(placed)), n)


def exploded(vectors: DataFrame, key: str) -> DataFrame:
    long = vectors.select(key, F.posexplode("embedding").alias("pos", "x"))
    return long.select(key, F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


def all_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of the four text tables, keyed by table and id."""
    sources = [
        ("documents", "doc_id", "text"),
        ("pages", "page_id", "html"),
        ("benchmark", "item_id", "text"),
        ("conversations", "conv_id * 1000 + turn", "text"),
    ]
    parts = [
        table(spark, folder, name).selectExpr(f"'{name}' AS source", f"{key} AS id", f"{text} AS text")
        for name, key, text in sources
    ]
    return reduce(DataFrame.unionByName, parts)


ALL_TEXTS = """texts AS (
  SELECT 'documents' AS source, doc_id AS id, text FROM documents UNION ALL
  SELECT 'pages', page_id, html FROM pages UNION ALL
  SELECT 'benchmark', item_id, text FROM benchmark UNION ALL
  SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations
)"""


# --- sources and ingest ------------------------------------------------------------


@query("SELECT conv_id, turn, role, text FROM conversations WHERE role = 'user'")
def parquet_scan(spark, folder):
    return table(spark, folder, "conversations").where("role = 'user'").select("conv_id", "turn", "role", "text")


@query(f"WITH {q.RAW} SELECT * FROM canonical")
def ingest_normalise(spark, folder):
    return ingest.normalise(ingest.project_columns(raw_export(spark, folder)))


@query(f"WITH {q.RAW} SELECT * FROM canonical WHERE timestamp IS NOT NULL AND chat_uuid <> ''")
def ingest_quarantine(spark, folder):
    return ingest.ingest(raw_export(spark, folder), on_error="quarantine")


@query(
    f"""WITH {q.RAW} SELECT source_row_id, CASE WHEN timestamp IS NULL THEN 'timestamp' ELSE 'chat_uuid' END AS reason
FROM canonical WHERE timestamp IS NULL OR chat_uuid = ''"""
)
def ingest_rejects(spark, folder):
    return ingest.rejects(ingest.normalise(ingest.project_columns(raw_export(spark, folder))))


@query(
    f"""WITH {q.RAW} SELECT count(*) AS total_rows, count(*) FILTER (role = 'user') AS user_rows,
count(*) FILTER (role = 'assistant') AS assistant_rows, count(*) FILTER ({q.strip("message")} = '') AS empty_message_rows,
count(DISTINCT "user") AS unique_users, count(DISTINCT chat_uuid) AS unique_chats FROM canonical"""
)
def ingest_quality(spark, folder):
    return ingest.quality_report(ingest.normalise(ingest.project_columns(raw_export(spark, folder))))


@query(
    """SELECT row_number() OVER (ORDER BY source, doc_id DESC) - 1 AS source_row_id, doc_id, source FROM documents"""
)
def ingest_row_index(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source").withColumn("back", -F.col("doc_id"))
    return ingest.with_row_id(docs, ["source", "back"]).drop("back")


@query("SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def ingest_timestamps(spark, folder):
    shapes = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyyMMdd'T'HHmmss", "MMM d, yyyy HH:mm:ss"]
    kinds = F.pmod(F.xxhash64("event_id"), F.lit(len(shapes)))
    text = F.coalesce(*[F.when(kinds == i, F.date_format("ts", shape)) for i, shape in enumerate(shapes)])
    return table(spark, folder, "events").select("event_id", ingest.parse_timestamp(text).alias("parsed"))


@query("SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, role, text FROM conversations")
def csv_round_trip(spark, folder):
    """The table written as CSV and scanned again, quotes and line breaks included."""
    path = shared_path(spark, "csv")
    write_table(table(spark, folder, "conversations"), path, "csv")
    return read_csv(spark, path)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def parquet_round_trip(spark, folder):
    path = shared_path(spark, "parquet")
    write_table(table(spark, folder, "documents"), path)
    return spark.read.parquet(path)


@query(
    f"""WITH {q.RAW} SELECT count(*) AS total_rows, count(*) FILTER (role = 'user') AS user_rows,
count(*) FILTER (role = 'assistant') AS assistant_rows, count(*) FILTER ({q.strip("message")} = '') AS empty_message_rows,
count(DISTINCT "user") AS unique_users, count(DISTINCT chat_uuid) AS unique_chats FROM canonical"""
)
def stored_quality(spark, folder):
    """The counters as they are stored for the report."""
    path = shared_path(spark, "quality")
    report_row = ingest.quality_report(ingest.normalise(ingest.project_columns(raw_export(spark, folder))))
    write_table(report_row, path, "json", single_file=True)
    return spark.read.json(path)


@query(
    """SELECT nullif(turn % 3, 0)::INTEGER AS topic_id, count(*) AS n_units, count(DISTINCT role) AS n_users,
count(DISTINCT conv_id) AS n_chats FROM conversations GROUP BY 1"""
)
def null_topic_group(spark, folder):
    """Rows without a topic are a group of their own."""
    topic = F.expr("CAST(nullif(turn % 3, 0) AS INT)").alias("topic_id")
    rows = table(spark, folder, "conversations").select(
        topic, F.col("role").alias("user"), F.col("conv_id").alias("chat_uuid"), F.length("text").alias("text_len_chars")
    )
    return metrics.topic_aggregates(rows, {}).select("topic_id", "n_units", "n_users", "n_chats")


# --- text functions --------------------------------------------------------------


@query(f"WITH {ALL_TEXTS} SELECT source, id, {q.clean('text')} AS clean FROM texts")
def clean_text(spark, folder):
    return all_texts(spark, folder).select("source", "id", tx.clean_text(F.col("text")).alias("clean"))


@query(f"WITH {ALL_TEXTS} SELECT source, id, {q.prepared('lower(' + q.clean('text') + ')')} AS masked FROM texts")
def masked_text(spark, folder):
    lowered = F.lower(tx.clean_text(F.col("text")))
    masked = tx.strip_punctuation(tx.mask_entities(lowered))
    return all_texts(spark, folder).select("source", "id", masked.alias("masked"))


@query(f"WITH {ALL_TEXTS}, c AS (SELECT source, id, {q.clean('text')} AS t FROM texts) SELECT source, id, {q.modeling('t')} AS modeling FROM c")
def modeling_text(spark, folder):
    clean = tx.clean_text(F.col("text"))
    return all_texts(spark, folder).select("source", "id", tx.modeling_text(clean).alias("modeling"))


@query(f"WITH {ALL_TEXTS}, c AS (SELECT source, id, {q.clean('text')} AS t FROM texts) SELECT source, id, {q.modeling('t', 400)} AS modeling FROM c")
def modeling_text_limited(spark, folder):
    """The token limit, which callers of models with a short context set."""
    clean = tx.clean_text(F.col("text"))
    return all_texts(spark, folder).select("source", "id", tx.modeling_text(clean, max_tokens=400).alias("modeling"))


@query(
    f"""WITH {ALL_TEXTS}, t AS (SELECT source, unnest({q.keywords("text")}) AS token FROM texts)
SELECT source, token, count(*) AS n FROM t GROUP BY ALL"""
)
def keyword_tokens(spark, folder):
    tokens = all_texts(spark, folder).select("source", F.explode(tx.keyword_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("source", "token").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ALL_TEXTS} SELECT source, id, sha1(text) AS digest FROM texts")
def text_hash(spark, folder):
    return all_texts(spark, folder).select("source", "id", F.sha1("text").alias("digest"))


@query(
    f"""WITH {ALL_TEXTS} SELECT source, id, left(text, 500) AS prepared,
sha1('hashing::hashing-64::500::True::' || left(text, 500)) AS limited_hash,
sha1('hashing::hashing-64::None::True::' || text) AS text_hash FROM texts"""
)
def embedding_cache_key(spark, folder):
    """Keys of the whole texts, and of the same texts for a model that reads 500 characters."""
    whole, limited = EmbeddingOptions(), EmbeddingOptions(max_text_chars=500)
    cut, full = (tx.embedding_input(F.col("text"), o.max_text_chars, o.strip_null_bytes) for o in (limited, whole))
    return all_texts(spark, folder).select(
        "source",
        "id",
        cut.alias("prepared"),
        tx.embedding_key(cut, *limited.identity).alias("limited_hash"),
        tx.embedding_key(full, *whole.identity).alias("text_hash"),
    )


@query(
    """WITH t AS (SELECT CASE WHEN source = 'src1' THEN replace(text, 'e', chr(0)) ELSE text END AS text FROM documents)
SELECT count(*) FILTER (contains(text, chr(0))) AS sanitized, count(*) FILTER (length(text) > 1500) AS truncated FROM t"""
)
def embedding_counters(spark, folder):
    docs = table(spark, folder, "documents")
    text = F.when(F.col("source") == "src1", F.replace("text", F.lit("e"), F.lit("\0"))).otherwise(F.col("text"))
    return embed.preparation_counters(docs.select(text.alias("text")), EmbeddingOptions(max_text_chars=1500))


@query(
    """SELECT 'd' || doc_id AS unit_id, (source <> 'src2')::INT::BIGINT AS n_units,
(CASE WHEN source = 'src0' THEN 0 WHEN source = 'src1' THEN 2 ELSE 1 END)::BIGINT AS n_vectors FROM documents WHERE source IN ('src0', 'src1', 'src2')"""
)
def alignment_problems(spark, folder):
    """Units without a vector, with two, and vectors without a unit."""
    docs = table(spark, folder, "documents").select(F.concat(F.lit("d"), "doc_id").alias("unit_id"), "source")
    vectors = docs.where("source <> 'src0'").unionByName(docs.where("source = 'src1'"))
    return embed.alignment_problems(docs.where("source <> 'src2'"), vectors)


# --- messages ---------------------------------------------------------------------


@query(
    f"""WITH {q.KEPT} SELECT source_row_id, timestamp, "user", chat_uuid, chat_title, role, message FROM kept"""
)
def kept_messages(spark, folder):
    kept = messages.kept_messages(dialogs(spark, folder), MESSAGES)
    return kept.select("source_row_id", "timestamp", "user", "chat_uuid", "chat_title", "role", "message")


@query(
    f"""WITH {q.messages_cte()} SELECT source_row_id, timestamp, "user", chat_uuid, chat_title, role, message, message_raw,
message_len_chars, message_len_words, message_for_modeling, message_modeling_len_tokens, date, week, month, {", ".join(FLAGS)}
FROM messages"""
)
def user_messages(spark, folder):
    return messages.user_messages(dialogs(spark, folder), MESSAGES)


@query(
    f"""WITH {q.DIALOGS}, words AS (SELECT DISTINCT lower({q.clean("text")}) AS w FROM conversations WHERE role = 'system')
SELECT source_row_id, role FROM dialogs WHERE lower({q.clean("message")}) NOT IN (SELECT w FROM words)"""
)
def trivial_messages(spark, folder):
    trivial = table(spark, folder, "conversations").where("role = 'system'").select("text")
    cleaned = dialogs(spark, folder).withColumn("message", tx.clean_text(F.col("message")))
    return messages.drop_trivial(cleaned, trivial).select("source_row_id", "role")


@query(
    """SELECT doc_id, text, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""
)
def exact_duplicates(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return messages.keep_first(docs, ["text"], ["doc_id"])


@query(f"SELECT event_id, {q.dates('ts')} FROM events")
def calendar_features(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", *[c.alias(name) for name, c in messages.calendar_features(F.col("ts")).items()]
    )


@query(
    f"""WITH {ALL_TEXTS}, c AS (SELECT source, id, {q.clean('text')} AS t FROM texts)
SELECT source, id, {q.flags_sql('t', fixed.DOMAIN_FLAGS)} FROM c"""
)
def domain_flags(spark, folder):
    flags = flag_columns(tx.clean_text(F.col("text")))
    return all_texts(spark, folder).select("source", "id", *[c.alias(name) for name, c in flags.items()])


@query(
    f"""WITH {ALL_TEXTS}, c AS (SELECT source, id, {q.clean('text')} AS t FROM texts),
f AS (SELECT source, id, {q.flags_sql('t', WORD_FLAGS)} FROM c)
SELECT source, {q.label_sql()} AS label, count(*) AS n FROM f GROUP BY ALL"""
)
def priority_labels(spark, folder):
    flags = flag_columns(tx.clean_text(F.col("text")), WORD_FLAGS)
    flagged = all_texts(spark, folder).select("source", *[c.alias(name) for name, c in flags.items()])
    return flagged.groupBy("source", priority_label(flagged.columns).alias("label")).agg(F.count(F.lit(1)).alias("n"))


# --- units ------------------------------------------------------------------------


@query(
    f"""WITH {q.messages_cte()} SELECT printf('message-%08d', source_row_id) AS unit_id, chat_uuid, "user", chat_title,
timestamp AS start_ts, timestamp AS end_ts, timestamp, 1 AS n_messages, message AS text, message_for_modeling AS modeling_text,
message_len_chars AS text_len_chars, message_len_words AS text_len_words, message_modeling_len_tokens AS modeling_len_tokens,
date, week, month, {", ".join(FLAGS)} FROM messages"""
)
def message_units(spark, folder):
    built = units.build_units(dialogs(spark, folder), MESSAGES, UnitOptions(mode="message"))
    return units.publish_units(built, FLAGS)


UNIT_SELECT = f"""SELECT unit_id, chat_uuid, "user", chat_title, start_ts, end_ts, timestamp, n_messages, text, modeling_text,
text_len_chars, text_len_words, modeling_len_tokens, date, week, month, {", ".join(FLAGS)} FROM units"""


@query(f"WITH {q.units_cte()} {UNIT_SELECT}")
def merged_units(spark, folder):
    return units.publish_units(built_units(spark, folder), FLAGS)


@query(f"WITH {q.units_cte(gap=45, cap=3)} {UNIT_SELECT}")
def merged_units_hot_groups(spark, folder):
    """The slice-parallel path: every group above two messages counts as hot."""
    options = UnitOptions(max_gap_minutes=45, max_messages=3, hot_group_rows=2, slice_rows=40)
    return units.publish_units(units.build_units(dialogs(spark, folder), MESSAGES, options), FLAGS)


@query(f"WITH {q.units_cte()} SELECT unit_id, unnest(ids) AS source_row_id FROM units")
def unit_message_map(spark, folder):
    return units.unit_message_map(built_units(spark, folder))


def segments_sql(group: str, gap: int, cap: int) -> str:
    by = f"PARTITION BY {group} ORDER BY ts, event_id"
    return f"""WITH g AS (
  SELECT event_id, {group}, ts, coalesce(ts - lag(ts) OVER ({by}) > to_minutes({gap}), false)::INT AS brk FROM events
), s AS (SELECT *, sum(brk) OVER ({by} ROWS UNBOUNDED PRECEDING)::BIGINT AS segment_session FROM g)
SELECT event_id, {group}, segment_session,
  (row_number() OVER (PARTITION BY {group}, segment_session ORDER BY ts, event_id) - 1) // {cap} AS segment_chunk FROM s"""


@query(segments_sql("user_id", 600, 3))
def event_segments(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return units.segment_all(events, ["user_id"], "ts", "event_id", 600, 3).drop("ts")


@query(segments_sql("user_id", 600, 3))
def event_segments_hot(spark, folder):
    """The same where most groups count as hot."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    options = UnitOptions(hot_group_rows=10, slice_rows=500)
    return units.segment_all(events, ["user_id"], "ts", "event_id", 600, 3, options).drop("ts")


@query(segments_sql("event_type", 5, 7))
def event_segments_sliced(spark, folder):
    """Few, large groups: sessions run across slices."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    return units.segment_sliced(events, ["event_type"], "ts", "event_id", 5, 7, slices=16).drop("ts")


# --- embeddings --------------------------------------------------------------------


DOC_HASH = f"""WITH {q.hash_cte("documents", "doc_id", "text")} SELECT doc_id, pos, round(x::DOUBLE, 6) AS x FROM hash_vectors"""


@query(DOC_HASH)
def hash_embeddings(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", hash_embedding(F.col("text")).alias("embedding"))
    return exploded(docs, "doc_id")


UNIT_HASH = f"""WITH {q.units_cte()}, {q.hash_cte("units", "unit_id", "modeling_text")}
SELECT unit_id, pos, round(x::DOUBLE, 6) AS x FROM hash_vectors"""


@query(UNIT_HASH)
def embed_units(spark, folder):
    return exploded(embed.embed_units(materialise(built_units(spark, folder)), HashProvider), "unit_id")


@query(DOC_HASH)
def embed_documents_cached(spark, folder):
    """Inference with a cache table that starts empty; copies of a text are embedded once."""
    cache = shared_path(spark, "embedding-cache")
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("unit_id"), "text")
    options = EmbeddingOptions(max_text_chars=None)
    vectors = embed.cached_embeddings(docs, cache, HashProvider, options)
    return exploded(vectors.withColumnRenamed("unit_id", "doc_id"), "doc_id")


@query(
    """WITH t AS (SELECT sha1('hashing::hashing-64::None::True::' || text) AS text_hash, text AS p, source FROM documents),
known AS (SELECT DISTINCT text_hash FROM t WHERE source IN ('src0', 'src1'))
SELECT text_hash, any_value(p) AS prepared FROM t WHERE text_hash NOT IN (SELECT text_hash FROM known) GROUP BY text_hash"""
)
def embedding_cache_misses(spark, folder):
    """What a cache filled from two sources still lacks."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("unit_id"), "text", "source")
    known = embed.prepare(docs.where("source IN ('src0', 'src1')")).select("text_hash").distinct()
    return embed.missing_texts(embed.prepare(docs), known).select("text_hash", "prepared")


@query(
    """SELECT DISTINCT sha1('hashing::hashing-64::None::True::' || text) AS text_hash,
contains(text, 'license') AS rejected FROM documents"""
)
def embedding_rejects(spark, folder):
    """A provider that refuses whole batches: only the texts at fault end up rejected."""

    def factory():
        def provider(texts):
            if any("license" in text for text in texts):
                raise embed.BatchRejected("not allowed")
            return HashProvider()(texts)

        return provider

    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("unit_id"), "text")
    distinct = embed.prepare(docs).groupBy("text_hash").agg(F.first("prepared").alias("prepared"))
    found = embed.embed(distinct, factory, 16, on_error="record")
    return found.select("text_hash", (F.col("error").isNotNull() & F.col("embedding").isNull()).alias("rejected"))


# --- topics --------------------------------------------------------------------------


@query(f"WITH {q.topics_cte()} SELECT unit_id, label, topic_id FROM placed")
def simple_topics(spark, folder):
    return placed_units(spark, folder).select("unit_id", "label", F.col("topic_id").cast("int").alias("topic_id"))


@query(f"WITH {q.topics_cte()} SELECT p.topic_id, unit_id, text, text_len_chars FROM placed p")
def units_with_topics(spark, folder):
    placed = materialise(placed_units(spark, folder))
    joined = topics.with_topics(placed.drop("topic_id"), placed.select("unit_id", "topic_id"))
    return joined.select("topic_id", "unit_id", "text", "text_len_chars")


DOC_KEYWORDS = f"""WITH {q.terms_cte(1, 1)}, {q.top_keywords_cte("docs", "text", "unit_id")}"""


@query(f"{DOC_KEYWORDS} SELECT topic_id, keyword, n, rank FROM kw_ranked")
def topic_keywords(spark, folder):
    return terms.top_keywords(language_topics(spark, folder), 10, "text", F.col("unit_id"))


@query(
    f"""WITH {q.terms_cte(1, 1, "src0")}, {q.top_keywords_cte("docs", "text", "unit_id", 5)}
SELECT topic_id, array_to_string(kws, ', ') AS keywords,
CASE WHEN topic_id = -1 THEN 'outliers' ELSE array_to_string(kws[1:3], ', ') END AS title FROM kw_lists"""
)
def topic_titles(spark, folder):
    docs = language_topics(spark, folder, "src0")
    lists = terms.topic_keywords(terms.top_keywords(docs, 5, "text", F.col("unit_id")))
    titles = terms.topic_titles(docs.select("topic_id").distinct(), lists, F.lit("none"))
    return titles.select("topic_id", F.array_join("keywords", ", ").alias("keywords"), "title")


@query(
    f"""WITH {q.terms_cte(1, 2)}, {q.weights_cte(0.5)}
SELECT topic_id, term, tf, round(weight, 6) AS weight,
row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term)::INTEGER AS rank FROM weights QUALIFY rank <= 20"""
)
def topic_terms(spark, folder):
    docs = language_topics(spark, folder)
    weights = terms.term_weights(terms.term_counts(docs, "text", 1, 2), 0.5, docs.select("unit_id").count())
    return rounded(terms.top_terms(weights, 20))


@query(f"WITH {q.terms_cte(1, 2)} SELECT topic_id, term, tf FROM counts")
def term_counts(spark, folder):
    return terms.term_counts(language_topics(spark, folder), "text", 1, 2)


@query(f"WITH {q.vector_topics_cte()} SELECT topic_id, pos - 1 AS pos, round(c, 6) AS x FROM centroids")
def topic_centroids(spark, folder):
    found = topics.topic_centroids(labelled_vectors(spark, folder))
    return exploded(found.select("topic_id", F.col("centroid").alias("embedding")), "topic_id")


@query(
    f"""WITH {q.vector_topics_cte(9)}, {q.NEAREST}
SELECT v.unit_id, coalesce(b.topic_id, v.topic_id) AS topic_id FROM vectors v LEFT JOIN best b USING (unit_id)"""
)
def outlier_reassignment(spark, folder):
    return topics.reassign_outliers(labelled_vectors(spark, folder, 9))


@query(f"WITH {q.vector_topics_cte(9)}, {q.NEAREST} SELECT unit_id, topic_id AS nearest_topic, round(similarity, 6) AS similarity FROM best")
def nearest_centroids(spark, folder):
    vectors = labelled_vectors(spark, folder, 9)
    centroids = topics.topic_centroids(vectors.where("topic_id <> -1"))
    found = topics.nearest_centroid(vectors.where("topic_id = -1"), centroids)
    return rounded(found.select("unit_id", "nearest_topic", "similarity"))


@query(
    f"""WITH {q.terms_cte(1, 1, "src0")}, {q.weights_cte(0.0)},
norms AS (SELECT topic_id, sqrt(sum(weight * weight)) AS norm FROM weights WHERE topic_id <> -1 GROUP BY 1),
lost AS (SELECT unit_id, term, count(*) AS n FROM grams WHERE topic_id = -1 GROUP BY ALL),
scores AS (SELECT unit_id, w.topic_id, sum(n * (weight / tf) * weight) / any_value(norm) AS s
  FROM lost JOIN weights w USING (term) JOIN norms USING (topic_id) GROUP BY ALL),
best AS (SELECT unit_id, topic_id FROM scores QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY s DESC, topic_id) = 1)
SELECT d.unit_id, coalesce(b.topic_id, d.topic_id) AS topic_id FROM docs d LEFT JOIN best b USING (unit_id)"""
)
def outlier_reassignment_by_terms(spark, folder):
    docs = language_topics(spark, folder, "src0")
    weights = materialise(terms.term_weights(terms.term_counts(docs, "text"), 1, docs.count()))
    return topics.reassign_outliers_by_terms(docs, weights, "text")


def reduction_sql(*targets: int, n_topics: int = 10) -> str:
    """Average linkage: the most similar pair of topics is merged at a time; cuts are taken at the ``targets``."""
    parts = [
        f"""WITH {q.vector_topics_cte()}, sizes AS (SELECT topic_id, count(*) AS n FROM vectors GROUP BY 1),
c0 AS MATERIALIZED (SELECT topic_id AS t, pos, c AS x, n FROM centroids JOIN sizes USING (topic_id)),
m0 AS MATERIALIZED (SELECT DISTINCT t AS topic_id, t AS merged_topic FROM c0)"""
    ]
    for i in range(n_topics - min(targets)):
        parts.append(
            f"""s{i} AS (SELECT a.t AS into_t, b.t, round(sum(a.x * b.x), 12) AS sim FROM c{i} a JOIN c{i} b ON a.pos = b.pos AND a.t < b.t GROUP BY ALL),
p{i} AS MATERIALIZED (SELECT t, into_t FROM s{i} ORDER BY sim DESC, into_t, t LIMIT 1),
c{i + 1} AS MATERIALIZED (SELECT coalesce(into_t, t) AS t, pos, sum(n * x) / sum(n) AS x, sum(n) AS n FROM c{i} LEFT JOIN p{i} USING (t) GROUP BY ALL),
m{i + 1} AS MATERIALIZED (SELECT topic_id, coalesce(into_t, merged_topic) AS merged_topic FROM m{i} LEFT JOIN p{i} ON t = merged_topic)"""
        )
    cuts = " UNION ALL ".join(f"SELECT {n} AS nr_topics, topic_id, merged_topic FROM m{n_topics - n}" for n in targets)
    return ", ".join(parts) + " " + cuts


@query(reduction_sql(7, 4, 2))
def topic_reduction(spark, folder):
    """Three cuts of one tree of topics."""
    centroids = topics.topic_centroids(labelled_vectors(spark, folder))
    tree = dendrogram.topic_tree(centroids)
    cuts = [dendrogram.cut_tree(tree, centroids, n).select(F.lit(n).alias("nr_topics"), "topic_id", "merged_topic") for n in (7, 4, 2)]
    return reduce(DataFrame.unionByName, cuts)


@query()
def reduced_vectors(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # The fit and the projection read the vectors, so texts are hashed once and not in each of these jobs.
    docs = written(docs.select("doc_id", hash_embedding(F.col("text")).alias("embedding")), "vectors")
    return density.reduce_dimensions(docs, 5).select("doc_id", F.posexplode("reduced").alias("pos", "x"))


def document_density(spark, folder, clustering: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("unit_id"), "text")
    docs = docs.select("unit_id", hash_embedding(F.col("text")).alias("embedding"))
    found = density.density_topics(docs, TopicOptions(backend="density", clustering=clustering))
    return found.select("unit_id", F.col("topic_id").cast("int").alias("topic_id"))


@query()
def density_topics(spark, folder):
    """Documents embedded, reduced and clustered on a grid; held by tests on known clouds."""
    return document_density(spark, folder, "grid")


@query()
def neighbour_coordinates(spark, folder):
    """Documents reduced by the eigenvectors of their neighbour graph; held by tests against dense matrices."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("unit_id"), hash_embedding(F.col("text")).alias("embedding"))
    return spectral.neighbour_coordinates(docs, 5).select("unit_id", F.posexplode("reduced").alias("pos", "x"))


@query()
def varying_topics(spark, folder):
    """Documents embedded, reduced and clustered by varying density; held by a brute-force test."""
    return document_density(spark, folder, "varying")


DENSITY = """WITH RECURSIVE points AS (
  SELECT vec_id, floor(round(list_sum(embedding[1:32]::DOUBLE[]), 9) / 0.2)::BIGINT AS x,
    floor(round(list_sum(embedding[33:]::DOUBLE[]), 9) / 0.2)::BIGINT AS y FROM embeddings
), cells AS (
  SELECT x, y, count(*) AS n FROM points GROUP BY ALL
), dense AS (SELECT * FROM cells WHERE n >= 3),
steps AS (
  SELECT a.x, a.y, b.x AS bx, b.y AS by, b.n AS bn FROM cells a JOIN dense b
    ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y)
), reach AS (
  SELECT x, y, x AS rx, y AS ry FROM dense
  UNION
  SELECT r.x, r.y, s.bx, s.by FROM reach r JOIN steps s ON s.x = r.rx AND s.y = r.ry
), comp AS (SELECT x, y, min({'x': rx, 'y': ry}) AS c FROM reach GROUP BY ALL),
border AS (
  SELECT s.x, s.y, c.c, cells.n FROM steps s JOIN comp c ON c.x = s.bx AND c.y = s.by JOIN cells ON cells.x = s.x AND cells.y = s.y
  WHERE cells.n < 3 QUALIFY row_number() OVER (PARTITION BY s.x, s.y ORDER BY s.bn DESC, c.c) = 1
), members AS (SELECT c.x, c.y, c.c, d.n FROM comp c JOIN dense d USING (x, y) UNION ALL SELECT * FROM border),
sizes AS (SELECT c, sum(n)::BIGINT AS size, count(*) AS n_cells FROM members GROUP BY c)"""


def halves(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors' two half sums, a projection that uses every coordinate, and the grid cell they fall into."""
    def total(begin: int) -> Column:
        part = F.slice(F.col("embedding").cast("array<double>"), begin, 32)
        return F.round(F.aggregate(part, F.lit(0.0), lambda a, x: a + x), 9)

    points = table(spark, folder, "embeddings").select(F.col("vec_id").alias("unit_id"), F.array(total(1), total(33)).alias("reduced"))
    return points.withColumn("cell", density.grid_cell(F.col("reduced"), 0.2))


@query(f"{DENSITY} SELECT size, n_cells FROM sizes WHERE size >= 10")
def density_cluster_sizes(spark, folder):
    """Grid clustering of the half sums; sizes in points and cells."""
    cells = materialise(halves(spark, folder).groupBy("cell").agg(F.count(F.lit(1)).alias("n")))
    found = density.cell_topics(cells, 2, 3, 10)
    return (
        found.join(cells, "cell")
        .groupBy("topic_id")
        .agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("n_cells"))
        .drop("topic_id")
    )


@query(
    f"""{DENSITY}, numbered AS (SELECT c, row_number() OVER (ORDER BY size DESC, c) - 1 AS t FROM sizes WHERE size >= 10)
SELECT vec_id AS unit_id, coalesce(t, -1)::INTEGER AS topic_id
FROM points p LEFT JOIN members m ON m.x = p.x AND m.y = p.y LEFT JOIN numbered USING (c)"""
)
def grid_topics(spark, folder):
    """Density topics of the half sums: topic of every vector, outliers -1."""
    placed = halves(spark, folder)
    return density.assign_cells(placed, 2, 3, 10).select("unit_id", F.col("topic_id").cast("int").alias("topic_id"))


# --- metrics -------------------------------------------------------------------------


SUMMARY_SELECT = f"""SELECT topic_id, topic_title_auto, topic_keywords, n_units, n_users, n_chats,
round(share_of_total, 6) AS share_of_total, round(avg_len_chars, 6) AS avg_len_chars, {q.ROUNDED_SHARES} FROM summary"""


@query(f"WITH {q.summary_cte()} {SUMMARY_SELECT} ORDER BY n_units DESC, topic_id")
def topic_summary(spark, folder):
    return rounded(titled_summary(placed_units(spark, folder)))


@query(f"WITH {q.summary_cte()} SELECT topic_id, {q.ROUNDED_SHARES} FROM summary ORDER BY topic_id")
def domain_breakdown(spark, folder):
    return rounded(metrics.domain_breakdown(metrics.topic_aggregates(placed_units(spark, folder))))


@query(f"WITH {q.topics_cte()} SELECT week, topic_id, count(*) AS n_units FROM placed GROUP BY ALL")
def topic_trends(spark, folder):
    return metrics.topic_trends(placed_units(spark, folder))


EVENT_TRENDS = """trends AS (SELECT strftime(ts, '%G-W%V') AS week, user_id AS topic_id, count(*) AS n_units FROM events GROUP BY ALL),
tail AS (SELECT * FROM trends QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY week DESC) <= 4),
deltas AS (SELECT topic_id, n_units - lag(n_units) OVER (PARTITION BY topic_id ORDER BY week) AS d FROM tail),
growth AS (SELECT topic_id, coalesce(avg(d), 0.0)::DOUBLE AS growth_score FROM deltas GROUP BY ALL)"""


def event_trends(spark: SparkSession, folder: str) -> DataFrame:
    week = messages.calendar_features(F.col("ts"))["week"]
    return metrics.topic_trends(
        table(spark, folder, "events").select(week.alias("week"), F.col("user_id").alias("topic_id"))
    )


@query(f"WITH {EVENT_TRENDS} SELECT * FROM tail")
def last_periods(spark, folder):
    return metrics.last_periods(event_trends(spark, folder), 4)


@query(f"WITH {EVENT_TRENDS} SELECT topic_id, round(growth_score, 6) AS growth_score FROM growth")
def growth_scores(spark, folder):
    return rounded(metrics.growth_scores(event_trends(spark, folder), 4))


OWN_SIMILARITY = f"""{q.vector_topics_cte()}, sims AS (
  SELECT topic_id, unit_id, sum(x * c) / greatest(sqrt(sum(x * x)) * greatest(sqrt(sum(c * c)), 1e-12), 1e-12) AS similarity
  FROM long JOIN centroids USING (topic_id, pos) GROUP BY ALL)"""


@query(f"WITH {OWN_SIMILARITY} SELECT topic_id, unit_id, round(similarity, 6) AS similarity FROM sims")
def cosine_to_centroid(spark, folder):
    vectors = labelled_vectors(spark, folder)
    joined = vectors.join(topics.topic_centroids(vectors), "topic_id")
    similarity = cosine(F.col("embedding"), F.col("centroid")).alias("similarity")
    return rounded(joined.select("topic_id", "unit_id", similarity))


@query(
    f"""WITH {OWN_SIMILARITY} SELECT topic_id, unit_id, round(similarity, 6) AS similarity,
row_number() OVER (PARTITION BY topic_id ORDER BY similarity DESC, unit_id)::INTEGER AS example_rank FROM sims QUALIFY example_rank <= 12"""
)
def ranked_examples(spark, folder):
    return rounded(metrics.rank_examples(labelled_vectors(spark, folder), 12))


EXAMPLES = f"""{q.hash_cte("placed", "unit_id", "modeling_text")}, located AS (
  SELECT topic_id, unit_id, pos, x::DOUBLE AS x FROM hash_vectors JOIN placed USING (unit_id)
), middles AS (SELECT topic_id, pos, avg(x) AS c FROM located GROUP BY ALL),
near AS (
  SELECT topic_id, unit_id, sum(x * c) / greatest(sqrt(sum(x * x)) * greatest(sqrt(sum(c * c)), 1e-12), 1e-12) AS similarity
  FROM located JOIN middles USING (topic_id, pos) GROUP BY ALL
), examples AS (
  SELECT n.topic_id, unit_id, chat_uuid, "user", strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, text,
    row_number() OVER (PARTITION BY n.topic_id ORDER BY round(similarity, 12) DESC, unit_id)::INTEGER AS example_rank
  FROM near n JOIN placed USING (unit_id) QUALIFY example_rank <= 3
)"""


@query(f"WITH {q.topics_cte()}, {EXAMPLES} SELECT * FROM examples")
def representative_examples(spark, folder):
    return hashed_examples(materialise(placed_units(spark, folder)), 3)


@query(f"WITH {q.topics_cte()} SELECT count(DISTINCT topic_id) AS n_topics FROM placed")
def topic_count(spark, folder):
    return metrics.topic_count(placed_units(spark, folder))


# --- enrichment ---------------------------------------------------------------------


REQUESTS = f"""WITH {q.summary_cte()}, {EXAMPLES}, requests AS (
  SELECT s.topic_id, topic_keywords, topic_title_auto, n_units, n_users, n_chats,
    (SELECT list(text ORDER BY example_rank) FROM examples e WHERE e.topic_id = s.topic_id AND example_rank <= 2) AS examples
  FROM summary s
)"""

MOCK = ", ".join(
    quoted
    for quoted in (
        "'Hypothesis-based summary for topic ' || topic_id || '.' AS topic_description",
        f"{q.quoted(fixed.MOCK_TEXTS['suspected_jtbd'])} AS suspected_jtbd",
        f"{q.quoted(fixed.MOCK_TEXTS['suspected_pain_points'])} AS suspected_pain_points",
        "'Potentially important because the topic appears in ' || len(examples) || ' representative examples.' AS suspected_business_value",
        f"{q.quoted(fixed.MOCK_TEXTS['suspected_product_action'])} AS suspected_product_action",
        f"{q.quoted(fixed.MOCK_TEXTS['confidence_note'])} AS confidence_note",
    )
)
MOCK_TITLE = "upper(topic_keywords[1]) || lower(string_split(topic_keywords, ',')[1][2:])"


def requests_of(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    summary, placed = base_summary(spark, folder)
    return summary, hashed_examples(placed, 3)


@query(
    f"""{REQUESTS} SELECT topic_id, topic_keywords, topic_title_auto, n_units, n_users, n_chats,
array_to_string(examples, ' | ') AS examples FROM requests"""
)
def enrichment_requests(spark, folder):
    found = enrich.topic_requests(*requests_of(spark, folder), 2)
    return found.withColumn("examples", F.array_join("examples", " | "))


@query(f"{REQUESTS} SELECT topic_id, {MOCK_TITLE} AS topic_title, {MOCK} FROM requests")
def mock_enrichment(spark, folder):
    summary, examples = requests_of(spark, folder)
    found = enrich.enrich_topics(summary, examples, options=EnrichmentOptions(max_examples_per_topic=2))
    return found.withColumn("topic_id", F.col("topic_id").cast("int"))


@query(f"{REQUESTS} SELECT topic_id, {MOCK_TITLE} AS topic_title, {MOCK} FROM requests")
def enrichment_cached(spark, folder):
    """Answers of a provider that is gone when they are asked for again."""

    def factory(alive):
        def build():
            def provider(payload):
                if not alive:
                    raise ConnectionError("gone")
                said = {name: text.format(payload["topic_id"], len(payload["examples"])) for name, text in fixed.MOCK_TEXTS.items()}
                return {"topic_title": payload["topic_keywords"].split(",")[0].capitalize(), **said}

            return provider

        return build

    summary, examples = requests_of(spark, folder)
    examples, options, cache = materialise(examples), EnrichmentOptions(max_examples_per_topic=2), shared_path(spark, "answers")
    enrich.enrich_topics(summary, examples, factory(True), options, cache).count()
    found = enrich.enrich_topics(summary, examples, factory(False), options, cache)
    return found.withColumn("topic_id", F.col("topic_id").cast("int"))


@query(
    f"""WITH {q.summary_cte()} SELECT topic_id, {", ".join(f"NULL::VARCHAR AS {c}" for c in fixed.ENRICHMENT_COLUMNS)} FROM summary"""
)
def disabled_enrichment(spark, folder):
    summary, _ = base_summary(spark, folder)
    return enrich.enrich_topics(summary, summary, options=EnrichmentOptions(enabled=False))


FALLBACK = ", ".join(
    f"CASE WHEN topic_id % 2 = 1 THEN {q.quoted(text).replace('{0}', chr(39) + ' || topic_id || ' + chr(39)).replace('{1}', 'TimeoutError: no answer')} "
    f"ELSE m.{name} END AS {name}"
    for name, text in fixed.FALLBACK_TEXTS.items()
)


@query(
    f"""{REQUESTS.replace("example_rank <= 2", "example_rank <= 12")}, m AS (SELECT topic_id, topic_title_auto, {MOCK_TITLE} AS topic_title, {MOCK} FROM requests)
SELECT topic_id, CASE WHEN topic_id % 2 = 1 THEN topic_title_auto ELSE topic_title END AS topic_title, {FALLBACK} FROM m"""
)
def enrichment_fallback(spark, folder):
    """A provider that refuses every second topic; the others are answered."""

    def factory():
        def choosy(payload):
            topic, first = payload["topic_id"], payload["topic_keywords"].split(",")[0]
            if topic % 2:
                raise TimeoutError("no answer")
            said = {name: text.format(topic, len(payload["examples"])) for name, text in fixed.MOCK_TEXTS.items()}
            return {"topic_title": first.capitalize(), **said}

        return choosy

    summary, examples = requests_of(spark, folder)
    return enrich.enrich_topics(summary, examples, factory)


@query(
    f"""{REQUESTS.replace("example_rank <= 2", "example_rank <= 12")} SELECT topic_id, to_json({{
  'model': 'some-model', 'temperature': 0.0::DOUBLE, 'messages': [
    {{'role': 'system', 'content': {q.quoted(fixed.SYSTEM_PROMPT)}}},
    {{'role': 'user', 'content': to_json({{'topic_id': topic_id, 'topic_keywords': topic_keywords, 'topic_title_auto': topic_title_auto,
      'n_units': n_units, 'n_users': n_users, 'n_chats': n_chats, 'examples': examples}})::VARCHAR}}]}})::VARCHAR AS request FROM requests"""
)
def chat_requests(spark, folder):
    return enrich.chat_request(enrich.topic_requests(*requests_of(spark, folder)), "some-model")


@query(
    """SELECT event_id, event_type AS topic_title, NULL::VARCHAR AS topic_description,
user_id || '; ' || event_type AS suspected_jtbd, regexp_replace(props, '"k": ', '"k": ') AS suspected_pain_points,
'True' AS suspected_business_value, user_id::VARCHAR AS suspected_product_action, NULL::VARCHAR AS confidence_note,
NULL::VARCHAR AS parse_error FROM events"""
)
def response_parsing(spark, folder):
    """Replies built from ``events``: fenced, followed by prose, with nested values."""
    body = F.concat(
        F.lit('{"topic_title": " '), F.col("event_type"), F.lit(' ", "suspected_jtbd": ['), F.col("user_id").cast("string"),
        F.lit(', null, "'), F.col("event_type"), F.lit('"], "suspected_pain_points": '), F.col("props"),
        F.lit(', "suspected_business_value": true, "suspected_product_action": '), F.col("user_id").cast("string"),
        F.lit(', "confidence_note": null, "other": 1}'),
    )
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    talky = F.concat(F.lit("Well, {so}: "), body, F.lit("\n\nAnything else? {}"))
    reply = F.when(F.col("event_type") == "click", fenced).when(F.col("event_type") == "error", talky).otherwise(body)
    return enrich.parse_responses(table(spark, folder, "events").select("event_id", reply.alias("response")))


# --- report ------------------------------------------------------------------------


FINAL = f"WITH {q.summary_cte()}, growth_tail AS (SELECT * FROM trends QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY week DESC) <= 4)"


@query(
    f"""{REQUESTS.replace("example_rank <= 2", "example_rank <= 12")} SELECT s.* EXCLUDE (share_of_total, avg_len_chars, {", ".join(fixed.FLAG_SHARES.values())}),
round(share_of_total, 6) AS share_of_total, round(avg_len_chars, 6) AS avg_len_chars, {q.ROUNDED_SHARES},
{MOCK.replace("topic_id", "s.topic_id")}, {MOCK_TITLE.replace("topic_keywords", "s.topic_keywords")} AS topic_title_llm
FROM summary s JOIN requests r USING (topic_id)"""
)
def final_summary(spark, folder):
    summary, placed = base_summary(spark, folder)
    return rounded(mock_enriched(summary, placed))


@query(f"WITH {q.summary_cte()} {SUMMARY_SELECT.replace('SELECT', 'SELECT topic_title_auto AS topic_title_llm,')}")
def final_summary_without_enrichment(spark, folder):
    summary, _ = base_summary(spark, folder)
    return rounded(report.final_summary(summary)).drop(*fixed.ENRICHMENT_COLUMNS[1:])


@query(f"""WITH {q.topics_cte()}, {EXAMPLES} SELECT topic_id, chat_uuid, "user", timestamp, text FROM examples""")
def published_examples(spark, folder):
    return report.published_examples(hashed_examples(placed_units(spark, folder), 3))


@query(f"{FINAL} SELECT sum(n_units)::BIGINT AS n_units, count(DISTINCT topic_id) AS n_topics FROM summary")
def report_totals(spark, folder):
    return report.totals(base_summary(spark, folder)[0])


@query(f"{FINAL} SELECT topic_id, topic_title_auto, n_units, n_users FROM summary ORDER BY n_units DESC, topic_id LIMIT 5")
def top_by_volume(spark, folder):
    summary, _ = base_summary(spark, folder)
    return report.top_by(summary, "n_units", 5).select("topic_id", "topic_title_auto", "n_units", "n_users")


@query(f"{FINAL} SELECT topic_id, n_users, n_units FROM summary ORDER BY n_users DESC, n_units DESC, topic_id LIMIT 5")
def top_by_users(spark, folder):
    summary, _ = base_summary(spark, folder)
    return report.top_by(summary, "n_users", 5).select("topic_id", "n_users", "n_units")


@query(
    f"""{FINAL}, growth AS (SELECT topic_id, CASE WHEN count(*) > 1
  THEN (last(n_units ORDER BY week) - first(n_units ORDER BY week)) / (count(*) - 1) ELSE 0.0 END::DOUBLE AS growth_score FROM growth_tail GROUP BY 1)
SELECT topic_id, topic_title_auto, round(growth_score, 6) AS growth_score FROM growth JOIN summary USING (topic_id)
ORDER BY growth.growth_score DESC, topic_id LIMIT 5"""
)
def fastest_growing(spark, folder):
    summary, placed = base_summary(spark, folder)
    found = report.fastest_growing(summary, metrics.topic_trends(placed), 5)
    return rounded(found.select("topic_id", "topic_title_auto", "growth_score"))


@query(
    f"""{FINAL} SELECT topic_id, n_units, printf('%.2f%%', 100 * has_error_terms_share) AS error_share FROM summary
ORDER BY has_error_terms_share DESC, n_units DESC, topic_id LIMIT 5"""
)
def highest_error_signal(spark, folder):
    summary, _ = base_summary(spark, folder)
    found = report.top_by(summary, "has_error_terms_share", 5)
    return found.select("topic_id", "n_units", report.percent(F.col("has_error_terms_share")).alias("error_share"))


@query(
    f"""{FINAL}, long AS ("""
    + " UNION ALL ".join(
        f"SELECT {q.quoted(label)} AS domain, topic_id, n_units, {share} AS share FROM summary"
        for share, label in fixed.REPORT_DOMAINS.items()
    )
    + """) SELECT domain, topic_id, round(share, 6) AS share FROM long
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY long.share DESC, n_units DESC, topic_id) = 1 AND long.share > 0"""
)
def domain_highlights(spark, folder):
    summary, _ = base_summary(spark, folder)
    return rounded(report.domain_highlights(summary).select("domain", "topic_id", "share"))


@query(
    f"""{FINAL} SELECT topic_id, {q.quoted(fixed.MOCK_TEXTS["suspected_product_action"])} AS suspected_product_action,
{q.quoted(fixed.MOCK_TEXTS["suspected_jtbd"])} AS suspected_jtbd FROM summary ORDER BY n_units DESC, topic_id LIMIT 5"""
)
def product_hypotheses(spark, folder):
    found = report.product_hypotheses(mock_enriched(*base_summary(spark, folder)), 5)
    return found.select("topic_id", "suspected_product_action", "suspected_jtbd")


@query(
    f"""{FINAL} SELECT topic_id, topic_title_auto AS title FROM summary"""
)
def display_titles(spark, folder):
    """A blank enriched title gives way to the automatic one."""
    summary, _ = base_summary(spark, folder)
    blank = F.when(F.col("n_units") > 20, F.lit(" \t")).otherwise(F.lit(None).cast("string"))
    title = tx.display_title(blank, F.col("topic_title_auto"), F.col("topic_id"))
    return summary.select("topic_id", title.alias("title"))


@query(f"{FINAL} SELECT topic_id, n_units FROM summary ORDER BY n_units DESC, topic_id LIMIT 15")
def figure_sizes(spark, folder):
    return report.figure_sizes(base_summary(spark, folder)[0])


def section_sql(number: int, line: str, source: str, order: str) -> str:
    return f"SELECT {number} AS section, CAST(row_number() OVER (ORDER BY {order}) + 99 AS INTEGER) AS rank, {line} AS line FROM ({source})"


TITLE = "'- Topic ' || topic_id || ': ' || title"
HEADS = " UNION ALL ".join(
    [f"SELECT 0 AS section, -2000 AS rank, {q.quoted(fixed.REPORT_TITLE)} AS line"]
    + [f"SELECT {i}, unnest([{3 * i - 999}, {3 * i + 2}, {3 * i + 3}]), unnest(['', '## {name}', ''])" for i, name in enumerate(fixed.REPORT_SECTIONS)]
)
REPORT = " UNION ALL ".join(
    [
        HEADS,
        """SELECT 0, unnest([100, 101, 102, 103, 104]), unnest(['- Total input rows: ' || count(*), '- User rows: ' || count(*) FILTER (role = 'user'),
  '- Assistant rows: ' || count(*) FILTER (role = 'assistant'), '- Unique users: ' || count(DISTINCT "user"),
  '- Unique chats: ' || count(DISTINCT chat_uuid)]) FROM dialogs""",
        "SELECT 1, unnest([100, 101]), unnest(['- Analysis units: ' || sum(n_units), '- Topics: ' || count(*)]) FROM titled",
        section_sql(2, f"{TITLE} || ' (units=' || n_units || ', users=' || n_users || ', keywords=' || topic_keywords || ')'", "FROM titled", "n_units DESC, topic_id"),
        section_sql(3, f"{TITLE} || ' (users=' || n_users || ', units=' || n_units || ')'", "FROM titled", "n_users DESC, n_units DESC, topic_id"),
        section_sql(4, f"{TITLE} || ' (growth_score=' || printf('%.2f', growth_score) || ')'", "FROM titled JOIN growth USING (topic_id)", "growth_score DESC, topic_id"),
        section_sql(5, f"{TITLE} || ' (error_share=' || printf('%.2f%%', 100 * has_error_terms_share) || ')'", "FROM titled", "has_error_terms_share DESC, n_units DESC, topic_id"),
        section_sql(
            6, "'- ' || domain || ': topic ' || topic_id || ' (' || title || ') with share ' || printf('%.2f%%', 100 * share)", "FROM tops", "domain_no"
        ),
        section_sql(
            7,
            f"'- Topic ' || topic_id || ': ' || {q.quoted(fixed.MOCK_TEXTS['suspected_product_action'])} || ' (JTBD: ' "
            f"|| {q.quoted(fixed.MOCK_TEXTS['suspected_jtbd'])} || ')'",
            "FROM titled",
            "n_units DESC, topic_id",
        ),
        section_sql(
            8,
            """'- Topic ' || topic_id || ' | ' || "user" || ' | ' || timestamp || ': ' || text""",
            "FROM examples ORDER BY topic_id, example_rank LIMIT 15",
            "topic_id, example_rank",
        ),
    ]
)


REPORT_TABLES = (
    f"""{REQUESTS}, titled AS (SELECT s.*, {MOCK_TITLE.replace("topic_keywords", "s.topic_keywords")} AS title FROM summary s),
growth AS (SELECT topic_id, CASE WHEN count(*) > 1 THEN (last(n_units ORDER BY week) - first(n_units ORDER BY week)) / (count(*) - 1) ELSE 0.0 END AS growth_score
  FROM (SELECT * FROM trends QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY week DESC) <= 4) GROUP BY 1),
domains AS ("""
    + " UNION ALL ".join(
        f"SELECT {n} AS domain_no, {q.quoted(label)} AS domain, topic_id, title, n_units, {share} AS share FROM titled"
        for n, (share, label) in enumerate(fixed.REPORT_DOMAINS.items())
    )
    + f"""), tops AS (SELECT * FROM domains QUALIFY row_number() OVER (PARTITION BY domain ORDER BY share DESC, n_units DESC, topic_id) = 1 AND share > 0)
"""
)


@query(f"{REPORT_TABLES} SELECT section, rank, line FROM ({REPORT})")
def report_lines(spark, folder):
    summary, placed = base_summary(spark, folder)
    quality = ingest.quality_report(dialogs(spark, folder))
    examples = hashed_examples(placed, 3)
    final = report.final_summary(summary, enrich.enrich_topics(summary, examples))
    lines = report.report_lines(materialise(final), metrics.topic_trends(placed), examples, quality, ReportOptions())
    return lines.select("section", "rank", "line")


@query(f"{REPORT_TABLES} SELECT unnest(string_split(line, chr(10))) AS line FROM ({REPORT})")
def stored_report(spark, folder):
    """The report as it is read back from its text file."""
    path = shared_path(spark, "report")
    lines = report_lines(spark, folder)
    write_report(lines, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(f"WITH {q.vector_topics_cte(9)}, {q.NEAREST} SELECT unit_id, topic_id AS nearest_topic, round(similarity, 6) AS similarity FROM best")
def stored_model_topics(spark, folder):
    """Units placed by a model that was stored as tables and read again."""
    vectors, path = labelled_vectors(spark, folder, 9), shared_path(spark, "model")
    write_table(topics.topic_centroids(vectors.where("topic_id <> -1")), path)
    found = topics.nearest_centroid(vectors.where("topic_id = -1"), spark.read.parquet(path))
    return rounded(found.select("unit_id", "nearest_topic", "similarity"))


@query(
    """WITH docs AS (SELECT doc_id, CASE WHEN source = 'src0' THEN -1 ELSE ascii(lang) * 1000 + ascii(substr(lang, 2, 1)) END AS topic_id, text FROM documents),
first AS (SELECT topic_id, string_agg(text, ' | ' ORDER BY doc_id) AS examples
  FROM (SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY doc_id) <= 2) GROUP BY 1)
SELECT topic_id, count(*) AS n_units, count(DISTINCT doc_id % 7) AS n_users, count(DISTINCT doc_id % 5) AS n_chats, any_value(examples) AS examples
FROM docs JOIN first USING (topic_id) WHERE topic_id <> -1 GROUP BY 1"""
)
def requests_without_outliers(spark, folder):
    """Requests for a summary that holds the outlier topic, which is never sent out."""
    docs = language_topics(spark, folder, "src0")
    distinct = lambda n: F.countDistinct(F.col("unit_id") % n)
    summary = docs.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n_units"), distinct(7).alias("n_users"), distinct(5).alias("n_chats"))
    summary = summary.withColumns({"topic_keywords": F.lit(""), "topic_title_auto": F.lit("")})
    rank = F.row_number().over(Window.partitionBy("topic_id").orderBy("unit_id"))
    found = enrich.topic_requests(summary, docs.withColumn("example_rank", rank), 2)
    return found.select("topic_id", "n_units", "n_users", "n_chats", F.array_join("examples", " | ").alias("examples"))
