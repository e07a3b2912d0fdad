"""Views of the given test tables in the shape the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Flag registry of words that do occur in the test texts; keeps the usual flag names.
WORD_FLAGS = {
    "has_code": r"\bthe\b",
    "has_sql": r"\bund\b",
    "has_link": r"\bqu\w+",
    "has_excel_terms": r"\bder\b",
    "has_jira_terms": r"\bque\b",
    "has_confluence_terms": r"\bla\b",
    "has_grafana_terms": r"\bthis\b",
    "has_litellm_terms": r"\bdie\b",
    "has_openwebui_terms": r"\bel\b",
    "has_1c_terms": r"\bles\b",
    "has_error_terms": r"\band\b",
    "has_document_terms": r"\bwith\b",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dialogs(spark: SparkSession, folder: str) -> DataFrame:
    """``conversations`` as a canonical message table: invented time, user and chat; some chats twice."""
    hours = "conv_id * 9"
    base = table(spark, folder, "conversations").selectExpr(
        "conv_id * 1000 + turn AS source_row_id",
        f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(({hours}) DIV 24 AS INT), "
        f"CAST(({hours}) % 24 AS INT), CAST(3 * turn * turn AS INT), 0) AS timestamp",
        "concat('u', conv_id % 17) AS user",
        "CAST(conv_id AS STRING) AS chat_uuid",
        "concat('conv ', conv_id) AS chat_title",
        "role",
        "text AS message",
        "conv_id",
    )
    again = base.where("conv_id % 10 = 0").withColumn("source_row_id", F.col("source_row_id") + 10_000_000)
    return base.unionByName(again).drop("conv_id")


def raw_export(spark: SparkSession, folder: str) -> DataFrame:
    """``conversations`` as a raw export: text columns, mixed time formats, padded keys, nulls, bad rows."""
    stamp = "(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(conv_id AS INT), CAST(turn AS INT), 5, 0))"
    return table(spark, folder, "conversations").selectExpr(
        "conv_id * 1000 + turn AS source_row_id",
        f"""CASE WHEN text LIKE '%aux%' AND turn = 3 THEN 'not a time'
                 WHEN turn = 0 THEN date_format({stamp}, 'yyyy-MM-dd HH:mm:ss')
                 WHEN turn = 1 THEN date_format({stamp}, "yyyy-MM-dd'T'HH:mm:ss")
                 WHEN turn = 2 THEN date_format({stamp}, 'MM/dd/yyyy HH:mm:ss')
                 ELSE date_format({stamp}, 'yyyy/MM/dd HH:mm') END AS `Время`""",
        "CASE WHEN turn = 5 THEN NULL ELSE concat('  u', conv_id % 17, chr(160)) END AS `Пользователь`",
        "CASE WHEN role = 'system' AND turn = 0 AND conv_id % 2 = 0 THEN ' ' ELSE concat(chr(9), conv_id, ' ') END AS `Chat UUID`",
        "CASE WHEN turn = 2 THEN NULL ELSE concat(' conv ', conv_id) END AS `Чат`",
        "concat(role, ' ') AS role",
        "CASE WHEN role = 'system' THEN NULL ELSE text END AS message",
        "turn AS unused",
    )


def labelled_vectors(spark: SparkSession, folder: str, outlier_label: int | None = None) -> DataFrame:
    """``embeddings`` as (unit_id, embedding, topic_id); one label can be declared outliers."""
    topic = F.col("label").cast("int")
    if outlier_label is not None:
        topic = F.when(topic == outlier_label, F.lit(-1)).otherwise(topic)
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("unit_id"), "embedding", topic.alias("topic_id"))


def language_topics(spark: SparkSession, folder: str, outlier_source: str | None = None) -> DataFrame:
    """``documents`` as units whose topic is their language; one source can be declared outliers."""
    code = F.ascii("lang") * 1000 + F.ascii(F.substring("lang", 2, 1))
    if outlier_source is not None:
        code = F.when(F.col("source") == outlier_source, F.lit(-1)).otherwise(code)
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("unit_id"), code.alias("topic_id"), "text")
    return docs
