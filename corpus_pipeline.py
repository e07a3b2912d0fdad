"""From raw documents to token ids: five stages, each over all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.llm import decontaminate, language, mixing, simhash, token_store
from threadlens.llm.common import held_out, staged
from threadlens.llm.queries import DOMAIN, WEIGHTS, table, tokenizer_path

#: Least pooled probability of a document's language.
LEAST_SCORE = 0.5
#: Share of the tokens that the mix takes, passes over a source at most, and the seed of their order.
BUDGET_SHARE, EPOCHS, SEED = 0.9, 1, 11


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a clear language go."""
    model = language.learn(docs.where(~held_out("doc_id", 4, 2)))
    return language.accepted(docs, model, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose fingerprints of 3-word shingles link at two bits the one of the smallest id stays."""
    return simhash.keep_first(docs, distance=2, shingle=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a span with a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken to their target weights."""
    return mixing.mixed(docs, DOMAIN, WEIGHTS, BUDGET_SHARE, EPOCHS, SEED)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are written, indexed and read back by key: doc_id, start, n_tokens, ids_crc32."""
    store = token_store.write_store(docs, tokenizer_path())
    return store.checksums(token_store.keys_of(docs)).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]
#: SQL cannot express the recurrent network of the first stage; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
