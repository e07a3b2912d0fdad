"""Embeddings: text choice, cached distributed inference, alignment check."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import embedding_input, embedding_key
from ..options import EmbeddingOptions
from ..session import materialise

# A provider turns a list of texts into an [n, D] array.  Jobs receive a factory,
# so every task builds its own provider (model, connection) on its machine.
Provider = Callable[[list[str]], np.ndarray]
ProviderFactory = Callable[[], Provider]


class BatchRejected(Exception):
    """Raised by a provider when it refuses a batch as a whole (a bad request)."""


def embedding_text(units: DataFrame) -> Column:
    """Modelling text if the table has it, else the plain text; null becomes empty."""
    for name in ("modeling_text", "text"):
        if name in units.columns:
            return F.coalesce(F.col(name), F.lit(""))
    raise ValueError("units need a modeling_text or a text column to be embedded")


def prepare(units: DataFrame, options: EmbeddingOptions = EmbeddingOptions()) -> DataFrame:
    """unit_id, the prepared text and its cache key."""
    prepared = embedding_input(embedding_text(units), options.max_text_chars, options.strip_null_bytes)
    return units.select("unit_id", prepared.alias("prepared")).withColumn(
        "text_hash", embedding_key(F.col("prepared"), *options.identity)
    )


def preparation_counters(units: DataFrame, options: EmbeddingOptions = EmbeddingOptions()) -> DataFrame:
    """How many texts lost NULs, and how many were cut to the model's limit."""
    text = embedding_text(units)
    too_long = F.length(text) > options.max_text_chars if options.max_text_chars is not None else F.lit(False)
    changed = too_long | F.lit(options.strip_null_bytes)
    return units.agg(
        F.count_if(text.contains("\0") & changed).alias("sanitized"), F.count_if(too_long).alias("truncated")
    )


def embed_batch(provider: Provider, texts: Sequence[str]) -> list[tuple[np.ndarray | None, str | None]]:
    """(vector, error) per text.

    Spans of the batch wait on a stack; a span that the provider refuses comes
    back as two halves, and a text refused alone gets the provider's words.
    """
    found: list[tuple[np.ndarray | None, str | None]] = [(None, None)] * len(texts)
    waiting = [range(len(texts))]
    while waiting:
        span = waiting.pop()
        asked = [texts[i] for i in span]
        try:
            answer = np.asarray(provider(asked), dtype=np.float32)
        except BatchRejected as refusal:
            if len(span) == 1:
                found[span.start] = (None, f"refused by the provider: {refusal}")
            else:
                half = len(span) // 2
                waiting += [span[half:], span[:half]]
            continue
        if len(answer) != len(asked):
            raise ValueError(f"provider returned {len(answer)} vectors for {len(asked)} texts")
        for place, vector in zip(span, answer):
            found[place] = (vector, None)
    return found


def embed(
    texts: DataFrame,
    factory: ProviderFactory,
    batch_size: int = 64,
    on_error: str = "raise",
) -> DataFrame:
    """(text_hash, prepared) -> (text_hash, embedding, error), in fixed-size batches per task.

    With ``on_error="record"`` a text the provider rejects keeps its row with a
    null vector; with ``"raise"`` the job stops and names it.
    """
    if on_error not in ("raise", "record"):
        raise ValueError(f"unknown on_error: {on_error}")
    size = max(1, batch_size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()

        def finish(batch: pd.DataFrame) -> pd.DataFrame:
            results = embed_batch(provider, batch["prepared"].tolist())
            errors = [error for _, error in results]
            if on_error == "raise" and any(errors):
                key, error = next(pair for pair in zip(batch["text_hash"], errors) if pair[1])
                raise ValueError(f"text {key} was {error}")
            return pd.DataFrame(
                {"text_hash": batch["text_hash"].to_numpy(), "embedding": [v for v, _ in results], "error": errors}
            )

        rest: pd.DataFrame | None = None
        for frame in frames:
            rest = frame if rest is None or rest.empty else pd.concat([rest, frame], ignore_index=True)
            full = len(rest) - len(rest) % size
            for start in range(0, full, size):
                yield finish(rest.iloc[start : start + size])
            rest = rest.iloc[full:]
        if rest is not None and not rest.empty:
            yield finish(rest)

    return texts.select("text_hash", "prepared").mapInPandas(
        run, "text_hash string, embedding array<float>, error string"
    )


def read_or_empty(spark, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty frame when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return spark.createDataFrame([], schema)
        raise


CACHE_SCHEMA = "text_hash string, embedding array<float>"


def missing_texts(prepared: DataFrame, cache: DataFrame) -> DataFrame:
    """Each text that the cache lacks, once, however many units share it."""
    distinct = prepared.groupBy("text_hash").agg(F.first("prepared").alias("prepared"))
    return distinct.join(cache.select("text_hash"), "text_hash", "left_anti")


def inference_tasks(missing: DataFrame, options: EmbeddingOptions) -> int:
    """Tasks for the inference job: all cores busy, no task without a full batch, none longer than a retry may cost."""
    texts = missing.count()
    cores = missing.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, math.ceil(texts / options.texts_per_task))
    return max(1, min(wanted, math.ceil(texts / max(1, options.batch_size))))


def read_cache(spark, path: str) -> DataFrame:
    """A cache table with one row per text, also if two runs have stored the same text."""
    return read_or_empty(spark, path, CACHE_SCHEMA).groupBy("text_hash").agg(F.first("embedding").alias("embedding"))


def cached_embeddings(
    units: DataFrame,
    cache_path: str,
    factory: ProviderFactory,
    options: EmbeddingOptions = EmbeddingOptions(),
    on_error: str = "raise",
) -> DataFrame:
    """(unit_id, embedding) for every unit, computing only what the cache table lacks.

    The content hash is the key.  Missing texts are embedded in waves of about
    ``texts_per_wave``, by a hash of the key, and each wave is committed before
    the next, so a run repeated after a failure loses one wave at most.  With
    ``on_error="record"`` refused texts go to ``<cache_path>_rejects`` and their
    units have no vector.  Vectors are joined by key, never by row position.
    """
    spark = units.sparkSession
    prepared = prepare(units, options)
    missing = materialise(missing_texts(prepared, read_or_empty(spark, cache_path, CACHE_SCHEMA)))
    waves = max(1, math.ceil(missing.count() / max(1, options.texts_per_wave)))
    for wave in range(waves):
        part = missing.where(F.pmod(F.xxhash64("text_hash"), F.lit(waves)) == wave)
        new = embed(part.repartition(inference_tasks(part, options)), factory, options.batch_size, on_error)
        if on_error == "record":
            new = materialise(new)
            refused = new.where("embedding IS NULL").select("text_hash", "error")
            refused.write.mode("append").parquet(f"{cache_path}_rejects")
        new.where("embedding IS NOT NULL").select("text_hash", "embedding").write.mode("append").parquet(cache_path)
    return prepared.select("unit_id", "text_hash").join(read_cache(spark, cache_path), "text_hash").select("unit_id", "embedding")


def embed_units(
    units: DataFrame, factory: ProviderFactory, options: EmbeddingOptions = EmbeddingOptions()
) -> DataFrame:
    """Like :func:`cached_embeddings` without a cache table: one lazy plan."""
    prepared = prepare(units, options)
    distinct = prepared.groupBy("text_hash").agg(F.first("prepared").alias("prepared"))
    vectors = embed(distinct, factory, options.batch_size).select("text_hash", "embedding")
    return prepared.select("unit_id", "text_hash").join(vectors, "text_hash").select("unit_id", "embedding")


def alignment_problems(units: DataFrame, vectors: DataFrame) -> DataFrame:
    """(unit_id, n_units, n_vectors) of every id that does not have exactly one of each."""
    named = units.select("unit_id", F.lit(1).alias("u"), F.lit(0).alias("v"))
    named = named.unionByName(vectors.select("unit_id", F.lit(0).alias("u"), F.lit(1).alias("v")))
    counted = named.groupBy("unit_id").agg(F.sum("u").alias("n_units"), F.sum("v").alias("n_vectors"))
    return counted.where("n_units <> 1 OR n_vectors <> 1")


def check_alignment(units: DataFrame, vectors: DataFrame) -> None:
    """Every unit needs exactly one vector and every vector a unit."""
    wrong = alignment_problems(units, vectors).limit(1).collect()
    if wrong:
        raise ValueError(f"units and embeddings do not match: {wrong[0].asDict()}")
