"""Topic enrichment: one request per topic, injected provider, cache, fallback."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import strip_text
from ..options import EnrichmentOptions
from ..session import materialise
from .embed import read_or_empty
from .terms import ranked_lists
from .topics import OUTLIER

# A provider maps a request payload to a mapping (or to the raw response text).
EnrichProvider = Callable[[dict], object]
EnrichFactory = Callable[[], EnrichProvider]

COLUMNS = fixed.ENRICHMENT_COLUMNS
RESULT_SCHEMA = "topic_id int, " + ", ".join(f"{name} string" for name in COLUMNS)


# --- small per-row helpers ------------------------------------------------------

OBJECT_START = re.compile(r"\{\s*[\"}]")
# How a decoded JSON value is stored as text, by its type; every other type by ``str``.
STORED = {
    type(None): lambda value: None,
    str: str.strip,
    dict: lambda value: json.dumps(value, ensure_ascii=False, sort_keys=True),
    list: lambda value: "; ".join(filter(None, map(flatten, value))),
}


def flatten(value: object) -> str | None:
    return STORED.get(type(value), str)(value)


def first_object(reply: str) -> dict:
    """The first JSON object in a reply, whatever stands around it."""
    decoder = json.JSONDecoder()
    for start in OBJECT_START.finditer(reply):
        try:
            return decoder.raw_decode(reply, start.start())[0]
        except (ValueError, RecursionError):
            continue
    raise ValueError(f"no JSON object in a reply of {len(reply)} characters")


def enrichment_row(reply: object) -> dict[str, str | None]:
    decoded = first_object(reply) if isinstance(reply, str) else reply
    return {name: flatten(decoded.get(name)) for name in COLUMNS}


def parse_responses(responses: DataFrame) -> DataFrame:
    """(key..., response) -> (key..., 7 text columns, parse_error); a bad reply keeps its row."""
    keys = [field for field in responses.schema.fields if field.name != "response"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keys] + [f"{c} string" for c in COLUMNS])

    def parse(text: str) -> dict[str, str | None]:
        try:
            return {**enrichment_row(text or ""), "parse_error": None}
        except ValueError as error:
            return {**dict.fromkeys(COLUMNS), "parse_error": str(error)}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parsed = pd.DataFrame(list(map(parse, frame["response"])), columns=[*COLUMNS, "parse_error"], dtype=object)
            yield pd.concat([frame.drop(columns="response").reset_index(drop=True), parsed], axis=1)

    return responses.mapInPandas(run, f"{schema}, parse_error string")


# --- requests ---------------------------------------------------------------------


def topic_requests(summary: DataFrame, examples: DataFrame, max_examples: int = 12) -> DataFrame:
    """Summary fields plus up to ``max_examples`` example texts per topic, best first.

    Outliers are not sent out.
    """
    chosen = examples.where(F.col("example_rank") <= max_examples).select(
        "topic_id", F.col("example_rank").alias("rank"), "text"
    )
    texts = ranked_lists(chosen, "text", "examples")
    empty = F.array().cast("array<string>")
    return (
        summary.where(F.col("topic_id") != OUTLIER)
        .select("topic_id", "topic_keywords", "topic_title_auto", "n_units", "n_users", "n_chats")
        .join(texts, "topic_id", "left")
        .withColumn("examples", F.coalesce("examples", empty))
    )


def payload_json() -> Column:
    return F.to_json(
        F.struct("topic_id", "topic_keywords", "topic_title_auto", "n_units", "n_users", "n_chats", "examples")
    )


def chat_request(requests: DataFrame, model: str, temperature: float = 0.0) -> DataFrame:
    """(topic_id, request): the body of a chat request for each topic."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = F.struct(
        F.lit(model).alias("model"),
        F.lit(temperature).alias("temperature"),
        F.array(message("system", F.lit(fixed.SYSTEM_PROMPT)), message("user", payload_json())).alias("messages"),
    )
    return requests.select("topic_id", F.to_json(body).alias("request"))


def request_key(options: EnrichmentOptions) -> Column:
    """Content hash of a request under one model, prompt and temperature."""
    identity = [options.model, str(options.temperature), fixed.SYSTEM_PROMPT]
    return F.sha1(F.concat_ws("::", *[F.lit(part) for part in identity], payload_json()))


# --- providers --------------------------------------------------------------------


def title_case(text: Column) -> Column:
    """Every run of letters with its first letter raised and the others lowered."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def mock_answers(requests: DataFrame) -> DataFrame:
    """Deterministic enrichment that needs no model: columns of the requests, put into fixed texts."""
    word = strip_text(F.substring_index("topic_keywords", ",", 1))
    number, shown = F.col("topic_id").cast("string"), F.size("examples").cast("string")
    title = title_case(F.when(word != "", word).otherwise(F.concat(F.lit("Topic "), number)))

    def said(template: str) -> Column:
        return F.replace(F.replace(F.lit(template), F.lit("{0}"), number), F.lit("{1}"), shown)

    texts = [said(fixed.MOCK_TEXTS[name]).alias(name) for name in COLUMNS if name in fixed.MOCK_TEXTS]
    return requests.select("topic_id", title.alias("topic_title"), *texts).select("topic_id", *COLUMNS)


def call_provider(requests: DataFrame, factory: EnrichFactory) -> DataFrame:
    """(topic_id, payload, title) -> enrichment columns plus ``status`` (ok or fallback).

    A topic whose call or reply fails gets placeholder texts and the run goes on.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()

        def answer(topic_id: int, payload: str, title: str) -> dict:
            try:
                return {"topic_id": topic_id, **enrichment_row(provider(json.loads(payload))), "status": "ok"}
            except Exception as error:  # noqa: BLE001 - any provider failure becomes a fallback row
                reason = f"{type(error).__name__}: {error}"
                texts = {name: text.format(topic_id, reason) for name, text in fixed.FALLBACK_TEXTS.items()}
                return {"topic_id": topic_id, "topic_title": title.strip(), **texts, "status": "fallback"}

        for frame in frames:
            rows = [answer(*row) for row in zip(frame["topic_id"], frame["payload"], frame["title"])]
            yield pd.DataFrame(rows, columns=["topic_id", *COLUMNS, "status"])

    wanted = requests.select("topic_id", payload_json().alias("payload"), F.col("topic_title_auto").alias("title"))
    # One row per topic: few bytes but slow calls, so they are dealt out to all cores.
    dealt = wanted.repartition(wanted.sparkSession.sparkContext.defaultParallelism)
    return dealt.mapInPandas(run, RESULT_SCHEMA + ", status string")


def no_enrichment(summary: DataFrame) -> DataFrame:
    """Topic ids with seven nulls: enrichment disabled, missing, or an outlier topic."""
    return summary.select("topic_id", *[F.lit(None).cast("string").alias(name) for name in COLUMNS])


def enrich_topics(
    summary: DataFrame,
    examples: DataFrame,
    factory: EnrichFactory | None = None,
    options: EnrichmentOptions = EnrichmentOptions(),
    cache_path: str | None = None,
) -> DataFrame:
    """One enrichment row per topic of the summary, by ``factory`` or by the fixed answers.

    A provider is called once per topic: its answers are written out before they
    are used.  With a cache table, only requests that have no successful answer yet are
    sent; fallbacks are never stored, so a passing failure is retried next time.
    """
    if not options.enabled:
        return no_enrichment(summary)
    outliers = no_enrichment(summary.where(F.col("topic_id") == OUTLIER))
    requests = topic_requests(summary, examples, options.max_examples_per_topic)
    if factory is None:
        return mock_answers(requests).unionByName(outliers)
    if cache_path is None:
        return materialise(call_provider(requests, factory)).drop("status").unionByName(outliers)
    spark = summary.sparkSession
    schema = "request_hash string, " + RESULT_SCHEMA
    keyed = requests.withColumn("request_hash", request_key(options))
    cache = read_or_empty(spark, cache_path, schema).dropDuplicates(["request_hash"])
    todo = keyed.join(cache.select("request_hash"), "request_hash", "left_anti")
    answered = call_provider(todo, factory).join(keyed.select("topic_id", "request_hash"), "topic_id")
    fresh = materialise(answered)
    stored = fresh.where("status = 'ok'").drop("status")
    stored.select("request_hash", "topic_id", *COLUMNS).write.mode("append").parquet(cache_path)
    hits = keyed.select("topic_id", "request_hash").join(cache.drop("topic_id"), "request_hash").drop("request_hash")
    return hits.unionByName(fresh.drop("status", "request_hash")).unionByName(outliers)

