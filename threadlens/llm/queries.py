"""Registered queries of the training-data operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, extract, hard_negatives, language, lm, mixing, quality, runs, secret_scan, sharding, simhash, token_store, toxicity
from .common import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    sized AS (SELECT item, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0),
    asked AS (SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM sized)),
    said AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS g
             FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT k FROM sized) WHERE len(w) >= k)),
    hits AS (SELECT r, item, s, said.k AS k FROM said JOIN asked ON said.g = asked.g AND said.k = asked.k),
    places AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT r, s, k FROM hits)) GROUP BY r),
    items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(places.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN places ON places.r = d.r LEFT JOIN items ON items.r = d.r
    """
)
def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, folder, "documents")))


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = held_out("doc_id", 5, 0).alias("held_out")
    lexicon = toxicity.learn(docs, labels.where(~held_out("doc_id", 5, 0)))
    return toxicity.toxicity(docs, lexicon).select("doc_id", held, "score", "predicted", "n_matches")


@query()
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.learn(docs.where(~held_out("doc_id", 4, 2)))
    return language.predict(docs, model).withColumn("held_out", held_out("doc_id", 4, 2))


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    store = token_store.write_store(docs, tokenizer_path())
    return store.checksums(token_store.keys_of(docs)).select("doc_id", "start", "n_tokens", "ids_crc32")


#: Target weights of the mix: sources are dealt to four domains by their number.
DOMAIN = "concat('domain', try_cast(regexp_extract(source, '[0-9]+', 0) AS BIGINT) % 4)"
WEIGHTS = {
    "domain": "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END",
    "lang": "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END",
    "source": "1",
}


def _shares_sql(level: str, above: str, path: str, parent: str, weight: str) -> str:
    """Shares of the nodes of one level in DuckDB; ``above`` has the parents' shares as ``given``."""
    over = f"PARTITION BY {parent} ORDER BY" if parent else "ORDER BY"
    every = f"PARTITION BY {parent}" if parent else ""
    return f"""
    {level}_a AS (SELECT {path}, sum(room)::HUGEINT AS room, CAST({weight} AS HUGEINT) AS weight FROM leaves GROUP BY {path}),
    {level}_b AS (SELECT n.*, given::HUGEINT AS given FROM {level}_a n {f'JOIN {above} USING ({parent})' if parent else f'CROSS JOIN {above}'}),
    {level}_c AS (SELECT *, given - coalesce(sum(room) OVER ({over} room::DOUBLE / weight::DOUBLE, {path} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
        sum(weight) OVER ({over} room::DOUBLE / weight::DOUBLE, {path} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy FROM {level}_b),
    {level}_d AS (SELECT *, room * heavy <= free * weight AS filled FROM {level}_c),
    {level}_e AS (SELECT *, given - sum(CASE WHEN filled THEN room ELSE 0 END) OVER ({every}) AS rest, sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({every}) AS thirst,
        sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({over} room::DOUBLE / weight::DOUBLE, {path} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sofar FROM {level}_d),
    {level} AS (SELECT {path}, CASE WHEN filled THEN room ELSE (rest::HUGEINT * sofar::HUGEINT) // thirst::HUGEINT - (rest::HUGEINT * (sofar - weight)::HUGEINT) // thirst::HUGEINT END AS given FROM {level}_e),"""


@query(
    rf"""
    WITH docs AS (SELECT doc_id, coalesce('domain' || (TRY_CAST(regexp_extract(source, '[0-9]+') AS BIGINT) % 4), '(none)') AS domain, coalesce(lang, '(none)') AS lang,
        coalesce(source, '(none)') AS source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS n_tokens FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS have, 2 * sum(n_tokens)::HUGEINT AS room FROM docs GROUP BY ALL),
    budget AS (SELECT sum(have) AS given FROM leaves),
    {_shares_sql("level1", "budget", "domain", "", WEIGHTS["domain"])}
    {_shares_sql("level2", "level1", "domain, lang", "domain", WEIGHTS["lang"])}
    {_shares_sql("level3", "level2", "domain, lang, source", "domain, lang", WEIGHTS["source"])}
    plan AS (SELECT domain, lang, source, CASE WHEN have > 0 THEN given // have ELSE 0 END AS passes, CASE WHEN have > 0 THEN given - (given // have) * have ELSE given END AS rest
             FROM leaves JOIN level3 USING (domain, lang, source)),
    placed AS (SELECT docs.*, passes, rest, CAST('0x' || substr(md5(concat_ws(':', '11', CAST(passes AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 15) AS BIGINT) AS place
               FROM docs JOIN plan USING (domain, lang, source)),
    run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached FROM placed)
    SELECT doc_id, domain, lang, source, n_tokens, CAST(passes + CASE WHEN rest > 0 AND reached <= rest THEN 1 ELSE 0 END AS BIGINT) AS n_copies FROM run
    """
)
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), DOMAIN, WEIGHTS, budget_share=1.0, epochs=2, seed=11)


@query()
def op5_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return lm.score_texts(docs.withColumn("held_out", held_out("doc_id", 7, 2)), over_blanks=True)


@query()
def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract.extract(pages, extract.learn(pages))


@query(
    """
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, v.r AS r, v.vec_id AS vec_id, v.label = a.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
          FROM v AS a CROSS JOIN v WHERE a.vec_id % 100 = 0 AND a.r <> v.r),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.vec_id NULLS LAST, s.r) AS INT) AS rank,
              s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
          FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
    SELECT * FROM n WHERE rank <= 5
    """
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label")
    # Unlike floor of a double, which is a whole number, infinity stays what it is and is sorted out by the operator.
    whole = "transform(embedding, x -> CASE WHEN isnan(x) OR abs(x) = double('infinity') THEN x ELSE CAST(floor(256 * CAST(x AS double)) AS double) END)"
    vectors = table(spark, folder, "embeddings").select("vec_id", label, F.expr(whole).alias("embedding"))
    return hard_negatives.mine(vectors, "vec_id % 100 = 0", n_positives=5, n_negatives=5, share=(80, 100))


@query()
def op12_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), 24)


@query()
def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.planted(table(spark, folder, "documents"))))
