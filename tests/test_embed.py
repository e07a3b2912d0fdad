import hashlib
import sys
import tracemalloc

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from threadlens.functions.vectors import HashProvider, cosine, cosine_arrow, hash_embedding, hash_vectors
from threadlens.operators import embed
from threadlens.options import EmbeddingOptions

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def units(spark, texts):
    return spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "unit_id string, modeling_text string")


def by_hand(text, width):
    vector = [0.0] * width
    for token in text.lower().split():
        digest = hashlib.sha1(token.encode()).hexdigest()
        vector[int(digest[:8], 16) % width] += -1.0 if digest[-1] in "13579bdf" else 1.0
    length = sum(x * x for x in vector) ** 0.5
    return [x / length for x in vector] if length else [1.0] + [0.0] * (width - 1)


def test_hashing_holds_the_tokens_of_one_block():
    texts = [" ".join(f"w{i % 700}x{j}" for j in range(300)) for i in range(6000)] + [None, "", "a b"]
    tracemalloc.start()
    found = hash_vectors(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 100 << 20
    assert np.array_equal(found[:50], hash_vectors(texts[:50])) and np.array_equal(found[-3:], hash_vectors(texts[-3:]))


def test_hash_vectors(spark):
    texts = ["sql запрос", "excel отчёт Excel", "", "a b c d e f g a a", " x\x1cy"]
    assert np.allclose(hash_vectors(texts, 32), [by_hand(t, 32) for t in texts], atol=1e-6)
    assert hash_vectors(["a"], 3).shape == (1, 8)
    for token, bucket, sign in [("sql", 5, 1), ("запрос", 7, -1), ("excel", 10, 1)]:
        assert hash_vectors([token], 32)[0, bucket] == sign
    column = units(spark, texts).select(hash_embedding(F.col("modeling_text"), 32).alias("v")).collect()
    assert np.allclose([r.v for r in column], hash_vectors(texts, 32))


def test_cosine_forms_agree(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<double>")
    rows = df.select(cosine(F.col("a"), F.col("b")).alias("x"), cosine_arrow(F.col("a"), F.col("b")).alias("y")).collect()
    assert [(round(r.x, 9), round(r.y, 9)) for r in rows] == [(0.8, 0.8), (0.0, 0.0)]


def lengths(texts):
    return np.array([[float(len(t)), 1.0] for t in texts])


def test_text_choice(spark):
    df = spark.createDataFrame([(None, "plain")], "modeling_text string, text string")
    assert df.select(embed.embedding_text(df).alias("t")).first().t == ""
    assert df.drop("modeling_text").select(embed.embedding_text(df.drop("modeling_text")).alias("t")).first().t == "plain"
    with pytest.raises(ValueError):
        embed.embedding_text(df.select(F.lit(1).alias("x")))


def test_rejected_batches_are_halved():
    calls = []

    def single(texts):
        calls.append(len(texts))
        if len(texts) > 1:
            raise embed.BatchRejected("too many")
        return lengths(texts)

    vectors = [v.tolist() for v, _ in embed.embed_batch(single, ["sql", "excel", "jira"])]
    assert vectors == [[3.0, 1.0], [5.0, 1.0], [4.0, 1.0]]
    assert calls == [3, 1, 2, 1, 1]


def test_a_bad_text_is_isolated(spark):
    def factory():
        def provider(texts):
            if any("bad" in t for t in texts):
                raise embed.BatchRejected("cannot read it")
            return lengths(texts)

        return provider

    prepared = embed.prepare(units(spark, [f"text {i}" for i in range(20)] + ["bad\ntext"]))
    rows = embed.embed(prepared, factory, 8, on_error="record").collect()
    failed = [r for r in rows if r.error]
    assert len(rows) == 21 and len(failed) == 1 and failed[0].embedding is None
    assert "cannot read it" in failed[0].error
    with pytest.raises(Exception, match=f"{failed[0].text_hash}.*cannot read it"):
        embed.embed(prepared, factory, 8).collect()


def test_batches_are_full_and_sizes_checked(spark):
    def factory():
        def provider(texts):
            return np.full((len(texts), 1), float(len(texts)))

        return provider

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        prepared = embed.prepare(units(spark, [f"t{i}" for i in range(50)])).coalesce(1)
        sizes = sorted(r.embedding[0] for r in embed.embed(prepared, factory, 16).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes == [2.0] * 2 + [16.0] * 48
    with pytest.raises(ValueError, match="1 vectors for 2 texts"):
        embed.embed_batch(lambda texts: np.zeros((1, 2)), ["a", "b"])


def test_cache_embeds_each_missing_text_once(spark, tmp_path):
    seen, cache = str(tmp_path / "seen"), str(tmp_path / "cache")

    def factory():
        def provider(texts):
            with open(seen, "a", encoding="utf-8") as out:
                out.writelines(t + "\n" for t in texts)
            return lengths(texts)

        return provider

    first = embed.cached_embeddings(units(spark, ["aa", "bbb", "aa", "aa"]), cache, factory)
    assert {r.unit_id: list(r.embedding) for r in first.collect()} == {
        "u0": [2.0, 1.0], "u1": [3.0, 1.0], "u2": [2.0, 1.0], "u3": [2.0, 1.0],
    }
    second = embed.cached_embeddings(units(spark, ["bbb", "cccc"]), cache, factory)
    assert {r.unit_id: r.embedding[0] for r in second.collect()} == {"u0": 3.0, "u1": 4.0}
    assert sorted(open(seen, encoding="utf-8").read().split()) == ["aa", "bbb", "cccc"]
    wider = EmbeddingOptions(provider_params=("width=2",))
    embed.cached_embeddings(units(spark, ["aa"]), cache, factory, wider)
    assert open(seen, encoding="utf-8").read().split().count("aa") == 2


def test_a_failed_run_keeps_its_finished_waves(spark, tmp_path):
    seen, cache, texts = str(tmp_path / "seen"), str(tmp_path / "cache"), [f"text {i}" for i in range(60)]
    options = EmbeddingOptions(texts_per_wave=10, batch_size=4)

    def factory(limit):
        def build():
            def provider(batch):
                with open(seen, "a+", encoding="utf-8") as out:
                    out.seek(0)
                    if len(out.readlines()) >= limit:
                        raise ConnectionError("gone")
                    out.writelines(t + "\n" for t in batch)
                return lengths(batch)

            return provider

        return build

    with pytest.raises(Exception, match="gone"):
        embed.cached_embeddings(units(spark, texts), cache, factory(30), options)
    kept = {r.text_hash for r in embed.read_cache(spark, cache).collect()}
    assert 0 < len(kept) < 60
    again = str(tmp_path / "seen")
    before = len(open(again, encoding="utf-8").readlines())
    done = embed.cached_embeddings(units(spark, texts), cache, factory(10**9), options)
    assert done.count() == 60 and len(open(again, encoding="utf-8").readlines()) - before == 60 - len(kept)


def test_doubled_cache_rows_and_refused_texts(spark, tmp_path):
    cache = str(tmp_path / "cache")

    def factory():
        def provider(texts):
            if any("bad" in t for t in texts):
                raise embed.BatchRejected("cannot read it")
            return lengths(texts)

        return provider

    have = units(spark, ["aa", "bbb", "bad"])
    assert embed.cached_embeddings(have, cache, factory, on_error="record").count() == 2
    assert spark.read.parquet(f"{cache}_rejects").select("error").first().error.endswith("cannot read it")
    rows = spark.createDataFrame([tuple(r) for r in spark.read.parquet(cache).collect()], embed.CACHE_SCHEMA)
    rows.write.mode("append").parquet(cache)
    assert embed.cached_embeddings(units(spark, ["aa", "bbb"]), cache, factory).count() == 2


def test_counters(spark):
    df = units(spark, ["a\0b", "x" * 10, "ok", "y\0" * 10])
    row = embed.preparation_counters(df, EmbeddingOptions(max_text_chars=5)).first()
    assert (row.sanitized, row.truncated) == (2, 2)


def test_alignment(spark):
    have = units(spark, ["a", "b"])
    embed.check_alignment(have, have)
    assert embed.alignment_problems(have, have).count() == 0
    for other in (have.limit(1), have.unionByName(units(spark, ["z"]).withColumn("unit_id", F.lit("new"))), have.unionByName(have.limit(1))):
        with pytest.raises(ValueError):
            embed.check_alignment(have, other)


def test_lazy_embedding_covers_all_units(spark):
    df = units(spark, ["one two", "two three", "one two"])
    rows = embed.embed_units(df, HashProvider).collect()
    assert sorted(r.unit_id for r in rows) == ["u0", "u1", "u2"]
