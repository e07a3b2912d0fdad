import zlib

import corpus_pipeline as cp
import numpy as np
from conftest import FOLDER, SCHEMA
from test_decontaminate import slow as slow_hits
from test_mixing import fill
from test_simhash import slow_components, slow_fingerprint
from test_token_store import ids

from threadlens.llm import language
from threadlens.llm.common import held_out, staged


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "src1", 0), (10**6 + 1, "12 !?", None, None, 5), (10**6 + 2, "", "en", "src1", 0), (10**6 + 3, docs.first().text, "en", "src1", 5)], SCHEMA)
    docs = docs.unionByName(odd)
    steps = [docs]
    for name, stage in cp.STAGES:
        steps.append(staged(stage(spark, steps[-1], FOLDER), name))
        if name != "tokens":
            assert steps[-1].columns == docs.columns
    before, said, apart, clean, mixed = (rows(s) for s in steps[:5])
    verdict = {r.doc_id: r for r in language.predict(docs, language.learn(docs.where(~held_out("doc_id", 4, 2)))).collect()}
    assert said == {d: t for d, t in before.items() if verdict[d].lang_pred != "und" and verdict[d].score >= cp.LEAST_SCORE}
    assert not {10**6, 10**6 + 1, 10**6 + 2} & set(said) and len(said) > 0.95 * len(before)
    prints = {d: slow_fingerprint(t) for d, t in said.items()}
    roots, first = slow_components(set(prints.values())), {}
    for d, f in prints.items():
        first[roots[f]] = min(d, first.get(roots[f], d))
    assert set(apart) == set(first.values()) and 10**6 + 3 not in apart
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(clean) == {d for d, *_, hit in slow_hits(list(apart.items()), items) if not hit}
    total = lambda part: sum(len(t.split()) for t in part.values())
    assert set(mixed) < set(clean) and 0.6 * total(clean) < total(mixed) <= 0.9 * total(clean)
    place = 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in steps[5].collect()}
    for d in sorted(mixed):
        own = [*ids(mixed[d]), 0]
        assert got.pop(d) == (place, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        place += len(own)
    assert not got


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_shares_add_up():
    assert sum(fill(100, {"a": (90, 3), "b": (90, 1)}).values()) == 100
