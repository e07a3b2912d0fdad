import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadlens.llm import language as lg
from threadlens.llm.gru import Network, padded, turned

SYLLABLES = {"aa": ["ka", "ru", "ti", "mo"], "bb": ["sch", "ein", "ung", "ßer"], "cc": ["éau", "oir", "què", "ment"]}


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    say = lambda lang: " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 40)))
    return [(i, say(lang), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


def test_backpropagation_through_time():
    network = Network.fresh(3, 4, 1, np.float64)
    rows, lengths = padded([b"ab", b"abcdef", b"z", b""])
    target, weight = np.array([0, 1, 2, 1]), np.array([1.0, 0.5, 2.0, 1.0])
    _, grads = network.loss(rows, lengths, target, weight)
    rng = np.random.default_rng(2)
    for p, g in zip(network.parameters(), grads, strict=True):
        places = [tuple(rng.integers(0, s) for s in p.shape) for _ in range(12)] + [np.unravel_index(np.abs(g).argmax(), g.shape)]
        for place in places:
            old = p[place]
            p[place] = old + 1e-5
            high, _ = network.loss(rows, lengths, target, weight)
            p[place] = old - 1e-5
            low, _ = network.loss(rows, lengths, target, weight)
            p[place] = old
            assert g[place] == pytest.approx((high - low) / 2e-5, abs=1e-7)


def test_turning_twice_is_nothing():
    rows, lengths = padded([b"abc", b"x", b"hello"])
    assert (turned(turned(rows, lengths), lengths) == rows).all() and bytes(turned(rows, lengths)[0, :5]) == b"\0cba\0"


def test_labels_do_not_depend_on_the_batch():
    network = Network.fresh(3, 8, 5)
    words = [b"a", b"abc", "äöü".encode(), b"x" * 24, b"abc"]
    together, alone = lg.word_labels(network, words), np.concatenate([lg.word_labels(network, [w]) for w in words])
    assert np.allclose(together, alone, atol=1e-4)


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(0))
    return rows, docs, lg.learn(docs.where("doc_id < 100"))


def test_held_out_accuracy_and_document_pooling(learned):
    rows, docs, model = learned
    assert model.languages == sorted(SYLLABLES)
    got = {r.doc_id: r for r in lg.predict(docs, model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows if i >= 100) >= 48
    for i, text, _ in rows[:20]:  # by the letter: label every byte of every word, then pool
        pieces = [w.encode() for w in text.lower().split()]
        logs, n = np.zeros(3), 0
        for w in (p[j : j + 24] for p in pieces for j in range(0, len(p), 24)):
            place = model.network.positions(*padded([w]))[0, 1 : len(w) + 1]
            logs, n = logs + place.sum(axis=0), n + len(w)
        chance = np.exp(logs / n) / np.exp(logs / n).sum()
        assert got[i].lang_pred == model.languages[chance.argmax()] and got[i].score == pytest.approx(chance.max(), abs=1e-4)


def test_odd_rows(learned, spark):
    _, docs, model = learned
    rows = [(1, None), (2, ""), (3, "12 !? –"), (4, "ka" * 100_000), (4, "ka ru"), (4, "ka ru"), (None, "EIN UNG"), (5, "😀"), (6, "5 ka")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in lg.predict(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()]
    assert sorted(got, key=repr)[0][0] == 1 and len(got) == len(rows)
    by = {d: (lang, s) for d, lang, s in got}
    assert by[1] == by[2] == by[3] == by[5] == ("und", 0.0)
    assert by[4][0] == by[6][0] == "aa" and by[None][0] == "bb" and all(0 <= s <= 1 for _, _, s in got)
    assert lg.predict(docs.limit(0), model).count() == 0
    none = lg.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert none.network is None and {r.lang_pred for r in lg.predict(docs, none).collect()} == {"und"}


def test_memory_forgets_without_changing_labels(learned, monkeypatch):
    _, _, model = learned
    monkeypatch.setattr(lg, "REMEMBERED", 3)
    memory = lg._Memory(model.network)
    for text in ("ka ru ti mo sch", "ka ein ung ka", "ru ru"):
        data, starts, ends, _ = lg._words(pa.RecordBatch.from_pydict({"text": [text]}))
        got = memory.of(lg.hash_words(data, starts, ends), data, starts, ends)
        assert np.allclose(got, lg.word_labels(model.network, [w.encode() for w in text.split()]), atol=1e-4)
