import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import toxicity as tx

BAD, STEM, FINE = ["grobian", "loser", "villain"], "zqux", ["the", "red", "house", "is", "over", "there", "today", "a", "hill", "river"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(FINE) + rng.choice(["", "s", "ly"]) for _ in range(rng.randrange(20, 60))]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice([*BAD, STEM + rng.choice("abcde") + "ing"])
        if i % 10 == 1:
            words[3:5] = ["lovable", "villain"]
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").withColumn("toxic", F.lit("clash"))
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i < 320] + [(None, 1), (5, None), (0, 0)], "doc_id bigint, toxic int").withColumn("text", F.lit(0))
    return rows, docs, labels, tx.learn(docs, labels)


def test_folding():
    assert tx.fold("Lоsеr") == tx.fold("loser") == tx.fold("L0S3R") == tx.fold("lo​ser") == tx.fold("ＬＯＳＥＲ") == tx.fold("lösér") == tx.fold("𝓵𝓸𝓼𝓮𝓻")
    assert tx.fold("$cum @ss") == tx.fold("scum ass") and tx.fold("5$") == "s$" and tx.fold(None) == ""


def test_lexicon(learned):
    *_, lexicon = learned
    assert {tx.fold(w) for w in ("grobian", "loser")} <= set(lexicon.weights)
    assert any(w.endswith("*") and STEM.startswith(w[:4]) for w in lexicon.weights)
    assert not {w for w in lexicon.weights if w.rstrip("*") in {f for b in FINE for f in (b, b + "s", b + "iy")}}


def test_matches_like_brute_force(learned):
    *_, lexicon = learned
    automaton, rng = lexicon.automaton(), random.Random(4)
    for _ in range(200):
        text = tx.fold("".join(rng.choice([*BAD, STEM, "a", " ", " ", "-", "é", "L0SER", "1"]) for _ in range(30)))
        want = []
        for m in re.finditer(r"[^\W\d_]+", text):
            word = m[0]
            hits = [t for t in lexicon.weights if t == word or (t.endswith("*") and word.startswith(t[:-1]) and len(word) >= len(t))]
            if hits:
                want.append(max(lexicon.weights[t] for t in hits))
        got = [lexicon.weights[t] for _, t, _ in tx.matches(text, automaton, lexicon.weights)]
        assert got == want


def test_scores_of_held_out_rows_and_disguises(learned, spark):
    rows, docs, _, lexicon = learned
    got = {r.doc_id: r for r in tx.toxicity(docs, lexicon).collect()}
    wrong = [i for i, _, t in rows if i >= 320 and got[i].predicted != t]
    assert len(wrong) <= 2 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    base = "the red house is over there "
    odd = [(1, base + "you l0ser, gr0biаn"), (2, base + "lovable villain"), (3, None), (4, ""), (4, ""), (None, base), (5, "closers " * 50), (6, "x" * 300_000 + " loser")]
    odd = {r.doc_id: r for r in tx.toxicity(spark.createDataFrame(odd, "doc_id bigint, text string"), lexicon).collect()}
    assert [odd[i].predicted for i in (1, 2, 3, 4, None, 5)] == [1, 0, 0, 0, 0, 0]


def test_exceptions_are_learned(learned):
    *_, lexicon = learned
    if tx.fold("villain") in lexicon.weights:
        assert any(tx.fold("villain") in p for p in lexicon.exceptions)


def test_copies_count_once(spark):
    rows = corpus(200, seed=2)
    copied = " ".join(f"{chr(97 + i % 26)}word{chr(97 + i // 26)}" for i in range(60))
    rows += [(1000 + i, copied, 1) for i in range(80)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    assert not any("word" in w for w in tx.learn(docs, labels).weights)


def test_empty_tables(spark, learned):
    _, docs, labels, lexicon = learned
    assert tx.toxicity(docs.limit(0), lexicon).count() == 0
    none = tx.learn(docs, labels.limit(0))
    assert not none.weights and {r.score for r in tx.toxicity(docs, none).collect()} == {0.0}


def test_curve_grows_with_weight():
    total = np.array([0.0, 0, 0, 5, 10, 20])
    a, b, c = tx.fit_curve(total, total / 2, np.array([0.0, 0, 0, 1, 1, 1]))
    assert a < 0 < b + c
