import random
import time
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import runs as pr


def slow_runs(words, min_length=24, min_periods=3):
    """All runs by trying every period; (start, length, period)."""
    best = {}
    n = len(words)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_length, min_periods * q):
                best.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def slow_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def slow_row(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    said = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    milli = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, milli, sha256(said.encode()).hexdigest(), sha256(slow_collapsed(words, runs).encode()).hexdigest())


def found(texts, **options):
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, len(ids) + 1).astype(np.uint64)
    words = hashes[np.array([ids[w] for t in texts for w in t], np.int64)] if ids else np.zeros(0, np.uint64)
    first = np.cumsum([0] + [len(t) for t in texts])
    out = [[] for _ in texts]
    for t, s, e, q in zip(*(x.tolist() for x in pr.runs_of(words, first, **options)), strict=True):
        out[t].append((s - int(first[t]), e - s, q))
    return out


def make(rng):
    """Words with planted repetitions, nested, cut off and of close periods."""
    words = []
    for _ in range(rng.randrange(1, 7)):
        kind = rng.random()
        unit = [rng.choice("abcd") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
        if kind < 0.2:
            unit = unit[:3] * rng.randrange(2, 12) + unit[-1:]
        if kind < 0.7:
            n = rng.randrange(len(unit), 6 * len(unit) + 30)
            words += [unit[i % len(unit)] for i in range(n)]
        else:
            words += [rng.choice("ab" if kind < 0.85 else "abcdefghijk") for _ in range(rng.randrange(60))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_like_brute_force(seed):
    rng = random.Random(seed)
    texts = [make(rng) for _ in range(60)] + [[], ["a"], ["a"] * 23, ["a"] * 24, list("ab") * 12, list("abc") * 7 + ["a", "b"]]
    assert found(texts) == [slow_runs(t) for t in texts]


@pytest.mark.parametrize(("min_length", "min_periods"), [(1, 3), (5, 4), (9, 3), (40, 3), (24, 6)])
def test_other_limits(min_length, min_periods):
    rng = random.Random(min_length)
    texts = [make(rng) for _ in range(40)]
    assert found(texts, min_length=min_length, min_periods=min_periods) == [slow_runs(t, min_length, min_periods) for t in texts]
    with pytest.raises(ValueError, match="three periods"):
        found(texts, min_periods=2)


def test_small_pieces_of_comparisons_change_nothing(monkeypatch):
    rng = random.Random(9)
    texts = [make(rng) for _ in range(20)]
    monkeypatch.setattr(pr, "AT_ONCE", 5)
    assert found(texts) == [slow_runs(t) for t in texts]


def test_hostile_texts_stay_fast():
    begin = time.perf_counter()
    n = 400_000
    assert found([["a"] * n]) == [[(0, n, 1)]]
    blocks = (["a"] * 999 + ["b"]) * (n // 1000)
    assert found([blocks])[0][0] == (0, 999, 1) and (0, n, 1000) in found([blocks])[0]
    morse = [bin(i).count("1") % 2 for i in range(1 << 18)]
    assert found([morse]) == [[]]
    assert time.perf_counter() - begin < 60


def test_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(make(rng)) for _ in range(60)] + [None, "", " \t\n", "one", "é\x0bé " * 40, "x" * 3000, "  " * 30]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(7, "z " * 50, "b"), (7, "z " * 50, "b"), (None, "z y " * 50, "c")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, runs string").withColumn("n", F.lit("q")).withColumn("h", F.lit(1)).withColumn("top", F.lit(2))
    got = pr.digests(pr.periodic_runs(pr.planted(docs)))
    assert dict(got.dtypes)["n_runs"] == "bigint" and [t for _, t in got.dtypes[2:6]] == ["bigint"] * 4
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((slow_row(d, t) for d, t, _ in rows), key=repr)
    kept = {r.doc_id: (r.n_words, r.collapsed) for r in pr.periodic_runs(docs.where("doc_id < 50 AND doc_id <> 7")).collect()}
    assert kept == {d: (len(split(t)), slow_collapsed(split(t), slow_runs(split(t)))) for d, t, _ in rows if d is not None and d < 50 and d != 7}
    assert pr.digests(pr.periodic_runs(docs.limit(0))).count() == 0


def test_query_on_the_given_table(spark):
    from conftest import FOLDER
    from threadlens.llm.queries import QUERIES

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op13_runs"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = {d for d, t in texts if len(split(t)) < 1500}
    assert len(small) > 0.9 * len(texts)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(texts)
    assert sorted(r for r in rows if r[0] in small) == sorted(slow_row(d, t) for d, t in texts if d in small)
