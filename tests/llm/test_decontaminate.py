import random
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import decontaminate as dc


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (got := windows.get(tuple(w[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    found |= got
        out.append((doc, len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def got(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)).withColumn("row", F.lit("x"))
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(0)).withColumn("lead", F.lit(0))
    return d, sorted((tuple(r) for r in dc.contamination(d, b, **more).collect()), key=repr)


def test_winnowing_keeps_one_of_every_window():
    rng = np.random.default_rng(3)
    hashes, last = rng.integers(0, 5, 200).astype(np.uint64), np.repeat([90, 200], [90, 110])
    kept = set(dc.winnow(hashes, last, 6).tolist())
    for i in range(195):
        if i + 6 <= last[i]:
            assert kept & set(range(i, i + 6))
    assert len(dc.winnow(hashes[:4], last[:4], 6)) == 0


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "é", "ß9", "it's", "x-y", "LONGERTHANEIGHTBYTES", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([30, 12, 10, 9, 5, 5, 40, 11])] + [(1, text(14)), (None, text(10)), (70, ""), (71, None), (72, " ,;")]
    docs = []
    for d in range(40):
        pieces = [text(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            item = rng.choice(items)[1] or ""
            cut = item.split(" ")[rng.randrange(3) : len(item) - rng.randrange(3)]
            pieces += [", ".join(cut).upper() if rng.random() < 0.3 else "\n".join(cut), text(rng.randrange(9))]
        docs.append((d, " ".join(pieces)))
    docs += [(3, docs[3][1]), (None, items[0][1]), (None, "a clean text"), (None, "a clean text"), (5, "a clean text under another's id"), (5, items[0][1]), (90, ""), (91, None), (92, "--"), (93, "w " * 5000 + items[0][1])]
    frame, found = got(spark, docs, items)
    assert found == slow(docs, items)
    kept = dc.drop_contaminated(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    clean = [(d, t) for d, t in docs if not slow([(d, t)], items)[0][5]]
    assert kept.columns == frame.columns and sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, clean))


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b")])[1] == []
    assert got(spark, [(1, "a b")], [])[1] == slow([(1, "a b")], [])


def test_a_filter_without_use_changes_nothing(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(5)]
    docs = [(i, "the " * i + items[i % 5][1] + " end") for i in range(12)]
    monkeypatch.setattr(dc, "FILTER_BITS", 7)
    assert got(spark, docs, items)[1] == slow(docs, items)
