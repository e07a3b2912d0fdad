import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from threadlens.llm import graph, simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)] if k else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if bin(a ^ b).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {f: find(f) for f in parent}


@pytest.mark.parametrize("text", ["", None, " \n", "One", "one TWO", "a b c", "Ä b c d  e\x0bf", "x " * 70_000, "a b c d " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == (slow_fingerprint(text) if text is None or len(text) < 1000 else simhash.fingerprint("x x x x"))


def test_thresholds_sum_to_the_budget_and_prefer_rare_keys():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 300).astype(np.uint64)
    groups = [list(range(i, 64, 3)) for i in range(3)]
    near = []
    for hs in simhash._halves(groups):
        near.append([])
        for h in hs:
            own = simhash.extract(fps, h)
            values = np.arange(1 << len(h))
            gaps = np.bitwise_count(own[:, None] ^ values[None, :])
            near[-1].append(np.stack([(gaps == d).mean(axis=0) for d in range(3)], axis=1))
    found = simhash.thresholds(fps, 1_000_000_000, groups, near, 2)
    assert (found.sum(axis=1) == 0).all() and found.min() >= -1


def random_fps(seed):
    rng = random.Random(seed)
    fps = [0]
    for _ in range(40):
        base = rng.getrandbits(64) if rng.random() < 0.5 else rng.choice(fps)
        for _ in range(rng.randrange(1, 12)):
            for _ in range(rng.randrange(4)):
                base ^= 1 << rng.randrange(64)
            fps.append(base)
    return sorted(set(fps))


@pytest.mark.parametrize(("seed", "bucket", "parts"), [(1, 256, 3), (2, 1, 3), (3, 3, 2), (4, 256, 2), (5, 2, 4)])
def test_links_connect_like_brute_force(spark, seed, bucket, parts):
    fps = random_fps(seed)
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp bigint"), bucket=bucket, parts=parts)
    for a, b in links.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    got = {r.node: r.root for r in graph.components(links).collect()}
    want = slow_components(fps)
    size = Counter(want.values())
    groups = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    to = {f: int(np.uint64(f).astype(np.int64)) for f in fps}
    assert groups(got) == groups({to[f]: to[r] for f, r in want.items() if size[r] > 1})


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(1500, 1500 + i) for i in range(60)] + [(9007, 9007), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1300)} == {1000}
    assert {got[i] for i in range(1500, 1560)} == {1500} and 9007 not in got
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(5, long, 1), (3, long + " \n", 2), (9, "", 3), (4, None, 4), (8, "other words here", 5), (8, "other words here", 5), (None, long, 6), (11, "Ein Satz", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int").withColumn("component_id", F.lit("x"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    want = sorted((d is None, d or 0, f"{slow_fingerprint(t):016x}", {5: 3, 3: 3, 9: 4, 4: 4, 8: 8, None: 3, 11: 11}[d]) for d, t, _ in rows)
    assert got == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 8, 11]
    assert simhash.keep_first(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_told_apart(spark):
    rows = [(2, "one clean text of its own", "a"), (2, "another text about boats", "b"), (7, "another text about boats", "c"), (7, "the sea is wide", "d"),
            (None, "the sea is wide", "e"), (None, "nobody knows me", "f"), (None, "nobody knows me", "f"), (None, "nor me at all", "g"), (9, None, "h"), (9, "", "i")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, `row` string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1)).withColumn("__id", F.lit(2))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(r.row for r in kept.collect())
    assert got in (["a", "b", "d", "f", "g", "h"], ["a", "b", "d", "f", "g", "i"])


def test_query_on_the_given_table(spark):
    from conftest import FOLDER
    from threadlens.llm.queries import QUERIES

    texts = {r.doc_id: slow_fingerprint(r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    roots = slow_components(set(texts.values()))
    first = {}
    for d, f in texts.items():
        first[roots[f]] = min(d, first.get(roots[f], d))
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, FOLDER).collect()}
    assert got == {(d, f"{f:016x}", first[roots[f]]) for d, f in texts.items()}
