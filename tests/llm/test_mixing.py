import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadlens.llm import mixing as mx

WEIGHTS = {"domain": "CASE domain WHEN 'a' THEN 3 WHEN 'z' THEN 0 ELSE 1 END", "lang": "CASE lang WHEN 'en' THEN 2 ELSE 1 END", "source": "length(source)"}
WEIGH = [lambda d: {"a": 3, "z": 0}.get(d, 1), lambda x: 2 if x == "en" else 1, len]


def fill(budget, nodes):
    """Shares by filling one node after another; nodes: name -> (room, weight)."""
    left, out, open_ = budget, {}, dict(nodes)
    order = sorted(nodes, key=lambda n: (nodes[n][0] / nodes[n][1], n))
    for n in order:
        room, weight = open_[n]
        if room * sum(w for _, w in open_.values()) <= left * weight:
            out[n], left = room, left - room
            del open_[n]
        else:
            break
    total, sofar = sum(w for _, w in open_.values()), 0
    for n in [n for n in order if n in open_]:
        w = open_[n][1]
        out[n] = left * (sofar + w) // total - left * sofar // total
        sofar += w
    return out


def slow_shares(leaves, budget, epochs):
    rooms = {p: have * epochs for p, have in leaves.items() if WEIGH[0](p[0])}
    shares = {(): budget}
    for depth in range(3):
        nxt = {}
        for parent, given in shares.items():
            kids = {}
            for p, room in rooms.items():
                if p[:depth] == parent:
                    kids.setdefault(p[: depth + 1], [0, WEIGH[depth](p[depth])])[0] += room
            nxt |= fill(given, {k: tuple(v) for k, v in kids.items()})
        shares = nxt
    return {p: shares.get(p, 0) for p in leaves}


def slow_copies(rows, budget_share, epochs, seed):
    leaves = {}
    for d, path, n in rows:
        leaves[path] = leaves.get(path, 0) + n
    shares = slow_shares(leaves, int(sum(leaves.values()) * budget_share), epochs)
    out = []
    for path, have in leaves.items():
        passes = shares[path] // have if have else 0
        rest = shares[path] - passes * have
        place = lambda d: int(hashlib.md5(f"{seed}:{passes}:{'' if d is None else d}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        own = [(place(d), d, n) for d, p, n in rows if p == path]
        for at, d, n in own:
            reached = sum(m for other, _, m in own if other <= at)
            out.append((d, *path, n, passes + int(rest > 0 and reached <= rest)))
    return sorted(out, key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "s" if rng.random() < 0.4 else rng.choice(["ss", "t", "uuuu", None])
        rows.append((i, rng.choice(["", None, "w"]) if rng.random() < 0.1 else "w\n" * rng.randrange(1, 40), rng.choice(["en", "en", "de", None]), source, rng.choice(["a", "b", "z", None])))
    return rows + [rows[0], rows[0], (None, "x y", "en", "s", "a"), (10**6, "w " * 3000, "de", "t", "b")]


@pytest.mark.parametrize(("seed", "budget_share", "epochs"), [(1, 1.0, 2), (2, 0.3, 1), (3, 5.0, 2), (4, 0.0, 1), (5, 0.9, 1), (6, 1.7, 3)])
def test_like_brute_force(spark, seed, budget_share, epochs):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kind string").withColumn("n_copies", F.lit("x")).withColumn("share", F.lit(1))
    got = sorted((tuple(r) for r in mx.mix(docs, "kind", WEIGHTS, budget_share, epochs, seed).collect()), key=repr)
    none = lambda x: "(none)" if x is None else x
    want = slow_copies([(d, (none(k), none(la), none(s)), len((t or "").split())) for d, t, la, s, k in rows], budget_share, epochs, seed)
    assert got == want
    taken = sum(n * c for *_, n, c in got)
    assert taken <= sum(n for *_, n, _ in got) * budget_share
    back = mx.mixed(docs, "kind", WEIGHTS, budget_share, epochs, seed)
    assert back.columns == docs.columns and back.count() == sum(r[-1] for r in got)


def test_shortage_goes_to_siblings_first(spark):
    rows = [("a", "en", "x", 10), ("a", "en", "y", 1000), ("a", "de", "x", 1000), ("b", "en", "x", 5000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, have bigint")
    even = dict.fromkeys(mx.TREE, "1")
    got = {(r.domain, r.lang, r.source): r.share for r in mx.allot(leaves, 2000, even, 1).collect()}
    assert got == {("a", "en", "x"): 10, ("a", "en", "y"): 490, ("a", "de", "x"): 500, ("b", "en", "x"): 1000}
    got = {(r.domain, r.lang, r.source): r.share for r in mx.allot(leaves, 6000, even, 1).collect()}
    assert got == {("a", "en", "x"): 10, ("a", "en", "y"): 1000, ("a", "de", "x"): 1000, ("b", "en", "x"): 3990}


def test_shares_of_large_numbers(spark):
    rows = [(f"d{i}", "en", "x", 10**15 + i) for i in range(50)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, have bigint")
    got = [r.share for r in mx.allot(leaves, 10**16 + 7, {"domain": "7", "lang": "1", "source": "1"}, 2).collect()]
    assert sum(got) == 10**16 + 7 and max(got) - min(got) <= 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert mx.mix(docs, "source", WEIGHTS, 1.0, 1, 1).count() == 0
