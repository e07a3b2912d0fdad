import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadlens.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<double>"


def slow(rows, share=(80, 100), k=5):
    sound = [(i, v, la, e) for i, (v, la, e) in enumerate(rows) if la is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dot = lambda a, b: int(sum(x * y for x, y in zip(a, b)))  # noqa: E731, B905
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, v, la, e in sound:
        if v is None or v % 100:
            continue
        scored = [(dot(e, f), w, lb, j) for j, w, lb, f in sound if j != i]
        positives = sorted((s for s in scored if s[2] == la), key=order)[:k]
        for p, w, *_ in positives:
            window = [s for s in scored if s[2] != la and share[0] * p <= share[1] * s[0] <= share[1] * p]
            out += [(v, w, n, x, p, s) for n, (s, x, *_) in enumerate(sorted(window, key=order)[:k], 1)]
    return sorted(out, key=repr)


def vectors(seed, n=500, dim=6, spread=40):
    rng = random.Random(seed)
    centres = [[rng.randrange(-100, 100) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        at = rng.randrange(4)
        point = [float(c + rng.randrange(-spread, spread)) for c in centres[at]]
        rows.append((i * 20, rng.choice([at, at, at, (at + 1) % 4]), centres[0] and list(map(float, centres[0])) if rng.random() < 0.2 else point))
    return rows


ODD = [(None, 1, [90.0] * 6), (5, None, [1.0] * 6), (7, 1, None), (8, 1, [1.0, None, 1.0]), (9, 2, [float("nan")] * 6), (11, 2, [float("inf")] + [0.0] * 5), (300, 2, [50.0, 50.0]), (400, 1, []), (500, 3, [-9.0] * 6)]


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("anchor", F.lit("y")).withColumn("rank", F.lit(1))
    got = hn.mine(frame.repartition(5), "vec_id % 100 = 0", **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_like_brute_force(spark, seed, monkeypatch):
    rows = vectors(seed) + ODD
    if seed > 1:
        monkeypatch.setattr(hn, "BLOCK", 7)
        monkeypatch.setattr(hn, "CHUNK", 11)
        monkeypatch.setattr(hn, "HELD_BYTES", 2000)
    assert mined(spark, rows) == slow(rows)
    if seed == 1:
        assert mined(spark, rows, share=(100, 100)) == slow(rows, (100, 100))


def test_repeated_rows_and_one_vector_everywhere(spark):
    rows = [(i, i % 2, [3.0, 4.0]) for i in range(150)] + [(100, 0, [3.0, 4.0])] * 3 + [(7, 1, [3.0, 4.0])] * 2
    assert mined(spark, rows) == slow(rows)


def test_nothing_to_find(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0]), (2, 0, [1.0])]) == []
    assert mined(spark, [(i, 1, [1.0]) for i in range(0, 300, 50)]) == []
    with pytest.raises(ValueError, match="positive"):
        mined(spark, [], share=(0, 1))


def test_bounds_leave_out_candidates_and_lose_none():
    """Far candidates are never scored for the children of an anchor that shows them to be far."""
    rng = np.random.default_rng(4)
    anchors = rng.integers(-3, 4, (40, 8)) + 1000.0
    order, parent, edges = hn.spanning_tree(anchors)
    assert sorted(order) == list(range(40)) and parent[order[0]] == -1
    assert math.isclose(edges.sum(), slow_tree(anchors))
    near, far = rng.integers(-3, 4, (5, 8)) + 1000.0, rng.integers(-3, 4, (900, 8)) * 1.0
    points = np.concatenate([near, far])
    place = {int(o): i for i, o in enumerate(order)}
    rows = [{"at": i, "parent": place.get(int(parent[o]), -1), "edge": edges[o], "row": int(o), "label": 0, "vec": anchors[o].tolist(), "window": [1], "low": [None], "high": [None]} for i, o in enumerate(order)]
    shape = pa.struct([("at", pa.int32()), ("parent", pa.int32()), ("edge", pa.float64()), ("row", pa.int64()), ("label", pa.int64()), ("vec", pa.list_(pa.float64())), *[(c, pa.list_(pa.int64())) for c in ("window", "low", "high")]])
    block = hn.Block(pa.array(rows, shape), True, 5)
    scored = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            scored.append(self.shape[0] * other.shape[1])
            return np.asarray(self) @ np.asarray(other)

    block.points = block.points.view(Counted)
    ids = np.arange(len(points))
    for part in (ids[:5], ids[5:]):
        block.meet(points[part], np.linalg.norm(points[part], axis=1), np.zeros(len(part), np.int64), part, part + 1000)
    assert sum(scored) < 0.2 * 40 * len(points)
    node, _, score, number, _ = block.best
    for i, o in enumerate(order):
        want = sorted(((-int(anchors[o] @ p), j) for j, p in enumerate(points)))[:5]
        assert [(-s, n) for s, n in zip(score[node == i].tolist(), number[node == i].tolist(), strict=True)] == want


def slow_tree(points):
    gaps = np.linalg.norm(points[:, None] - points[None, :], axis=2)
    inside, total = {0}, 0.0
    while len(inside) < len(points):
        gap, new = min((gaps[i, j], j) for i in inside for j in range(len(points)) if j not in inside)
        inside.add(new)
        total += gap
    return total
