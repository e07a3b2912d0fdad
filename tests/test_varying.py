"""Clusters of varying density against a brute-force version over all pairs."""

import numpy as np
import pytest

from threadlens.operators import neighbours, varying


def slow_tree(points, copies, samples):
    """Core distances and the edges of the minimum spanning tree of the mutual reachability, in their order."""
    n = len(points)
    gaps = np.sqrt(sum((points[:, None, i] - points[None, :, i]) ** 2 for i in range(points.shape[1])))
    core = np.empty(n)
    for i in range(n):
        order = np.argsort(gaps[i], kind="stable")
        core[i] = gaps[i][order][np.searchsorted(np.cumsum(copies[order]), samples)]
    reach = np.maximum(gaps, np.maximum(core[:, None], core[None, :]))
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    i, j = np.triu_indices(n, 1)
    tree = []
    for e in np.lexsort((j, i, reach[i, j])):
        a, b = find(i[e]), find(j[e])
        if a != b:
            top[a] = b
            tree.append((reach[i[e], j[e]], int(i[e]), int(j[e])))
    return core, tree


def slow_clusters(points, copies, samples, min_size, allow_single=False):
    """Label of each point: single linkage, condensed top down, clusters by excess of mass."""
    n = len(points)
    _, tree = slow_tree(points, copies, samples)
    kids, size, top = {}, {i: int(c) for i, c in enumerate(copies)}, {i: i for i in range(n)}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    made = n
    for w, a, b in tree:
        a, b = find(a), find(b)
        kids[made], size[made], top[made] = (a, b, w), size[a] + size[b], made
        top[a] = top[b] = made
        made += 1

    def leaves(x):
        out, todo = [], [x]
        while todo:
            y = todo.pop()
            if y in kids:
                todo += kids[y][:2]
            else:
                out.append(y)
        return out

    clusters, todo = [{"born": 0.0, "fell": [], "kids": []}], [(made - 1, 0)]
    while todo:
        x, c = todo.pop()
        if x not in kids:
            clusters[c]["fell"].append((x, 1 / 1e-12))
            continue
        a, b, w = kids[x]
        at = 1 / max(w, 1e-12)
        large = [k for k in (a, b) if size[k] >= min_size]
        if len(large) == 2:
            for k in large:
                clusters.append({"born": at, "fell": [], "kids": [], "size": size[k]})
                clusters[c]["kids"].append(len(clusters) - 1)
                todo.append((k, len(clusters) - 1))
        else:
            for k in (a, b):
                if k in large:
                    todo.append((k, c))
                else:
                    clusters[c]["fell"] += [(p, at) for p in leaves(k)]
    best, chosen = {}, {}
    for c in range(len(clusters) - 1, -1, -1):
        x = clusters[c]
        own = sum(copies[p] * (at - x["born"]) for p, at in x["fell"]) + sum(clusters[k]["size"] * (clusters[k]["born"] - x["born"]) for k in x["kids"])
        below = sum(best[k] for k in x["kids"])
        chosen[c] = own >= below and (c > 0 or allow_single)
        best[c] = max(own, below)
    labels, todo = np.full(n, -1), [(0, -1)]
    while todo:
        c, label = todo.pop()
        label = label if label >= 0 else c if chosen[c] else -1
        for p, _ in clusters[c]["fell"]:
            labels[p] = label
        todo += [(k, label) for k in clusters[c]["kids"]]
    return labels


def clouds(rng, sizes, spreads, dim=2):
    at = [rng.normal(size=dim) * 12 for _ in sizes]
    parts = [a + rng.normal(size=(n, dim)) * s for a, n, s in zip(at, sizes, spreads, strict=True)]
    return np.concatenate(parts + [rng.uniform(-30, 30, (sum(sizes) // 12, dim))])


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(rows)], "unit_id bigint, reduced array<double>")


def groups(labels):
    out = {}
    for i, c in enumerate(labels):
        out.setdefault(int(c), []).append(i)
    return out.pop(-1, []), sorted(out.values())


def slow_topics(rows, samples, min_size):
    """Points in the order of their vectors, which settles ties, with copies counted."""
    distinct, back, copies = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    return slow_clusters(distinct, copies, samples, min_size)[back.ravel()]


def agree(got, want):
    """Same outliers and same groups of places."""
    return groups(got) == groups(want)


@pytest.mark.parametrize(("seed", "sizes", "spreads", "dim"), [(1, (900, 600, 300), (0.3, 1.2, 3.5), 2), (2, (60, 90, 40), (0.5, 2.0, 0.1), 5)])
def test_like_brute_force(spark, seed, sizes, spreads, dim, monkeypatch):
    rng = np.random.default_rng(seed)
    points = clouds(rng, sizes, spreads, dim)
    rng.shuffle(points)
    if seed > 1:
        monkeypatch.setattr(neighbours, "BLOCK", 32)
        monkeypatch.setattr(varying, "GROUP", 40)
    found = varying.varying_topics(frame(spark, points).repartition(seed), "reduced", 5, 20)
    got = np.full(len(points), -9)
    for r in found.collect():
        got[r.unit_id] = r.topic_id
    assert agree(got, slow_topics(points, 5, 20))
    sizes = [int((got == t).sum()) for t in range(got.max() + 1)]
    assert sizes == sorted(sizes, reverse=True) and (seed != 1 or len(sizes) >= 3)


def test_core_distances_tree_and_slices(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = clouds(rng, (80, 60), (0.2, 2.0), 3)
    rows = np.concatenate([points, points[:7], np.repeat(points[3:4], 30, axis=0)])
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "BOXES", 4)
    _, table = neighbours.distinct_points(frame(spark, rows), "unit_id", "reduced")
    packed = neighbours.blocks(table)
    assert packed.selectExpr("max(size(node)) AS n").first().n <= 16
    near = neighbours.nearest_neighbours(packed, 5, 4)
    known = {r.node: (tuple(r.vec), r.copies) for r in table.collect()}
    order = sorted(known)
    vec, copies = np.array([known[i][0] for i in order]), np.array([known[i][1] for i in order])
    core, tree = slow_tree(vec, copies, 5)
    got = {r.node: r for r in near.collect()}
    assert np.allclose([got[i].core for i in order], core)
    gaps = neighbours.distances(vec, vec)
    for place, i in enumerate(order):
        want = sorted((gaps[place, j], order[j]) for j in range(len(order)) if j != place)[:4]
        assert [(n.gap, n.node) for n in got[i].near] == want
    edges = sorted((r.w, r.p, r.q) for r in varying.spanning_tree(packed, near).collect())
    assert edges == sorted((w, order[a], order[b]) for w, a, b in tree)


def test_copies_and_repeated_vectors(spark):
    rng = np.random.default_rng(6)
    points = clouds(rng, (60, 60), (0.4, 1.0))
    rows = np.concatenate([points, np.repeat(points[:1], 100, axis=0), np.repeat(points[70:71], 6, axis=0)])
    got = {r.unit_id: r.topic_id for r in varying.varying_topics(frame(spark, rows), "reduced", 5, 20).collect()}
    assert agree([got[i] for i in range(len(rows))], slow_topics(rows, 5, 20))
    assert len({got[i] for i in range(len(points), len(points) + 100)} | {got[0]}) == 1


def test_few_rows_one_vector_and_wrong_options(spark):
    assert varying.varying_topics(frame(spark, []), "reduced", 5, 20).count() == 0
    assert {r.topic_id for r in varying.varying_topics(frame(spark, [[1.0, 2.0]] * 7), "reduced", 5, 20).collect()} == {-1}
    one = frame(spark, [[1.0, 2.0]] * 30)
    assert {r.topic_id for r in varying.varying_topics(one, "reduced", 5, 20).collect()} == {-1}
    assert {r.topic_id for r in varying.varying_topics(one, "reduced", 5, 20, allow_single=True).collect()} == {0}
    with pytest.raises(ValueError, match="min_cluster_size"):
        varying.varying_topics(one, "reduced", 5, 1)
    with pytest.raises(ValueError, match="differ in length"):
        varying.varying_topics(spark.createDataFrame([(i, [1.0] * (1 + i % 2)) for i in range(40)], "unit_id bigint, reduced array<double>"), "reduced", 5, 20)


@pytest.mark.parametrize("seed", range(6))
def test_groups_settle_what_one_task_would(seed):
    """A tree cut into groups at random: what its groups tell and what waits for the rest give the entries of the whole tree."""
    rng = np.random.default_rng(seed)
    n, least = 400, 12
    sizes = {i: int(c) for i, c in enumerate(rng.choice([1, 1, 1, 3, 15], n))}
    edges = [(float(rng.integers(60)), *sorted((i, int(rng.integers(max(0, i - 25), i))))) for i in range(1, n)]
    edges = [(w, p, q, p, q) for w, p, q in edges]
    large = {i for i in sizes if sizes[i] >= least}
    small = {i: c for i, c in sizes.items() if c < least}
    whole = varying._enter_in_order(small, large, edges, least)
    group = rng.integers(0, 4, n) if seed % 2 else np.arange(n) // 100
    first = []
    for g in range(4):
        here = [e for e in edges if g in (group[e[3]], group[e[4]])]
        own = {i for i in large if group[i] == g}
        first += varying._enter_in_order({i: c for i, c in small.items() if group[i] == g}, own, here, least)
    into, by = {i: i for i in large} | {i: c for i, c, _ in first}, {i: e for i, _, e in first if e}
    assert by
    left = {}
    for i in small:
        if i not in by:
            left[into[i]] = left.get(into[i], 0) + small[i]
    rest = [(w, p, q, into[p], into[q]) for w, p, q, _, _ in edges if into[p] != into[q]]
    known = {into[i] for i in sizes if i in by or i in large}
    last = {i: (c, e) for i, c, e in varying._enter_in_order(left, known, rest, least)}
    got = [(i, *((into[i], by[i]) if i in by else last[into[i]])) for i in small]
    assert sorted(got, key=str) == sorted(whole, key=str)


def test_short_vectors_have_small_blocks_in_chunks(spark):
    points = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(np.random.default_rng(1).normal(size=(9000, 3)))], "node bigint, vec array<double>, copies bigint")
    packed = neighbours.blocks(points.coalesce(1))
    rows = packed.selectExpr("block", "chunk", "size(node) AS n", "node").collect()
    assert sorted(i for r in rows for i in r.node) == list(range(9000))
    assert max(r.n for r in rows) <= neighbours.BLOCK // 16 and min(r.n for r in rows) >= 16 and len({r.chunk for r in rows}) < len(rows)


def test_neighbours_of_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    vec = np.random.default_rng(3).normal(size=(90, 20))
    points = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(vec)], "node bigint, vec array<double>, copies bigint")
    gaps = neighbours.distances(vec, vec)
    for r in neighbours.nearest_neighbours(neighbours.blocks(points), 3, 4).collect():
        order = [j for j in np.argsort(gaps[r.node], kind="stable") if j != r.node]
        assert [n.node for n in r.near] == order[:4] and np.isclose(r.core, gaps[r.node, order[1]])
