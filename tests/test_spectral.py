"""Neighbour graph and its eigenvectors against dense matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.functions.vectors import hash_vectors
from threadlens.operators import density, neighbours, spectral
from threadlens.session import ensure_checkpoint_dir


def dense_graph(points, k):
    gaps = neighbours.distances(points, points)
    np.fill_diagonal(gaps, np.inf)
    near = np.argsort(gaps, axis=1, kind="stable")[:, :k]
    reach = np.take_along_axis(gaps, near, axis=1).max(axis=1)
    linked = np.zeros(gaps.shape, bool)
    np.put_along_axis(linked, near, True, axis=1)
    linked |= linked.T
    w = np.where(linked, np.exp(-np.where(linked, gaps, 0) ** 2 / np.outer(reach, reach)), 0)
    degree = w.sum(axis=1)
    return w / np.sqrt(np.outer(degree, degree)), degree


def frame(spark, points, name="embedding"):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], f"unit_id bigint, {name} array<double>")


def test_eigenvectors_equal_numpys(spark, monkeypatch):
    rng = np.random.default_rng(2)
    # A bent band, whose eigenvalues are well apart.
    t = np.sort(rng.uniform(0, 4, 1000))
    points = np.stack([np.cos(t) * 3, np.sin(t) * 3, t * 2, rng.uniform(0, 1, 1000)], axis=1)
    monkeypatch.setattr(neighbours, "BLOCK", 200)
    members, table = neighbours.distinct_points(frame(spark, points), "unit_id", "embedding")
    edges, degree = spectral.normalised(spectral.neighbour_graph(neighbours.blocks(table), 12))
    matrix, degrees = dense_graph(points, 12)
    node = {r.unit_id: r.node for r in members.collect()}
    got = {r.node: r.degree for r in degree.collect()}
    assert np.allclose([got[node[i]] for i in range(1000)], degrees)
    values, found = spectral.leading_eigenvectors(edges, degree.select("node"), 4)
    x = {r.node: r.x for r in found.collect()}
    x = np.array([x[node[i]] for i in range(1000)])
    want_values, want = np.linalg.eigh(matrix)
    assert np.allclose(values, want_values[::-1][:4], atol=1e-9)
    for i in range(4):
        v = want[:, -1 - i]
        assert min(np.abs(x[:, i] - v).max(), np.abs(x[:, i] + v).max()) < 1e-4


def closeness(points, kinds):
    """Mean distance within a kind against that of all."""
    gaps = neighbours.distances(points, points)
    same = np.equal.outer(kinds, kinds)
    return gaps[same].mean() / gaps.mean()


def test_languages_stand_closer_than_after_pca(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text").orderBy("doc_id").collect()
    vectors = hash_vectors([d.text or "" for d in docs])
    rows = frame(spark, vectors)
    kinds = np.array([d.lang for d in docs])
    got = {r.unit_id: r.reduced for r in spectral.neighbour_coordinates(rows, 5, 10).collect()}
    plain = {r.unit_id: r.reduced for r in density.reduce_dimensions(rows, 5).collect()}
    kept, pca = (np.array([m[i] for i in range(len(docs))]) for m in (got, plain))
    assert kept.shape == (len(docs), 5) and closeness(kept, kinds) < closeness(pca, kinds)


def test_copies_few_points_and_wrong_options(spark):
    few = spectral.neighbour_coordinates(frame(spark, [[1.0, 0.0], [2.0, 0.0], [0.0, 1.0]]), 2)
    assert sorted(map(tuple, few.select("unit_id", "reduced").collect())) == [(i, [0.0, 0.0]) for i in range(3)]
    assert spectral.neighbour_coordinates(frame(spark, []), 2).count() == 0
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(size=(20, 3)), np.ones((30, 3))])
    got = spectral.neighbour_coordinates(frame(spark, points), 2, 5)
    assert got.count() == 50 and got.where("unit_id >= 20").agg(F.countDistinct("reduced")).first()[0] == 1
    with pytest.raises(ValueError, match="positive"):
        spectral.neighbour_coordinates(frame(spark, points), 0)


def test_pairs_of_blocks_are_spread_over_the_cores(spark):
    from threadlens.operators.neighbours import blocks, met

    points = spark.range(5000).selectExpr("id AS node", "array(double(id), 0D) AS vec", "1L AS copies")
    packed = blocks(points)
    pairs = packed.selectExpr("block AS a").crossJoin(packed.selectExpr("block AS b"))
    found = met(pairs, packed, ("node",))
    assert found.count() == packed.count() ** 2
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_long_vectors_have_their_nearest_points(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    monkeypatch.setattr(neighbours, "OWN", 2)
    # Whole numbers, so that many distances are equal, and copies.
    points = rng.integers(0, 3, (500, 20)).astype(float)
    points = np.concatenate([points, points[:40], points[:10]])
    _, table = neighbours.distinct_points(frame(spark, points), "unit_id", "embedding")
    packed = neighbours.blocks(table)
    rows = table.orderBy("node").collect()
    gaps = neighbours.distances(*[np.array([r.vec for r in rows])] * 2)
    node, copies = np.array([r.node for r in rows]), np.array([r.copies for r in rows])
    for samples, keep in ((1, 7), (9, 3)):
        got = {r.node: r for r in neighbours.nearest_neighbours(packed, samples, keep).collect()}
        assert got.keys() == set(node.tolist())
        for i, n in enumerate(node.tolist()):
            order = np.argsort(gaps[i], kind="stable")
            others = [j for j in order if j != i][:keep]
            assert [(x.gap, x.node) for x in got[n].near] == [(gaps[i, j], node[j]) for j in others]
            assert got[n].core == gaps[i, order[(np.cumsum(copies[order]) >= samples).argmax()]]


def test_blocks_of_long_vectors_are_not_exchanged_and_steps_leave_the_disk(spark, monkeypatch):
    from pathlib import Path
    from urllib.parse import urlparse

    def exchanged(*args):
        raise AssertionError("pairs of blocks of long vectors were exchanged")

    monkeypatch.setattr(neighbours, "met", exchanged)
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    rows = frame(spark, np.random.default_rng(6).normal(size=(300, 18)))
    ensure_checkpoint_dir(spark)
    kept = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    before = set(kept.iterdir())
    assert spectral.neighbour_coordinates(rows, 3, 6).count() == 300
    left = sorted(p.name.split("-")[0] for p in set(kept.iterdir()) - before)
    assert left == ["coordinates", "members"]
