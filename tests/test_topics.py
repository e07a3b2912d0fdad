import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.operators import dendrogram, density, terms, topics
from threadlens.options import TopicOptions


def texts(spark, rows):
    return spark.createDataFrame(rows, "unit_id bigint, topic_id int, modeling_text string")


def random_texts(seed=3, n=120, k=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["the", "12", "this"]
    return [(i, rng.randrange(-1, k), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(n)]


# --- keywords and terms -------------------------------------------------------------


def test_keywords_break_ties_by_first_appearance(spark):
    rows = random_texts()
    counts = defaultdict(Counter)
    for _, topic, text in sorted(rows):
        counts[topic].update(w for w in text.split() if w not in ("the", "this", "12"))
    got = terms.top_keywords(texts(spark, rows).repartition(6), 7, order=F.col("unit_id")).orderBy("topic_id", "rank")
    found = defaultdict(list)
    for r in got.collect():
        found[r.topic_id].append((r.keyword, r.n))
    assert dict(found) == {t: c.most_common(7) for t, c in counts.items()}


def test_titles(spark):
    names = spark.createDataFrame([(-1, "x"), (0, "sql"), (1, "code")], "topic_id int, label string")
    words = spark.createDataFrame([(-1, ["q"]), (0, ["a", "b", "c", "d"])], "topic_id int, keywords array<string>")
    rows = {r.topic_id: r.title for r in terms.topic_titles(names, words, F.col("label")).collect()}
    assert rows == {-1: "outliers", 0: "a, b, c", 1: "code"}


def test_min_df(spark):
    asked = [(1, 10, 7), (0, 10, 7), (5, 36, 4), (5, 3, 4), (0.0, 5, 10), (2.5, 5, 3), (0.5, 0, 3), (2, 2, 9), (1.0, 8, 6)]
    got = spark.range(1).select(*[terms.topics_needed(*a).alias(f"x{i}") for i, a in enumerate(asked)]).first()
    assert list(got) == pytest.approx([1, 1, 20 / 36, 4, 2, 3, 3, 9, 6])


def weights_by_hand(rows, at_least):
    counts = defaultdict(Counter)
    for _, topic, text in rows:
        counts[topic].update(text.split())
    df = Counter(w for c in counts.values() for w in c)
    keep = {w for w in df if df[w] >= at_least}
    total = Counter()
    for c in counts.values():
        total.update({w: n for w, n in c.items() if w in keep})
    mean = int(sum(total.values()) / len(counts))
    return {(t, w): n * math.log(1 + mean / total[w]) for t, c in counts.items() for w, n in c.items() if w in keep}


@pytest.mark.parametrize(("min_df", "at_least"), [(1, 1), (0.8, 4), (108, 4.5)])
def test_class_tf_idf(spark, min_df, at_least):
    rows = random_texts()
    counted = terms.term_counts(texts(spark, rows), "modeling_text")
    got = terms.term_weights(counted, min_df, len(rows)).collect()
    want = weights_by_hand(rows, at_least)
    assert {(r.topic_id, r.term) for r in got} == set(want)
    assert all(abs(r.weight - want[r.topic_id, r.term]) < 1e-9 for r in got)


def test_threshold_nobody_reaches_falls_back_to_one(spark):
    rows = [(0, 0, "a b"), (1, 1, "c d d")]
    got = terms.term_weights(terms.term_counts(texts(spark, rows), "modeling_text"), 1.0, 2)
    assert {(r.topic_id, r.term) for r in got.collect()} == {(0, "a"), (0, "b"), (1, "c"), (1, "d")}
    best = terms.top_terms(got, 1).collect()
    assert {(r.topic_id, r.term) for r in best} == {(0, "a"), (1, "d")}


def test_no_terms_at_all(spark):
    assert terms.term_weights(terms.term_counts(texts(spark, [(0, 0, "")]), "modeling_text"), 5, 1).count() == 0


def test_terms_of_any_length_are_counted_from_one_exchange(spark):
    rows = [(0, 0, "b a a a"), (1, 0, "a b"), (2, 1, "a"), (3, 1, ""), (4, 1, "A é_1 a é_1 a"), (5, 2, None), (6, 2, "a a")]
    for low, high in ((1, 1), (1, 2), (2, 2), (1, 3), (2, 3)):
        want = Counter()
        for _, topic, text in rows:
            said = (text or "").lower().split()
            want.update((topic, " ".join(said[i : i + n])) for n in range(low, high + 1) for i in range(len(said) - n + 1))
        counted = terms.term_counts(texts(spark, rows), "modeling_text", low, high)
        assert {(r.topic_id, r.term): r.tf for r in counted.collect()} == want
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.split("== Initial Plan ==")[0].count("ReusedExchange") == high - low


# --- labels ----------------------------------------------------------------------------


def test_simple_topics_number_the_labels_present(spark):
    df = spark.createDataFrame(
        [(0, True, False), (1, False, True), (2, False, False), (3, True, True)], "unit_id int, has_sql boolean, has_code boolean"
    )
    rows = {r.unit_id: (r.label, r.topic_id) for r in topics.simple_topics(df).collect()}
    assert rows == {0: ("sql", 2), 1: ("code", 0), 2: ("general", 1), 3: ("sql", 2)}


# --- vectors ------------------------------------------------------------------------------


def random_vectors(seed, n, k, width=6):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(-1, k)), [float(x) for x in rng.normal(size=width)]) for i in range(n)]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "unit_id bigint, topic_id int, embedding array<float>")


def means(rows):
    groups = defaultdict(list)
    for _, t, v in rows:
        groups[t].append(np.float32(v))
    return {t: np.mean(np.array(v, dtype=float), axis=0) for t, v in groups.items()}


def test_centroids(spark):
    rows = random_vectors(1, 80, 5)
    got = {r.topic_id: r.centroid for r in topics.topic_centroids(vectors(spark, rows)).collect()}
    want = means(rows)
    assert got.keys() == want.keys() and all(np.allclose(got[t], want[t]) for t in want)


@pytest.mark.parametrize("kind", ["parallel", "same", "close"])
def test_merging_ends_on_centroids_that_look_alike(spark, kind):
    rng = np.random.default_rng(4)
    base = rng.normal(size=64)
    made = {"parallel": lambda i: base * (i + 1), "same": lambda i: base, "close": lambda i: base + rng.normal(size=64) * 1e-9}[kind]
    rows = [(i, [float(x) for x in made(i)], 1) for i in range(9)] + [(-1, [0.0] * 64, 3)]
    merged = dendrogram.reduce_topics(spark.createDataFrame(rows, "topic_id int, centroid array<double>, n_units bigint"), 2).collect()
    assert len({r.merged_topic for r in merged if r.topic_id >= 0}) == 2 and len(merged) == 10


def test_merging_refuses_centroids_that_are_no_numbers(spark):
    rows = [(0, [1.0, float("nan")], 1), (1, [0.0, 1.0], 1), (2, [1.0, 1.0], 1)]
    with pytest.raises(ValueError, match="finite"):
        dendrogram.reduce_topics(spark.createDataFrame(rows, "topic_id int, centroid array<double>, n_units bigint"), 1)


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_outliers_go_to_the_nearest_centroid(spark, block_bytes):
    rows = random_vectors(2, 100, 7)
    centers = {t: c for t, c in means(rows).items() if t != -1}
    df = vectors(spark, rows)
    real = topics.topic_centroids(df.where("topic_id <> -1"))
    lost = topics.nearest_centroid(df.where("topic_id = -1"), real, block_bytes=block_bytes).collect()
    for r in lost:
        v = np.array(r.embedding)
        scores = {t: v @ c / np.linalg.norm(v) / np.linalg.norm(c) for t, c in centers.items()}
        assert r.nearest_topic == max(scores, key=lambda t: (scores[t], -t))
        assert r.similarity == pytest.approx(max(scores.values()))
    moved = {r.unit_id: r.topic_id for r in topics.reassign_outliers(df).collect()}
    assert len(moved) == 100 and -1 not in moved.values()
    assert all(moved[i] == t for i, t, _ in rows if t != -1)


def test_outliers_without_any_topic_stay(spark):
    df = vectors(spark, [(0, -1, [1.0, 0.0])])
    assert [r.topic_id for r in topics.reassign_outliers(df).collect()] == [-1]


def test_outliers_by_terms(spark):
    rows = [(0, 0, "red apple apple"), (1, 1, "blue sky sky"), (2, -1, "sky apple sky"), (3, -1, "nothing shared")]
    df = texts(spark, rows)
    weights = terms.term_weights(terms.term_counts(df.where("topic_id <> -1"), "modeling_text"), 1, 2)
    moved = {r.unit_id: r.topic_id for r in topics.reassign_outliers_by_terms(df, weights, "modeling_text").collect()}
    assert moved == {0: 0, 1: 1, 2: 1, 3: -1}


@pytest.mark.parametrize(("head", "n_topics"), [(1, 9), (2, 30), (8, 30)])
def test_outliers_by_terms_like_brute_force(spark, head, n_topics):
    """A common term is in every topic; heads of the postings and bounds lead to the same winners as all scores."""
    rng = random.Random(head)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, i % n_topics if i < 4 * n_topics else -1, " ".join(["all", *rng.choices(words, k=rng.randrange(0, 9))])) for i in range(8 * n_topics)]
    rows += [(9999, -1, "nothing known"), (9998, -1, ""), (9997, -1, "all"), (9997, -1, "all")]
    df = texts(spark, rows)
    weights = terms.term_weights(terms.term_counts(df.where("topic_id <> -1"), "modeling_text"), 1, 4 * n_topics)
    known = defaultdict(dict)
    for r in weights.collect():
        known[r.topic_id][r.term] = (r.weight, r.weight / r.tf)
    want = []
    for i, t, text in rows:
        if t == -1:
            scores = {}
            for topic, ws in known.items():
                shared = Counter(w for w in text.split() if w in ws)
                if shared:
                    scores[topic] = round(sum(n * ws[w][1] * ws[w][0] for w, n in shared.items()) / np.sqrt(sum(w * w for w, _ in ws.values())), 9)
            t = min(scores, key=lambda x: (-scores[x], x), default=-1)
        want.append((i, t))
    got = topics.reassign_outliers_by_terms(df, weights, "modeling_text", head=head)
    assert sorted((r.unit_id, r.topic_id) for r in got.collect()) == sorted(want)


def linkage_by_hand(rows, target):
    """Average linkage over the inner products of all pairs of units; a merged topic has the smaller id."""
    parts = defaultdict(list)
    for _, t, v in rows:
        if t != -1:
            parts[t].append(np.float32(v).astype(float))
    parts, into = {t: np.array(v) for t, v in parts.items()}, {t: t for _, t, _ in rows}
    while len(parts) > max(target, 1):
        _, a, b = min((-np.mean(parts[a] @ parts[b].T), a, b) for a in parts for b in parts if a < b)
        parts[a] = np.concatenate([parts[a], parts.pop(b)])
        into = {t: a if c == b else c for t, c in into.items()}
    return into


@pytest.mark.parametrize("block_bytes", [1 << 26, 200])
def test_every_cut_of_one_tree_is_average_linkage(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(dendrogram, "BLOCK_BYTES", block_bytes)
    rows = random_vectors(5, 200, 12)
    df = vectors(spark, rows)
    tree = dendrogram.topic_tree(topics.topic_centroids(df))
    assert tree.count() == len({t for _, t, _ in rows if t != -1}) - 1
    for target in (7, 4, 2, 1, 50):
        got = {r.topic_id: r.merged_topic for r in dendrogram.cut_tree(tree, df, target).collect()}
        assert got == linkage_by_hand(rows, target)
    merges = tree.orderBy("round").collect()
    assert all(m.a < m.b for m in merges) and max(m.n_units for m in merges) == sum(t != -1 for _, t, _ in rows)


def test_no_topics_or_one(spark):
    schema = "topic_id int, centroid array<double>, n_units bigint"
    assert dendrogram.reduce_topics(spark.createDataFrame([], schema), 3).count() == 0
    one = spark.createDataFrame([(-1, [1.0], 2), (4, [1.0], 3)], schema)
    assert sorted(map(tuple, dendrogram.reduce_topics(one, 3).collect())) == [(-1, -1), (4, 4)]
    with pytest.raises(ValueError, match="at least 1"):
        dendrogram.reduce_topics(one, 0)


def test_ranking_by_size(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([7, 7, 7, 2, 2, 9, 9, -1])], "unit_id int, topic_id int")
    got = {r.unit_id: r.topic_id for r in topics.rank_topics(df).collect()}
    assert [got[i] for i in range(8)] == [0, 0, 0, 1, 1, 2, 2, -1]


# --- density -----------------------------------------------------------------------------------


def union_find(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def graphs():
    rng = random.Random(11)
    yield 60, [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    order = list(range(80))
    rng.shuffle(order)
    yield 80, list(zip(order, order[1:]))  # one long path in random order
    yield 40, [(0, i) for i in range(1, 40)]  # a star
    yield 5, []


@pytest.mark.parametrize("graph", list(graphs()), ids=["random", "path", "star", "empty"])
def test_connected_components(spark, graph):
    n, edges = graph
    nodes = spark.range(n).withColumnRenamed("id", "node")
    got = density.connected_components(nodes, spark.createDataFrame(edges, "a bigint, b bigint"))
    groups, wanted = defaultdict(set), defaultdict(set)
    for r in got.collect():
        groups[r.component].add(r.node)
    for node, root in enumerate(union_find(n, edges)):
        wanted[root].add(node)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    assert all(component in members for component, members in groups.items())


def cells_by_hand(cells, least, smallest):
    """cells: {(x, y): n} -> {(x, y): topic}"""
    near = lambda a, b: a != b and max(abs(a[0] - b[0]), abs(a[1] - b[1])) == 1
    dense = sorted(c for c in cells if cells[c] >= least)
    at = {c: i for i, c in enumerate(dense)}
    roots = union_find(len(dense), [(at[a], at[b]) for a in dense for b in dense if near(a, b)])
    names = {r: min(c for c in dense if roots[at[c]] == r) for r in roots}
    member = {c: names[roots[at[c]]] for c in dense}
    for c in sorted(set(cells) - set(dense)):
        offers = [(-cells[d], names[roots[at[d]]]) for d in dense if near(c, d)]
        if offers:
            member[c] = min(offers)[1]
    sizes = Counter()
    for c, name in member.items():
        sizes[name] += cells[c]
    ranked = sorted((-s, name) for name, s in sizes.items() if s >= smallest)
    number = {name: i for i, (_, name) in enumerate(ranked)}
    return {c: number[name] for c, name in member.items() if name in number}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cell_topics(spark, seed):
    rng = random.Random(seed)
    cells = {(rng.randrange(12), rng.randrange(12)): rng.randint(1, 9) for _ in range(60)}
    df = spark.createDataFrame([(list(c), n) for c, n in cells.items()], "cell array<bigint>, n bigint")
    got = {tuple(r.cell): r.topic_id for r in density.cell_topics(df, 2, 5, 12).collect()}
    assert got == cells_by_hand(cells, 5, 12)


def test_density_topics_find_separate_clouds_and_outliers(spark):
    rng = np.random.default_rng(4)
    centers = np.eye(8)[:3]
    rows = [(i, [float(x) for x in centers[i % 3] * 3 + rng.normal(scale=0.05, size=8)]) for i in range(300)]
    rows += [(300 + i, [float(x) for x in -np.eye(8)[5 + i % 3]]) for i in range(3)]
    df = spark.createDataFrame(rows, "unit_id bigint, embedding array<float>")
    o = TopicOptions(backend="density", clustering="grid", components=3, cell_width=0.15, min_cluster_size=20)
    got = {r.unit_id: r.topic_id for r in density.density_topics(df, o).collect()}
    clouds = [{got[i] for i in range(c, 300, 3)} for c in range(3)]
    assert sorted(map(tuple, clouds)) == [(0,), (1,), (2,)]
    assert {got[300 + i] for i in range(3)} == {-1}


def test_reduced_dimensions_are_principal_components(spark):
    rows = random_vectors(9, 150, 3)
    unit = np.array([np.float32(v) for _, _, v in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    values, axes = np.linalg.eigh(np.cov(unit.T))
    best = axes[:, np.argsort(values)[::-1][:3]]
    got = density.reduce_dimensions(vectors(spark, rows), 3).orderBy("unit_id").collect()
    assert np.allclose(np.abs([r.reduced for r in got]), np.abs(unit @ best), atol=1e-6)


def test_reduced_vectors_hash_each_text_once(spark):
    from threadlens.plans import catalog

    found = catalog.QUERIES["reduced_vectors"](spark, "/root/testdata/sf0.001")
    assert "ArrowEvalPython" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 5 * spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_each_batch_of_the_hashing_gives_memory_back(monkeypatch):
    import pyarrow as pa

    from threadlens.functions import vectors

    calls, kept = [], []
    monkeypatch.setattr(vectors, "release", lambda: calls.append(1))
    monkeypatch.setattr(vectors.F, "arrow_udf", lambda kind: lambda f: kept.append(f) or type("Udf", (), {"asNondeterministic": lambda self: lambda text: text})())
    vectors.hash_embedding(None)
    assert len(kept[0](pa.array(["one two", None]))) == 2 and calls == [1]
