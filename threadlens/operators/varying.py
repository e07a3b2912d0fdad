"""Density clusters of varying density: mutual reachability, minimum spanning tree, condensed tree, excess of mass.

The distance of two points is the largest of their core distances and their gap.  Boruvka rounds, as joins, give a minimum
spanning tree: every component takes its lightest edge, which the neighbour lists offer and a search of the blocks that may
hold a lighter one confirms.  Edges have one order (weight, then their ends), so the tree is unique.

Going up through the weights, a component below ``min_cluster_size`` is no cluster: its points enter the first component that is
large enough, at the weight of the edge that leads there.  Groups of points settle this by themselves as far as their edges tell,
and what waits for points of other groups is settled in rounds of joins until it fits one task.  What is left
are the places where two large components meet, at most one for every ``min_cluster_size`` rows: a small tree, in which the
clusters of the greatest excess of mass are chosen.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .neighbours import block_pairs, blocks, box_gaps, box_spans, compared, distances, distinct_points, matrix, nearest_neighbours

OUTLIER = -1
#: Large components that the tree of clusters may have; it is built on the driver and sent to the tasks.
MAX_LEAVES = 200_000
#: Points or components that one task puts in order.
GROUP = 100_000
#: Weights below this count as this much, so that copies have a finite density.
LEAST_WEIGHT = 1e-12
EDGE = "w", "p", "q"


def edge(w: Column, a: Column, b: Column) -> Column:
    """An edge in the order of edges: weight, smaller end, larger end."""
    return F.struct(w.alias("w"), F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))


def join_labels(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges (p, q, ...) between different components, with these as a and b."""
    first = labels.select(F.col("node").alias("p"), F.col("component").alias("a"))
    second = labels.select(F.col("node").alias("q"), F.col("component").alias("b"))
    return edges.drop("a", "b").join(first, "p").join(second, "q").where("a <> b")


def lightest(edges: DataFrame) -> DataFrame:
    """(component, best): the lightest edge (w, p, q) of each component among edges (a, b, w, p, q)."""
    both = edges.select(F.explode(F.array("a", "b")).alias("component"), F.struct(*EDGE).alias("best"))
    return both.groupBy("component").agg(F.min("best").alias("best"))


def _outside(packed: DataFrame) -> DataFrame:
    """(component, best): each component's lightest edges out of the blocks of ``packed`` that may be lighter than ``bound``.

    Rows hold lists of node, vec, core, component and bound (what each point's component already has), and the block's box,
    ``lone`` (its component if it is the only one), greatest core distance and greatest bound (of points that can have such an edge, or -1).
    """
    def choose(known: dict[str, np.ndarray], batch: pa.RecordBatch) -> list[np.ndarray]:
        n = batch.num_rows
        low, high = matrix(batch["low"], n), matrix(batch["high"], n)
        lone, core, bound = (batch[c].to_numpy() for c in ("lone", "cores", "bounds"))
        other = (lone[:, None] != known["lone"][None]) | (lone[:, None] < 0)
        # A block with a point outside each of the components here bounds their distance to it, from end to end.
        sure = other & ((lone[:, None] >= 0) | (known["lone"][None] < 0))
        spans = np.maximum(box_spans(low, high, known["low"], known["high"]), np.maximum(core[:, None], known["cores"][None]))
        bound = np.minimum(bound, np.where(sure, spans, np.inf).min(axis=1, initial=np.inf))
        close = other & (box_gaps(low, high, known["low"], known["high"]) <= bound[:, None])
        return [np.flatnonzero(c) for c in close]

    def compare(pairs: Iterator[tuple[dict, dict]]) -> pa.Table:
        out = []
        for a, b in pairs:
            # An edge weighs no less than the core distance of its end.
            near = np.flatnonzero(a["core"] <= a["bound"])
            weight = np.maximum(distances(a["vec"][near], b["vec"]), np.maximum(a["core"][near, None], b["core"][None]))
            weight[a["component"][near, None] == b["component"][None]] = np.inf
            # Equal weights are put in order by the ends, as everywhere.
            least = weight.min(axis=1, initial=np.inf)
            at, to = np.nonzero((weight == least[:, None]) & np.isfinite(least)[:, None] & (least <= a["bound"][near])[:, None])
            p, q = np.minimum(a["node"][near[at]], b["node"][to]), np.maximum(a["node"][near[at]], b["node"][to])
            out.append((a["component"][near[at]], least[at], p, q))
        component, w, p, q = (np.concatenate(column) for column in zip(*out, strict=True))
        order = np.lexsort((q, p, w, component))
        first = order[np.diff(component[order], prepend=-1) != 0]
        return pa.table([c[first] for c in (component, w, p, q)], ["component", *EDGE])

    pairs = written(block_pairs(packed, choose, "lone", "cores", "bounds"), "pairs")
    columns = ("node", "vec", "core", "component", "bound")
    found = compared(pairs, packed, columns, compare, "component bigint, w double, p bigint, q bigint")
    return found.groupBy("component").agg(F.min(F.struct(*EDGE)).alias("best"))


def _rooted(pointers: DataFrame) -> DataFrame:
    """Pointers (component, to), in which the smaller one of two that point to each other points to itself."""
    back = pointers.select(F.col("component").alias("to"), F.col("to").alias("component"), F.lit(True).alias("mutual"))
    to = F.when(F.col("mutual") & (F.col("component") < F.col("to")), F.col("component")).otherwise(F.col("to"))
    return pointers.join(back, ["component", "to"], "left").select("component", to.alias("to"))


def _follow(pointers: DataFrame) -> DataFrame:
    """(component, root) for pointers (component, to); a root points to itself.  Each round goes eight times as far."""
    pointers = written(pointers, "pointers")
    while True:
        onward = pointers
        for _ in range(3):
            nxt = onward.select(F.col("component").alias("to"), F.col("to").alias("next"))
            onward = onward.join(nxt, "to").select("component", F.col("next").alias("to"))
        onward = written(onward, "pointers")
        if onward.join(pointers, ["component", "to"], "left_anti").isEmpty():
            return onward.withColumnRenamed("to", "root")
        pointers = onward


def _roots(pointers: DataFrame, count: int) -> DataFrame:
    """(component, root) for ``count`` pointers (component, to) at most, two of which may point to each other; one task follows up to ``GROUP``."""
    if count > GROUP:
        return _follow(_rooted(pointers))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b["component"].to_numpy(), b["to"].to_numpy()) for b in batches]
        if rows:
            component, to = (np.concatenate(column) for column in zip(*rows, strict=True))
            order = np.argsort(component)
            component, at = component[order], np.searchsorted(component[order], to[order])
            place = np.arange(len(at))
            at = np.where((at[at] == place) & (place < at), place, at)
            while (at[at] != at).any():
                at = at[at]
            yield pa.RecordBatch.from_arrays([pa.array(component), pa.array(component[at])], ["component", "root"])

    return pointers.repartition(1).mapInArrow(settle, "component bigint, root bigint")


def spanning_tree(packed: DataFrame, near: DataFrame) -> DataFrame:
    """Edges (p, q, w) of the minimum spanning tree of the points of ``packed``; ``near`` has their core distances and neighbours."""
    return tree_and_homes(packed, near)[0]


def tree_and_homes(packed: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges of ``spanning_tree``, and (node, component) of the last round in which no component held over ``GROUP`` points."""
    places = packed.select("block", F.posexplode("node").alias("at", "node")).join(near.select("node", "core"), "node")
    places = written(places, "places")
    offered = near.select("node", "core", F.explode("near").alias("n")).select("node", "core", "n.gap", F.col("n.node").alias("other"))
    other = near.select(F.col("node").alias("other"), F.col("core").alias("other_core"))
    weight = F.greatest("core", "other_core", "gap")
    edges = offered.join(other, "other").select(edge(weight, F.col("node"), F.col("other")).alias("e")).distinct().select("e.*")
    edges = written(edges, "offered")
    labels = written(places.select("node", F.col("node").alias("component")), "labels")
    tree, left, homes = None, labels.count(), labels
    while left > 1:
        edges = written(join_labels(edges, labels), "live")
        offers = written(lightest(edges), "offers")
        marked = places.join(labels, "node").join(offers.select("component", F.col("best.w").alias("offer")), "component", "left")
        bound = F.coalesce("offer", F.lit(float("inf")))
        lists_of = F.sort_array(F.collect_list(F.struct("at", "core", "component", bound.alias("bound"))))
        lone = F.when(F.min("component") == F.max("component"), F.min("component")).otherwise(-1)
        per_block = marked.groupBy("block").agg(lists_of.alias("all"), lone.alias("lone"), F.max("core").alias("cores"), F.max(F.when(F.col("core") <= bound, bound).otherwise(-1.0)).alias("bounds"))
        full = packed.join(per_block, "block").select("block", "chunk", "node", "vec", "low", "high", "lone", "cores", "bounds", *[F.col(f"all.{c}").alias(c) for c in ("core", "component", "bound")])
        found = written(_outside(written(full, "marked")), "found")
        best = offers.unionByName(found).groupBy("component").agg(F.min("best").alias("best"))
        chosen = written(join_labels(best.select("component", "best.*"), labels), "chosen")
        tree = chosen.select("p", "q", "w") if tree is None else tree.unionByName(chosen.select("p", "q", "w"))
        other = F.when(F.col("a") == F.col("component"), F.col("b")).otherwise(F.col("a"))
        merged = _roots(chosen.select("component", other.alias("to")), left)
        labels = written(labels.join(merged, "component").select("node", F.col("root").alias("component")), "labels")
        counted = labels.groupBy("component").count().agg(F.count(F.lit(1)).alias("left"), F.max("count").alias("most")).first()
        before, left = left, counted.left
        if left >= before:
            raise RuntimeError("the spanning tree made no progress")
        homes = labels if counted.most <= GROUP else homes
    return written(tree.distinct(), "tree") if tree is not None else edges.select("p", "q", "w").limit(0), homes


# --- points that enter large components ------------------------------------------------


def _enter_in_order(sizes: dict[int, int], large: set[int], edges: list[tuple[float, int, int, int, int]], min_size: int) -> list[tuple[int, int, tuple | None]]:
    """(component, into, entry) for the small components ``sizes`` after their edges (w, p, q, a, b), taken one by one in their order.

    Ends that are neither here nor ``large`` are unknown.  A component whose lightest edge leads to such an end, or to one that waits
    itself, waits: it keeps its size and has no entry.
    """
    top, size, members, waits = {n: n for n in sizes}, dict(sizes), {n: [n] for n in sizes}, set()
    entered: dict[int, tuple[int, tuple]] = {}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for *key, a, b in sorted(edges):
        names = [entered[x][0] if x in entered else x if x in large else None for x in (a, b)]
        small = [find(x) for x, name in zip((a, b), names, strict=True) if name is None and x in top]
        if len(small) + 2 - names.count(None) < 2 or waits.intersection(small):
            waits.update(small)
            continue
        if not small:
            continue
        if len(small) == 2:
            kept, other = sorted(small, key=lambda x: (-len(members[x]), x))
            top[other] = kept
            size[kept] += size.pop(other)
            members[kept] += members.pop(other)
            name = min(members[kept]) if size[kept] >= min_size else None
        else:
            (kept,), name = small, next(n for n in names if n is not None)
        if name is not None:
            entered |= dict.fromkeys(members[kept], (name, tuple(key)))
    least = {root: min(of) for root, of in members.items()}
    return [(n, *entered[n]) if n in entered else (n, least[find(n)], None) for n in sizes]


def _settle(small: DataFrame, edges: DataFrame, min_size: int) -> DataFrame:
    """(component, into, by) for ``small`` (home, component, size) by ``edges`` (home, w, p, q, a, b), each home in a task.

    Components of size ``min_size`` are large from the start and stay as they are.  Ends outside of a home are unknown, unless ``a_large`` or ``b_large``.
    """
    shape = "component bigint, into bigint, by struct<w: double, p: bigint, q: bigint>"

    def settle(key: tuple, nodes: pa.Table, edges: pa.Table) -> pa.Table:
        sizes = dict(zip(nodes["component"].to_pylist(), nodes["size"].to_pylist(), strict=True))
        ends = {c: edges[c].to_pylist() for c in ("a", "b", "a_large", "b_large")}
        large = {x for c in "ab" for x, known in zip(ends[c], ends[f"{c}_large"], strict=True) if known} | {n for n, size in sizes.items() if size >= min_size}
        found = _enter_in_order({n: size for n, size in sizes.items() if n not in large}, large, list(zip(*(edges[c].to_pylist() for c in EDGE), ends["a"], ends["b"], strict=True)), min_size)
        by = pa.array([e and dict(zip(EDGE, e, strict=True)) for _, _, e in found], pa.struct([("w", pa.float64()), ("p", pa.int64()), ("q", pa.int64())]))
        return pa.table({"component": pa.array([n for n, _, _ in found], pa.int64()), "into": pa.array([c for _, c, _ in found], pa.int64()), "by": by})

    edges = edges.select(F.col("home").alias("of"), *EDGE, "a", "b", "a_large", "b_large")
    return small.groupBy("home").cogroup(edges.groupBy("of")).applyInArrow(settle, shape)


def enter_by_groups(tree: DataFrame, points: DataFrame, homes: DataFrame, min_size: int) -> DataFrame:
    """State (node, copies, component, entry) after what each group of points can tell by its own edges and those that leave it.

    Groups are made of the components ``homes`` (node, component), of at most ``GROUP`` points each.  They hold most light edges, so few points wait.
    """
    start = points.select("node", "copies", F.col("node").alias("component"), F.when(F.col("copies") >= min_size, F.struct(F.lit(0.0).alias("w"), F.col("node").alias("p"), F.col("node").alias("q"))).alias("entry"))
    groups = 1 + 8 * (n // GROUP) if (n := points.count()) > GROUP else 1
    home = homes.select("node", F.pmod(F.xxhash64("component"), F.lit(groups)).alias("home"))
    ends = tree.join(home.select(F.col("node").alias("p"), F.col("home").alias("one")), "p").join(home.select(F.col("node").alias("q"), F.col("home").alias("two")), "q")
    own = ends.select(F.explode(F.array_distinct(F.array("one", "two"))).alias("home"), *EDGE, F.col("p").alias("a"), F.col("q").alias("b"), F.lit(False).alias("a_large"), F.lit(False).alias("b_large"))
    small = points.join(home, "node").select("home", F.col("node").alias("component"), F.col("copies").alias("size"))
    return moved(start, written(_settle(small, own, min_size), "moves"))


def moved(state: DataFrame, moves: DataFrame) -> DataFrame:
    """``state`` after ``moves`` (component, into, by)."""
    return state.join(moves, "component", "left").select("node", "copies", F.coalesce("into", "component").alias("component"), F.coalesce("entry", "by").alias("entry"))


def _round_of_moves(along: DataFrame, min_size: int) -> DataFrame:
    """(component, into, by) after one round over ``along`` (component, size, by, to): small components and their lightest edges."""
    # Every small component points along its lightest edge.  What ends at a large one enters there, each by its own edge.
    large = along.select(F.col("to").alias("component")).join(along.select("component"), "component", "left_anti").distinct()
    pointers = _rooted(along.select("component", "to")).unionByName(large.select("component", F.col("component").alias("to")))
    reached = _follow(pointers).join(large.select(F.col("component").alias("root")), "root").where("component <> root")
    absorbed = reached.join(along.select("component", "by"), "component").select("component", F.col("root").alias("into"), "by")
    # Two that point to each other become one, named by the smaller; it is a leaf if it is large now.
    back = along.select(F.col("component").alias("to"), F.col("to").alias("component"), F.col("size").alias("more"))
    grown = along.join(back, ["component", "to"]).select("component", F.least("component", "to").alias("into"), F.when(F.col("size") + F.col("more") >= min_size, F.col("by")).alias("by"))
    return absorbed.unionByName(grown)


def enter_large(tree: DataFrame, points: DataFrame, homes: DataFrame, min_size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables (node, copies, leaf, entry), (leaf, birth) and the edges (a, b, w, p, q) between leaves.

    A leaf is a component that has grown to ``min_size`` rows by its edge ``birth``; ``entry`` is the edge by which a point
    enters a large component, that of the leaf or a later one that contains it.  ``leaf`` is null if all rows together are too few.
    """
    state = written(enter_by_groups(tree, points, homes, min_size), "state")
    edges = written(join_labels(tree.select(*EDGE), state.select("node", "component")), "edges")
    while True:
        # A large component has entries and a small one has none.
        small = state.where("entry IS NULL").groupBy("component").agg(F.sum("copies").alias("size"))
        best = lightest(edges).select("component", "best.*")
        along = small.join(best, "component").join(edges.select("p", "q", "a", "b"), ["p", "q"])
        other = F.when(F.col("a") == F.col("component"), F.col("b")).otherwise(F.col("a"))
        along = written(along.select("component", "size", F.struct(*EDGE).alias("by"), other.alias("to")), "along")
        if along.isEmpty():
            break
        if along.count() <= GROUP:
            # What still waits fits one task, with all its edges.
            known = edges.join(small.select(F.col("component").alias("a"), F.lit(True).alias("a_small")), "a", "left").join(small.select(F.col("component").alias("b"), F.lit(True).alias("b_small")), "b", "left").where("a_small OR b_small")
            known = known.select(F.lit(0).alias("home"), *EDGE, "a", "b", F.col("a_small").isNull().alias("a_large"), F.col("b_small").isNull().alias("b_large"))
            moves = _settle(along.select(F.lit(0).alias("home"), "component", "size"), known, min_size)
        else:
            moves = _round_of_moves(along, min_size)
        state = written(moved(state, written(moves, "moves")), "state")
        edges = written(join_labels(edges.select(*EDGE), state.select("node", "component")), "edges")
    leaf = F.when(F.col("entry").isNotNull(), F.col("component"))
    entered = written(state.select("node", "copies", leaf.alias("leaf"), "entry"), "entered")
    # The edge that made a leaf is the first by which its points entered it.
    births = written(entered.where("leaf IS NOT NULL").groupBy("leaf").agg(F.min("entry").alias("birth")), "births")
    return entered, births, edges


# --- the tree of large components --------------------------------------------------------


class ClusterTree(NamedTuple):
    """Clusters 0 ... n-1 are the leaves, the others are made where two meet; keys (w, p, q) tell by which edge each was made."""

    leaves: np.ndarray
    keys: np.ndarray
    parent: np.ndarray


def cluster_tree(births: DataFrame, edges: DataFrame) -> ClusterTree:
    """Joins of large components in the order of their edges (union-find over at most ``MAX_LEAVES`` leaves)."""
    n = births.count()
    if n > MAX_LEAVES:
        raise ValueError(f"{n} small clusters: take a larger min_cluster_size")
    own = births.select("leaf", "birth.*").orderBy("leaf").toArrow()
    joins = edges.select("a", "b", *EDGE).orderBy(*EDGE).toArrow()
    leaves = own["leaf"].to_numpy()
    key = np.dtype([("w", float), ("p", np.int64), ("q", np.int64)])
    keys, parent = np.zeros(max(0, 2 * n - 1), key), np.full(max(0, 2 * n - 1), -1)
    for c in EDGE:
        keys[c][:n], keys[c][n:] = own[c].to_numpy(), joins[c].to_numpy()
    top, at = list(range(n)), np.searchsorted(leaves, np.stack([joins["a"].to_numpy(), joins["b"].to_numpy()])) if n else np.zeros((2, 0), int)
    cluster = np.arange(n)

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for made, (a, b) in enumerate(at.T.tolist(), n):
        a, b = find(a), find(b)
        parent[[cluster[a], cluster[b]]] = made
        top[b], cluster[a] = a, made
    return ClusterTree(leaves, keys, parent)


def owners(tree: ClusterTree, leaf: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """The cluster that each point enters: the last one above its leaf that was made before its entry."""
    at = np.searchsorted(tree.leaves, leaf)
    lift = [np.where(tree.parent >= 0, tree.parent, np.arange(len(tree.parent)))]
    while len(lift) < max(1, int(len(tree.parent)).bit_length()):
        lift.append(lift[-1][lift[-1]])
    for up in reversed(lift):
        nxt = up[at]
        made = tree.keys[nxt]
        before = (made["w"] < entry["w"]) | ((made["w"] == entry["w"]) & ((made["p"] < entry["p"]) | ((made["p"] == entry["p"]) & (made["q"] <= entry["q"]))))
        at = np.where(before & (nxt != at), nxt, at)
    return at


def density_of(w: np.ndarray) -> np.ndarray:
    return 1 / np.maximum(w, LEAST_WEIGHT)


def select_clusters(tree: ClusterTree, rows: np.ndarray, mass: np.ndarray, allow_single: bool = False) -> np.ndarray:
    """For each cluster the chosen one that it belongs to, or -1; ``rows`` and ``mass`` (sum of densities at entry) of its own points.

    A cluster is chosen if the excess of mass of itself, over the density at which it parts from its sibling, is not less than
    that of the best choice below it.  The root is chosen only if ``allow_single``.
    """
    n = len(tree.parent)
    born = np.where(tree.parent >= 0, density_of(tree.keys["w"][tree.parent]), 0.0)
    size, excess, below = rows.astype(float), mass - rows * born, np.zeros(n)
    made = density_of(tree.keys["w"])
    for c in range(n):
        p = tree.parent[c]
        best = max(excess[c], below[c])
        if p >= 0:
            size[p] += size[c]
            excess[p] += size[c] * (made[p] - born[p])
            below[p] += best
    chosen = np.full(n, OUTLIER)
    for c in range(n - 1, -1, -1):
        p = tree.parent[c]
        if p >= 0 and chosen[p] != OUTLIER:
            chosen[c] = chosen[p]
        elif excess[c] >= below[c] and (p >= 0 or allow_single):
            chosen[c] = c
    return chosen


def varying_topics(vectors: DataFrame, column: str, min_samples: int, min_cluster_size: int, allow_single: bool = False, key: str = "unit_id") -> DataFrame:
    """(``key``, topic_id) of rows with vectors of one length in ``column``: clusters by excess of mass, numbered from the largest; outliers -1.

    Equal vectors are one point with copies, so a third of all rows may share a vector.  Fewer rows than ``min_samples``
    or ``min_cluster_size``, and one density without a split (unless ``allow_single``), are all outliers.  Clusters of one size are
    numbered by their smallest key.
    """
    if min_samples < 1 or min_cluster_size < 2:
        raise ValueError("min_samples is 1 and min_cluster_size 2 at least")
    members, points = distinct_points(vectors, key, column)
    total = members.count()
    if total < max(min_samples, min_cluster_size):
        return members.select(key, F.lit(OUTLIER).alias("topic_id"))
    packed = blocks(points)
    near = nearest_neighbours(packed, min_samples, min_samples)
    tree_edges, homes = tree_and_homes(packed, near)
    entered, births, edges = enter_large(tree_edges, points, homes, min_cluster_size)
    tree = cluster_tree(births, edges)

    @F.pandas_udf("int")
    def owner(leaf: pd.Series, w: pd.Series, p: pd.Series, q: pd.Series) -> pd.Series:
        entry = {"w": w.to_numpy(), "p": p.to_numpy(), "q": q.to_numpy()}
        return pd.Series(owners(tree, leaf.to_numpy(), entry)).astype("int32")

    placed = written(entered.select("node", "copies", owner("leaf", "entry.w", "entry.p", "entry.q").alias("cluster"), F.greatest("entry.w", F.lit(LEAST_WEIGHT)).alias("w")), "placed")
    sums = placed.groupBy("cluster").agg(F.sum("copies").alias("rows"), F.sum(F.col("copies") / F.col("w")).alias("mass")).toArrow()
    rows, mass = np.zeros(len(tree.parent), np.int64), np.zeros(len(tree.parent))
    rows[sums["cluster"].to_numpy()], mass[sums["cluster"].to_numpy()] = sums["rows"].to_numpy(), sums["mass"].to_numpy()
    chosen = select_clusters(tree, rows, mass, allow_single)

    @F.pandas_udf("int")
    def choice(cluster: pd.Series) -> pd.Series:
        return pd.Series(chosen[cluster.to_numpy()]).astype("int32")

    found = written(members.join(placed.select("node", choice("cluster").alias("cluster")), "node").select(key, "cluster"), "clustered")
    sizes = found.where(f"cluster <> {OUTLIER}").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).toArrow().to_pandas()
    ordered = sizes.sort_values(["n", "first"], ascending=[False, True])["cluster"].tolist()
    number = np.full(len(chosen) + 1, OUTLIER)
    number[ordered] = np.arange(len(ordered))

    @F.pandas_udf("int")
    def topic(cluster: pd.Series) -> pd.Series:
        return pd.Series(number[cluster.to_numpy()]).astype("int32")

    return found.select(key, topic("cluster").alias("topic_id"))
