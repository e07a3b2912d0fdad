"""Mixing sources to target weights, with DataFrame operations only.

Documents hang in a tree, by default domain, language and source.  A budget of tokens runs down the tree: at every node it is
shared among the children by their weights; a child that cannot take its share (all its documents, ``epochs`` times)
takes what it can, and the rest goes to its siblings by their weights.  A shortage leaves a subtree only when the whole
subtree is used up.  Each leaf turns its share into whole passes over its documents and the beginning of one more pass,
in an order seeded for that pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

TREE = ("domain", "lang", "source")
NONE = "(none)"
#: Words; the tokens that budgets are counted in.
TOKENS = r"CAST(regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS BIGINT)"
#: Bits of a document's 60-bit place in a pass, and those that each of two narrowing steps looks at.
PLACE_BITS, STEP_BITS = 60, 12


def place(seed: int, epoch: Column) -> Column:
    """Place of a document in a seeded pass: 60 bits of a digest of seed, pass and id.  Rows of one id share a place."""
    said = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, PLACE_BITS // 4), 16, 10).cast("bigint")


def share(nodes: DataFrame, parent: Sequence[str], name: Sequence[str]) -> DataFrame:
    """Adds ``share``: ``given`` of the parent divided among the siblings by integer ``weight``, none above its ``room``.

    In order of room for each unit of weight, a node is full if its room is not above its part of what is left; the
    nodes behind divide the rest in proportion, rounded so that the parts add up.
    """
    whole = "decimal(20,0)"
    order = Window.partitionBy(*parent).orderBy((F.col("room") / F.col("weight")).asc(), *name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(*parent)
    sized = nodes.withColumn("left", F.col("given") - F.coalesce(F.sum("room").over(before), F.lit(0))).withColumn("heavy", F.sum("weight").over(onwards))
    full = F.col("room").cast(whole) * F.col("heavy").cast("decimal(18,0)") <= F.col("left").cast(whole) * F.col("weight").cast("decimal(18,0)")
    sized = sized.withColumn("full", full)
    rest = F.col("given") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(every)
    thirsty = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    sized = sized.withColumn("rest", rest).withColumn("all", F.sum(thirsty).over(every)).withColumn("sofar", F.sum(thirsty).over(upto))
    part = "(CAST(rest AS decimal(20,0)) * CAST({} AS decimal(18,0))) div all"
    open_share = F.expr(f"{part.format('sofar')} - {part.format('(sofar - weight)')}")
    return sized.withColumn("share", F.when(F.col("full"), F.col("room")).otherwise(open_share)).drop("left", "heavy", "full", "rest", "all", "sofar")


def allot(leaves: DataFrame, budget: int | Column, weights: dict[str, str], epochs: int, tree: Sequence[str] = TREE) -> DataFrame:
    """Leaves (tree columns, ``have`` tokens) with their ``share`` of the budget.

    ``weights`` gives for each tree column an SQL expression of an integer over the columns from the root down to it;
    a node of weight 0 or null gets nothing.
    """
    made = leaves.where(reduce(Column.__and__, [F.expr(weights[c]) > 0 for c in tree])).withColumn("room", F.col("have") * epochs)
    shares = None
    for depth, column in enumerate(tree):
        path = list(tree[: depth + 1])
        nodes = made.groupBy(*path).agg(F.sum("room").alias("room")).withColumn("weight", F.expr(weights[column]).cast("bigint"))
        if shares is None:
            nodes = nodes.withColumn("given", budget if isinstance(budget, Column) else F.lit(budget).cast("bigint"))
        else:
            nodes = nodes.join(shares, path[:-1])
        shares = share(nodes, path[:-1], path).select(*path, F.col("share").alias("given"))
    return leaves.join(shares, list(tree), "left").withColumn("share", F.coalesce("given", F.lit(0).cast("bigint"))).drop("given")


def _narrow(rows: DataFrame, plan: DataFrame, tree: list[str], step: int) -> DataFrame:
    """One step towards the last place that each leaf takes: which slice of the places holds it, and the tokens before that slice."""
    shift = PLACE_BITS - STEP_BITS * step
    at = rows.join(plan.where("rest > 0").select(*tree, "slice", "passed", "rest"), tree)
    at = at.where(F.shiftright("place", shift + STEP_BITS) == F.col("slice")) if step > 1 else at
    sums = at.groupBy(*tree, "rest", "passed", F.shiftright("place", shift).alias("next")).agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy(*tree).orderBy("next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("reached", F.col("passed") + F.sum("n").over(upto))
    crossing = sums.where(F.col("reached") > F.col("rest")).groupBy(*tree).agg(F.min("next").alias("slice"), F.min_by(F.col("reached") - F.col("n"), "next").alias("passed"))
    return plan.drop("slice", "passed").join(staged(crossing, "slices"), tree, "left")


def plan_leaves(docs: DataFrame, budget_share: float, weights: dict[str, str], epochs: int, seed: int, tree: Sequence[str] = TREE) -> DataFrame:
    """One row per leaf: have, share, whole passes, rest, and ``last``: the last place that the begun pass takes (-1: none).

    The begun pass takes documents in order of their places while their tokens together stay within the rest.  The last
    place is found from sums over slices of places, 2^12 of a leaf and then 2^12 of the slice that crosses the rest, so
    that no task ever holds a leaf; only the documents of the last slice, one in 2^24 of a leaf, are put in order.
    """
    names = list(tree)
    sized = staged(docs.select("doc_id", *names, F.expr(TOKENS).alias("n_tokens")), "sized")
    leaves = staged(sized.groupBy(*names).agg(F.sum("n_tokens").alias("have")), "leaves")
    total = leaves.agg(F.sum("have")).first()[0] or 0
    shares = allot(leaves, int(total * budget_share), weights, epochs, tree)
    passes = F.when(F.col("have") > 0, F.expr("share div have")).otherwise(0)
    plan = shares.withColumn("passes", passes).withColumn("rest", F.col("share") - F.col("passes") * F.col("have"))
    plan = staged(plan.withColumn("slice", F.lit(0).cast("bigint")).withColumn("passed", F.lit(0).cast("bigint")), "plan")
    rows = staged(sized.join(plan.where("rest > 0").select(*names, "passes"), names).select(*names, "n_tokens", place(seed, F.col("passes")).alias("place")), "places")
    plan = staged(_narrow(rows, plan, names, 1), "plan")
    plan = staged(_narrow(rows, plan, names, 2), "plan")
    last = rows.join(plan.where("rest > 0").select(*names, "slice", "passed", "rest"), names)
    last = last.where(F.shiftright("place", PLACE_BITS - 2 * STEP_BITS) == F.col("slice"))
    last = last.groupBy(*names, "rest", "passed", "place").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy(*names).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = last.withColumn("reached", F.col("passed") + F.sum("n").over(upto)).where(F.col("reached") > F.col("rest"))
    first_left = staged(over.groupBy(*names).agg(F.min("place").alias("stop")), "stops")
    plan = plan.join(first_left, names, "left")
    # Without a crossing place the rest is never used up, which only a rest of 0 does: nothing is taken then.
    taken = F.when(F.col("rest") == 0, F.lit(-1)).otherwise(F.col("stop") - 1)
    return staged(plan.withColumn("last", taken.cast("bigint")).select(*names, "have", "share", "passes", "rest", "last"), "leaf_plan")


def copies(docs: DataFrame, plan: DataFrame, seed: int, tree: Sequence[str] = TREE) -> DataFrame:
    """``docs`` with ``n_copies``: in how many passes of its leaf each row is."""
    names = list(tree)
    picked = docs.join(plan.select(*names, "passes", "last"), names)
    begun = (place(seed, F.col("passes")) <= F.col("last")).cast("bigint")
    return picked.withColumn("n_copies", F.col("passes") + F.coalesce(begun, F.lit(0))).drop("passes", "last")


def with_tree(docs: DataFrame, domain: str, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """doc_id, text and the tree's columns as texts, null as its own branch; ``domain`` is an SQL expression."""
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("lang", "source"))
    return docs.select(*columns, F.coalesce(F.expr(domain).cast("string"), F.lit(NONE)).alias("domain"), lang, source)


def mix(docs: DataFrame, domain: str, weights: dict[str, str], budget_share: float, epochs: int, seed: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang, source): doc_id, domain, lang, source, n_tokens and n_copies.

    Null texts have no tokens, and empty documents are in every pass that takes their place; repeated rows of a doc_id are taken or
    left together; nulls in tree columns are a branch ``(none)``.
    """
    rows = with_tree(docs, domain)
    plan = plan_leaves(rows, budget_share, weights, epochs, seed)
    found = copies(rows, plan, seed)
    return found.select("doc_id", *TREE, F.expr(TOKENS).alias("n_tokens"), "n_copies")


def mixed(docs: DataFrame, domain: str, weights: dict[str, str], budget_share: float, epochs: int, seed: int) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say; columns as given."""
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = with_tree(docs.withColumn("own", F.struct(*own)), domain, ("doc_id", "text", "own"))
    plan = plan_leaves(rows.drop("own"), budget_share, weights, epochs, seed)
    found = copies(rows, plan, seed).where("n_copies > 0")
    found = found.withColumn("nth", F.explode(F.expr("sequence(1L, n_copies)")))
    return found.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"own.`{c}`").alias(c) for c in docs.columns])
