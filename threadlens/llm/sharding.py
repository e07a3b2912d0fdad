"""Shards of nearly equal bytes, close in their metadata: a k-d tree with distributed weighted medians, DataFrame operations only.

The root holds all documents and owes all shards.  A node that owes several shards is split at the dimension in which it
is widest (against the whole table's width), where the bytes on both sides stand as the shards that each side will
owe.  The place is found for all nodes of a level at once, from sums of bytes in ever smaller slices of the dimension, so no task sorts
or holds a node.  Documents that stand at one place, as those of one huge source do, are told apart by a hash of their row, so
they can be divided too.  Leaves are the shards, numbered from left to right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_path, staged

#: Bits of a row's place in its node's widest dimension, and those of the hash that orders rows of one place.
PLACE_BITS, HASH_BITS = 20, 22
#: A place and hash are narrowed down by so many bits at a time: 2^14 sums for each node of a level.
STEP_BITS = 14
#: What a document costs besides its text.
OVERHEAD = 8


def name_place(column: str) -> str:
    """A number in the order of names: their first six bytes."""
    return f"CAST(conv(rpad(hex(substring(CAST({column} AS binary), 1, 6)), 12, '0'), 16, 10) AS double)"


#: Dimensions of ``documents``: SQL expressions of a number; null and not-a-number count as 0.
DIMENSIONS = (name_place("lang"), name_place("source"), "CAST(n_chars AS double)", "CAST(doc_id AS double)")


def numbered(docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS, own: Sequence[Column] = ()) -> DataFrame:
    """A written table: row (a number of its own), doc_id, size, text_crc32, dimensions d0, d1 ... and the columns ``own``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    places = [F.coalesce(F.nanvl(F.expr(d), F.lit(0.0)), F.lit(0.0)).alias(f"d{i}") for i, d in enumerate(dimensions)]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *places,
        *own,
    )
    return staged(rows, "numbered")


def _per_dimension(n: int, what: str) -> Column:
    return F.array(*[F.expr(what.format(i)) for i in range(n)])


def _narrow(rows: DataFrame, nodes: DataFrame, n: int, step: int) -> DataFrame:
    """One step towards each node's cut: which slice of the keys crosses the left side's bytes, and the bytes before it."""
    shift = PLACE_BITS + HASH_BITS - STEP_BITS * step
    at = _keyed(rows, nodes, n, "inner").where(F.shiftright("key", shift + STEP_BITS) == F.col("slice"))
    own = ["first", "dim", "low", "high", "goal"]
    sums = at.groupBy(*own, "passed", F.shiftright("key", shift).alias("next")).agg(F.sum("size").alias("bytes"))
    upto = Window.partitionBy("first").orderBy("next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("reached", F.col("passed") + F.sum("bytes").over(upto))
    # The last slice is reached by all bytes, so every node that owes more than one shard crosses somewhere.
    crossing = sums.where("reached > goal").groupBy(*own).agg(F.min("next").alias("slice"), F.min_by(F.expr("reached - bytes"), "next").alias("passed"))
    return staged(crossing, "cuts")


def _level(rows: DataFrame, widths: Sequence[float], n: int) -> DataFrame:
    """One row per node that owes shards: its bytes, widest dimension, borders, and the key that cuts it."""
    low, high = ([F.min(f"d{i}") for i in range(n)], [F.max(f"d{i}") for i in range(n)])
    nodes = rows.where("owes > 1").groupBy("first", "owes").agg(F.sum("size").alias("bytes"), F.array(*low).alias("lows"), F.array(*high).alias("highs"))
    spread = F.array(*[(F.col("highs")[i] - F.col("lows")[i]) / w if w > 0 else F.lit(0.0) for i, w in enumerate(widths)])
    nodes = nodes.withColumn("spread", spread).withColumn("dim", F.expr("CAST(array_position(spread, array_max(spread)) AS INT) - 1"))
    goal = F.expr("CAST(floor(CAST(bytes AS decimal(20,0)) * (owes div 2) / owes) AS bigint)")
    start = [F.lit(0).cast("bigint").alias(c) for c in ("slice", "passed")]  # the one slice of all keys
    nodes = nodes.select("first", "dim", F.col("lows")[F.col("dim")].alias("low"), F.col("highs")[F.col("dim")].alias("high"), goal.alias("goal"), *start)
    nodes = staged(nodes, "nodes")
    for step in range(1, (PLACE_BITS + HASH_BITS) // STEP_BITS + 1):
        nodes = _narrow(rows, nodes, n, step)
    return nodes.select("first", "dim", "low", "high", F.col("slice").alias("cut"))


def _keyed(rows: DataFrame, nodes: DataFrame, n: int, how: str) -> DataFrame:
    """Rows with their node's columns and their key in it: the place in its widest dimension, then a hash of the row."""
    own = rows.join(F.broadcast(nodes), "first", how)
    value = _per_dimension(n, "d{}")[F.coalesce(F.col("dim"), F.lit(0))]
    place = F.when(F.col("high") > F.col("low"), F.floor((value - F.col("low")) / (F.col("high") - F.col("low")) * ((1 << PLACE_BITS) - 1))).otherwise(0)
    key = F.shiftleft(place.cast("bigint"), HASH_BITS) + F.xxhash64("row").bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    return own.withColumn("key", key)


def _split(rows: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """Rows below their node's cut go to its left half, the others to its right one."""
    left = F.expr("owes > 1 AND key < cut")
    half = F.expr("owes div 2")
    first = F.when(F.col("owes") == 1, F.col("first")).when(left, F.col("first")).otherwise(F.col("first") + half)
    owes = F.when(F.col("owes") == 1, F.lit(1)).when(left, half).otherwise(F.col("owes") - half)
    moved = {"first": first.cast("bigint"), "owes": owes.cast("bigint")}
    return _keyed(rows, nodes, n, "left").withColumns(moved).select(*rows.columns)


def shards(rows: DataFrame, n_shards: int, n_dimensions: int) -> DataFrame:
    """``rows`` of ``numbered`` with their ``shard`` (0 to ``n_shards`` - 1)."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    ends = rows.agg(*[F.max(f"d{i}") - F.min(f"d{i}") for i in range(n_dimensions)]).first()
    widths = [float(w or 0) for w in ends]
    placed = rows.withColumn("first", F.lit(0).cast("bigint")).withColumn("owes", F.lit(n_shards).cast("bigint"))
    for _ in range((n_shards - 1).bit_length()):
        # Each level is written, so that the plans which the driver keeps stay as small as those of the first level.
        placed = staged(_split(placed, _level(placed, widths, n_dimensions), n_dimensions), "level")
    return placed.withColumn("shard", F.col("first").cast("int")).drop("first", "owes")


def slots(placed: DataFrame) -> DataFrame:
    """``placed`` with ``slot``: 0, 1, 2 ... within each shard, in the order of the table.

    Rows are counted for each shard and part of the written table (the upper bits of ``row``), these counts are added
    up, and only the rows of one shard in one part are put in order together.
    """
    part = F.shiftright("row", 33)
    rows = placed.withColumn("part", part)
    counts = staged(rows.groupBy("shard", "part").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("row")
    rows = rows.withColumn("nth", F.row_number().over(within) - 1)
    return rows.join(offsets, ["shard", "part"]).withColumn("slot", (F.col("offset") + F.col("nth")).cast("bigint")).drop("part", "nth", "offset")


def assign(docs: DataFrame, n_shards: int, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    The law is ``bytes``: sizes (UTF-8 bytes of the text and 8 more) of the shards are as near to equal as whole documents allow;
    a document larger than a shard's part fills one alone and the others share the rest unevenly.  Copies, rows that share or lack a
    doc_id and repeated rows are placed one by one, so that no group of them can overfill a shard.  A null text has size 8; nulls
    in a dimension count as 0; ``grown_shard`` is null.  An empty table gives an empty result, and with fewer rows than
    shards some shards stay empty.
    """
    rows = numbered(docs, dimensions)
    found = slots(staged(shards(rows, n_shards, len(dimensions)).select("row", "doc_id", "size", "text_crc32", "shard"), "placed"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, n_shards: int, dimensions: Sequence[str] = DIMENSIONS, path: str | None = None) -> str:
    """Write the rows of ``docs``, columns as given, as Parquet folders ``shard=0`` ... of a shared folder, and return it.

    Every shard is written by several tasks (by ranges of slots), so a shard may be larger than a task.
    """
    path = path or shared_path(docs.sparkSession, "shards")
    rows = numbered(docs, dimensions, [F.struct("*").alias("document")])
    found = staged(slots(shards(rows.drop("document"), n_shards, len(dimensions)).select("row", "shard")), "slots")
    out = rows.select("row", "document").join(found, "row")
    out = out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out.select("shard", "slot", "document").write.partitionBy("shard").parquet(path)
    return path
