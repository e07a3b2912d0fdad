"""Analysis units: one per message, or messages of one user in one chat merged over time."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..options import MessageOptions, UnitOptions
from ..session import materialise
from .messages import calendar_features, drop_duplicates, filter_messages, text_features, user_messages

UNIT_COLUMNS = (
    "unit_id", "chat_uuid", "user", "chat_title", "start_ts", "end_ts", "timestamp", "n_messages", "text",
    "modeling_text", "text_len_chars", "text_len_words", "modeling_len_tokens", "date", "week", "month",
)


def message_unit_id(row_id: Column) -> Column:
    return F.format_string("message-%08d", row_id)


def message_units(messages: DataFrame, flags: Sequence[str] = tuple(fixed.DOMAIN_FLAGS)) -> DataFrame:
    """One unit per message; a projection."""
    return messages.select(
        message_unit_id(F.col("source_row_id")).alias("unit_id"),
        "chat_uuid",
        "user",
        "chat_title",
        F.col("timestamp").alias("start_ts"),
        F.col("timestamp").alias("end_ts"),
        "timestamp",
        F.lit(1).alias("n_messages"),
        F.col("message").alias("text"),
        F.col("message_for_modeling").alias("modeling_text"),
        F.col("message_len_chars").alias("text_len_chars"),
        F.col("message_len_words").alias("text_len_words"),
        F.col("message_modeling_len_tokens").alias("modeling_len_tokens"),
        "date",
        "week",
        "month",
        *flags,
        F.array("source_row_id").alias("source_row_ids"),
    )


# --- segmentation ------------------------------------------------------------


def _gap(minutes: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))


def _chunk(position: Column, max_rows: int) -> Column:
    """Whole number of full chunks before a 0-based position."""
    return F.floor(position / F.lit(max_rows)).cast("bigint")


def segment(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    row_id: str,
    max_gap_minutes: int,
    max_rows: int,
) -> DataFrame:
    """Number the segments of every group: adds ``segment_session`` and ``segment_chunk``.

    A session ends where the gap to the previous row exceeds the limit; inside a
    session every ``max_rows`` rows make a chunk.  (Either kind of cut resets the
    row count, so cutting sessions into equal chunks is exact.)  All windows use
    the same partitioning, so one exchange serves them and the aggregation after.
    """
    ordered = Window.partitionBy(*group).orderBy(time, row_id)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    gap = F.coalesce(F.col(time) - F.lag(time).over(ordered) > _gap(max_gap_minutes), F.lit(False))
    opened = F.when(F.col("__gap"), F.col("__row"))
    return (
        df.withColumns({"__gap": gap, "__row": F.row_number().over(ordered)})
        .withColumns({"segment_session": F.count(opened).over(running), "__opened": F.max(opened).over(running)})
        .withColumn("segment_chunk", _chunk(F.col("__row") - F.coalesce("__opened", F.lit(1)), max_rows))
        .drop("__gap", "__row", "__opened")
    )


#: Rows and bytes of text that fill a task, and rows that an id counts in a partition.
TASK_ROWS, TASK_BYTES, PLACES = 200_000, 64 << 20, 1 << 33


def slice_tasks(slices: int, rows: int, size: int, cores: int) -> int:
    """Tasks for so many slices of known rows and bytes: one a core at least, if there are so many slices."""
    return min(slices, max(cores, math.ceil(rows / TASK_ROWS), math.ceil(size / TASK_BYTES))) if rows else slices


def segment_sliced(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    row_id: str,
    max_gap_minutes: int,
    max_rows: int,
    slices: int,
    rows: int = 0,
    size: int = 0,
) -> DataFrame:
    """Same result as :func:`segment` for groups too big for one task.

    Rows are range-partitioned by (group, time, row id) into slices of about the
    same size, whatever the group sizes, and written out once with their slice
    number.  If their number and bytes of text (``rows``, ``size``) are given, a
    task cuts as many small slices as fill it, so the number of tasks follows
    the data and not the slices.  Each slice is numbered on its own; then one small row per (slice,
    group) is scanned to find what the earlier slices carry in: how many
    sessions went before, and how many rows of the session still open.
    """
    tasks = slice_tasks(slices, rows, size, df.sparkSession.sparkContext.defaultParallelism)
    ranged, number = df.repartitionByRange(tasks, *group, time, row_id), F.spark_partition_id().cast("bigint")
    if tasks < slices:
        # The id holds the partition and, in its lower bits, the place of the row there.
        ranged, place = ranged.sortWithinPartitions(*group, time, row_id), F.monotonically_increasing_id() % PLACES
        number = number * PLACES + F.floor(place / F.lit(math.ceil(rows / slices)))
    staged = materialise(ranged.withColumn("__slice", number))
    local = (*group, "__slice")
    ordered = Window.partitionBy(*local).orderBy(time, row_id)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    gap = F.coalesce(F.col(time) - F.lag(time).over(ordered) > _gap(max_gap_minutes), F.lit(False))
    opened = F.when(F.col("__gap"), F.col("__row"))
    numbered = (
        staged.withColumns({"__gap": gap, "__row": F.row_number().over(ordered)})
        .withColumns({"__session": F.count(opened).over(running), "__opened": F.max(opened).over(running)})
        .withColumn("__position", F.col("__row") - F.coalesce("__opened", F.lit(1)))
        .drop("__gap", "__row", "__opened")
    )

    # Per slice: time range, breaks inside, rows in its last session.
    per_session = numbered.groupBy(*local, "__session").agg(
        F.count(F.lit(1)).alias("__n"), F.min(time).alias("__first"), F.max(time).alias("__last")
    )
    by_slice = per_session.groupBy(*local).agg(
        F.min("__first").alias("__first"),
        F.max("__last").alias("__last"),
        F.max("__session").alias("__breaks"),
        F.max_by("__n", "__session").alias("__tail"),
    )
    across = Window.partitionBy(*group).orderBy("__slice")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    upto = across.rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("__first") - F.lag("__last").over(across) > _gap(max_gap_minutes), F.lit(False))
    carried = (
        by_slice.withColumn("__opens", opens.cast("bigint"))
        .withColumn("__start", F.sum("__opens").over(upto) + F.coalesce(F.sum("__breaks").over(before), F.lit(0)))
        .withColumn("__end", F.col("__start") + F.col("__breaks"))
    )
    same_end = Window.partitionBy(*group, "__end").orderBy("__slice").rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        carried.withColumn("__open_rows", F.sum("__tail").over(same_end))
        .withColumn("__previous_end", F.lag("__end").over(across))
        .withColumn("__previous_open", F.lag("__open_rows").over(across))
        .withColumn(
            "__carry",
            F.when(F.col("__previous_end") == F.col("__start"), F.col("__previous_open")).otherwise(F.lit(0)),
        )
        .select(*local, "__start", "__carry")
    )
    # One row per (slice, group): at most slices + groups rows, both bounded by the caller.
    position = F.col("__position") + F.when(F.col("__session") == 0, F.col("__carry")).otherwise(F.lit(0))
    return (
        numbered.join(carried, list(local))
        .withColumn("segment_session", F.col("__start") + F.col("__session"))
        .withColumn("segment_chunk", _chunk(position, max_rows))
        .select(*df.columns, "segment_session", "segment_chunk")
    )


# --- merged units ---------------------------------------------------------------


def _merge(segmented: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One unit per segment.  A segment holds at most ``max_messages`` rows, so collecting it is safe."""
    rows = F.struct("timestamp", "source_row_id", "message", "message_for_modeling", "chat_title")
    grouped = segmented.groupBy("chat_uuid", "user", "segment_session", "segment_chunk").agg(
        F.sort_array(F.collect_list(rows)).alias("__rows"),
        F.count(F.lit(1)).cast("int").alias("n_messages"),
        F.min("timestamp").alias("start_ts"),
        F.max("timestamp").alias("end_ts"),
        (F.sum("message_len_chars") + F.count(F.lit(1)) - 1).cast("int").alias("text_len_chars"),
        F.sum("message_len_words").cast("int").alias("text_len_words"),
        F.sum("message_modeling_len_tokens").cast("int").alias("modeling_len_tokens"),
        *[F.bool_or(flag).alias(flag) for flag in flags],
    )
    ids = F.col("__rows.source_row_id")
    digest = F.sha1(F.array_join(ids.cast("array<string>"), "|"))
    return grouped.select(
        F.concat(F.lit("merged-"), F.substring(digest, 1, 16)).alias("unit_id"),
        "chat_uuid",
        "user",
        F.col("__rows")[0]["chat_title"].alias("chat_title"),
        "start_ts",
        "end_ts",
        F.col("start_ts").alias("timestamp"),
        "n_messages",
        F.array_join("__rows.message", "\n").alias("text"),
        F.trim(F.array_join("__rows.message_for_modeling", " ")).alias("modeling_text"),
        "text_len_chars",
        "text_len_words",
        "modeling_len_tokens",
        *[column.alias(name) for name, column in calendar_features(F.col("start_ts")).items()],
        *flags,
        ids.alias("source_row_ids"),
    )


GROUP = ("chat_uuid", "user")
# Up to this size a list of group keys is shipped to all tasks.
BROADCAST_BYTES = 64 << 20


def hot_groups(
    rows: DataFrame, group: Sequence[str], limit_rows: int, limit_bytes: int, text: str | None
) -> tuple[DataFrame | None, int, int]:
    """Groups above either limit, and their rows and bytes of text in total.

    Reads the group, and the length of the text, and combines before the
    shuffle; the list is written out and its size checked.
    """
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0))) if text else F.lit(0)
    counted = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), size.cast("bigint").alias("__bytes"))
    hot = materialise(counted.where((F.col("n") > limit_rows) | (F.col("__bytes") > limit_bytes)))
    width = F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in group), F.lit(16)))
    found = hot.agg(F.sum("n").alias("rows"), F.sum("__bytes").alias("bytes"), width.alias("width")).first()
    if not found.rows:
        return None, 0, 0
    keys = hot.select(*group)
    return (F.broadcast(keys) if found.width <= BROADCAST_BYTES else keys), found.rows, found.bytes


def segment_all(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    row_id: str,
    max_gap_minutes: int,
    max_rows: int,
    options: UnitOptions = UnitOptions(),
    text: str | None = None,
) -> DataFrame:
    """:func:`segment` for groups of any size: those above the limits of ``options`` go in slices."""
    keys, rows, size = hot_groups(df, group, options.hot_group_rows, options.hot_group_bytes, text)
    limits = (group, time, row_id, max_gap_minutes, max_rows)
    if keys is None:
        return segment(df, *limits)
    hot, rest = df.join(keys, list(group), "left_semi"), df.join(keys, list(group), "left_anti")
    return segment(rest, *limits).unionByName(segment_sliced(hot, *limits, slice_count(rows, size, options), rows, size))


def slice_count(rows: int, size: int, options: UnitOptions) -> int:
    return max(2, math.ceil(rows / options.slice_rows), math.ceil(size / options.slice_bytes))


def _merged(
    rows: DataFrame,
    options: UnitOptions,
    flags: Sequence[str],
    clean: Callable[[DataFrame], DataFrame],
    distinct: Callable[[DataFrame], DataFrame],
    features: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``clean``, place by (chat, user), ``distinct``, segments, ``features``, one row per segment.

    One exchange serves all of it.  Groups above ``hot_group_rows`` or
    ``hot_group_bytes`` leave this plan: they are cut into slices instead.
    """
    limits = (options.max_gap_minutes, options.max_messages)
    order = (GROUP, "timestamp", "source_row_id")

    def plain(part: DataFrame) -> DataFrame:
        placed = clean(part).repartition(*GROUP)
        return _merge(features(segment(distinct(placed), *order, *limits)), flags)

    keys, hot_rows, hot_bytes = hot_groups(rows, GROUP, options.hot_group_rows, options.hot_group_bytes, "message")
    if keys is None:
        return plain(rows)
    hot = rows.join(keys, list(GROUP), "left_semi")
    slices = slice_count(hot_rows, hot_bytes, options)
    sliced = _merge(features(segment_sliced(distinct(clean(hot)), *order, *limits, slices, hot_rows, hot_bytes)), flags)
    return plain(rows.join(keys, list(GROUP), "left_anti")).unionByName(sliced)


def build_units(
    canonical: DataFrame,
    message_options: MessageOptions = MessageOptions(),
    options: UnitOptions = UnitOptions(),
) -> DataFrame:
    """Canonical messages -> analysis units plus ``source_row_ids`` for the unit-message map.

    In merged mode cleaning, de-duplication, segmentation and merging share one
    exchange.  Segments are numbered before the text features are computed, so
    the sorts below the windows move the message text and nothing derived from it.
    """
    flags = tuple(message_options.flags)
    if options.mode == "message":
        return message_units(user_messages(canonical, message_options), flags)
    if options.mode != "merged_messages":
        raise ValueError(f"unknown unit mode: {options.mode}")
    rows = canonical.where(F.lower("role") == message_options.role_keep.lower())
    return _merged(
        rows,
        options,
        flags,
        clean=lambda part: filter_messages(part, message_options).drop("message_raw"),
        distinct=lambda part: drop_duplicates(part, message_options),
        features=lambda part: text_features(part, message_options),
    )


def units_from_messages(
    messages: DataFrame, options: UnitOptions = UnitOptions(), flags: Sequence[str] = tuple(fixed.DOMAIN_FLAGS)
) -> DataFrame:
    """The same from an already written user-message table."""
    if options.mode == "message":
        return message_units(messages, flags)
    if options.mode != "merged_messages":
        raise ValueError(f"unknown unit mode: {options.mode}")

    def unchanged(part: DataFrame) -> DataFrame:
        return part

    return _merged(messages, options, flags, clean=unchanged, distinct=unchanged, features=unchanged)


def unit_message_map(units: DataFrame) -> DataFrame:
    """Bridge table: one row per (unit, source message)."""
    return units.select("unit_id", F.explode("source_row_ids").alias("source_row_id"))


def publish_units(units: DataFrame, flags: Sequence[str] = tuple(fixed.DOMAIN_FLAGS)) -> DataFrame:
    """The fixed 28-column unit table."""
    return units.select(*UNIT_COLUMNS, *flags)
