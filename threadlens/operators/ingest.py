"""Ingest: naming, typing, row numbers, validation, quality counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import strip_text
from ..session import materialise

# Tried in this order after ISO forms; ambiguous day/month order reads month first.
TIMESTAMP_FORMATS = (
    "M.d.yyyy[ H:mm[:ss]]",
    "d.M.yyyy[ H:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "yyyy.M.d[ H:mm[:ss]]",
    "yyyyMMdd['T'HHmmss]",
    "MMM d, yyyy[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
)


class IngestError(ValueError):
    """The input breaks the export contract."""


def project_columns(raw: DataFrame, mapping: Mapping[str, str] = fixed.EXPORT_HEADER) -> DataFrame:
    """Rename the configured source columns to canonical ones and drop the rest."""
    missing = [source for source in mapping.values() if source not in raw.columns]
    if missing:
        raise IngestError(f"missing required input columns: {missing}")
    extra = ["source_row_id"] if "source_row_id" in raw.columns else []
    return raw.select(*extra, *[F.col(f"`{source}`").alias(name) for name, source in mapping.items()])


def with_row_id(df: DataFrame, order_by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based ``source_row_id`` in input order, or in ``order_by`` order.

    The rows are written out once so that numbering sees the same partitions in
    both passes; only one (partition, offset) pair per partition is broadcast.
    """
    if order_by:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    staged = materialise(df.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    sizes = staged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    position = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.join(F.broadcast(offsets), part == F.col("__part")).select(
        (F.col("__offset") + position).alias("source_row_id"), *df.columns
    )


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Lenient per-row timestamp parsing: ISO first, then each format; null when nothing fits."""
    stripped = F.trim(text)
    return F.coalesce(
        stripped.try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(stripped, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats],
    )


def normalise(named: DataFrame, formats: Sequence[str] = TIMESTAMP_FORMATS) -> DataFrame:
    """Typed canonical columns: no null strings, trimmed keys, parsed time (null if unparsable)."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    time = F.col("timestamp")
    parsed = parse_timestamp(time, formats) if dict(named.dtypes)["timestamp"] == "string" else time.cast("timestamp_ntz")
    return named.select(
        F.col("source_row_id").cast("bigint").alias("source_row_id"),
        parsed.alias("timestamp"),
        strip_text(text("user")).alias("user"),
        strip_text(text("chat_uuid")).alias("chat_uuid"),
        text("chat_title").alias("chat_title"),
        strip_text(text("role")).alias("role"),
        text("message").alias("message"),
    )


def rejects(canonical: DataFrame) -> DataFrame:
    """Rows that break the contract, each with its reason; an unparsable time is named first."""
    reason = F.when(F.col("timestamp").isNull(), "timestamp").when(F.col("chat_uuid") == "", "chat_uuid")
    return canonical.select("source_row_id", reason.alias("reason")).where(F.col("reason").isNotNull())


def validate(canonical: DataFrame, on_error: str = "raise", shown: int = 10) -> DataFrame:
    """Raise on rejected rows, naming the first ids, or drop them (``on_error="quarantine"``).

    With quarantine, store :func:`rejects` next to the result so nothing is lost.
    """
    if on_error not in ("raise", "quarantine"):
        raise ValueError(f"unknown on_error: {on_error}")
    if on_error == "quarantine":
        return canonical.where(F.col("timestamp").isNotNull() & (F.col("chat_uuid") != ""))
    ranked = rejects(canonical).orderBy(F.col("reason").desc(), "source_row_id").limit(shown).collect()
    if ranked:
        reason = ranked[0].reason
        ids = [row.source_row_id for row in ranked if row.reason == reason]
        problem = "cannot parse timestamp" if reason == "timestamp" else "empty chat_uuid"
        raise IngestError(f"{problem} in rows {ids}")
    return canonical


def quality_report(canonical: DataFrame) -> DataFrame:
    """One row of counters.  Roles are compared case-sensitively here.

    Users and chats are counted over their distinct pairs, so that the two
    distinct counts do not multiply the input rows.
    """
    pairs = canonical.groupBy("user", "chat_uuid").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("role") == "user").alias("user_rows"),
        F.count_if(F.col("role") == "assistant").alias("assistant_rows"),
        F.count_if(strip_text(F.col("message")) == "").alias("empty_message_rows"),
    )
    counters = ("total_rows", "user_rows", "assistant_rows", "empty_message_rows")
    return pairs.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters],
        F.count_distinct("user").alias("unique_users"),
        F.count_distinct("chat_uuid").alias("unique_chats"),
    )


def canonical_rows(
    raw: DataFrame,
    mapping: Mapping[str, str] = fixed.EXPORT_HEADER,
    order_by: Sequence[str] = (),
    formats: Sequence[str] = TIMESTAMP_FORMATS,
) -> DataFrame:
    """Raw export -> canonical table, not yet validated.  A ``source_row_id`` already present is kept."""
    named = project_columns(raw, mapping)
    if "source_row_id" not in named.columns:
        named = with_row_id(named, order_by)
    return normalise(named, formats)


def ingest(raw: DataFrame, *args, on_error: str = "raise", **options) -> DataFrame:
    """:func:`canonical_rows`, validated."""
    return validate(canonical_rows(raw, *args, **options), on_error)
