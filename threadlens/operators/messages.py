"""Message cleaning: filters, exact de-duplication, features, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import flag_columns
from ..functions.text import clean_text, modeling_text, word_count
from ..options import MessageOptions

DEDUP_KEY = ("chat_uuid", "timestamp", "user", "message")


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row of every key.

    ``rank = 1`` becomes a group limit below the exchange, so a key with any
    number of copies ships one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order_by))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def drop_trivial(df: DataFrame, trivial: Sequence[str] | DataFrame, column: str = "message") -> DataFrame:
    """Drop messages that are, without regard to case, one of a list of trivial ones.

    A list is inlined; a one-column table of them is anti-joined (Spark decides
    by its size whether to broadcast it).
    """
    lowered = F.lower(F.col(column))
    if isinstance(trivial, DataFrame):
        words = trivial.select(F.lower(clean_text(F.col(trivial.columns[0]))).alias("__trivial")).distinct()
        return df.join(words, lowered == F.col("__trivial"), "left_anti")
    if not trivial:
        return df
    return df.where(~lowered.isin([F.lower(clean_text(F.lit(item))) for item in trivial]))


def calendar_features(timestamp: Column) -> dict[str, Column]:
    """Day, ISO week and month as text, independent of the session time zone."""
    day = timestamp.cast("date")
    iso_year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return {
        "date": day.cast("string"),
        "week": F.concat(iso_year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")),
        "month": F.substring(day.cast("string"), 1, 7),
    }


def filter_messages(canonical: DataFrame, options: MessageOptions = MessageOptions()) -> DataFrame:
    """Role, emptiness, length, triviality; ``message`` becomes the cleaned text.

    Cleaning is the costly part, and a filter on the cleaned text would repeat it
    for every condition; exploding an array of at most one text runs it once.
    """
    kept = canonical.where(F.lower("role") == options.role_keep.lower())
    trivial = {" ".join(item.split()).lower() for item in options.trivial_messages} if options.drop_trivial else set()
    trivial = {item for item in trivial if len(item) >= options.min_chars}

    def wanted(text: Column) -> Column:
        long_enough = F.length(text) >= max(options.min_chars, 1)
        return long_enough & ~F.lower(text).isin(sorted(trivial)) if trivial else long_enough

    texts = F.filter(F.array(clean_text(F.col("message"))), wanted)
    others = [name for name in kept.columns if name != "message"]
    return kept.select(*others, F.col("message").alias("message_raw"), F.explode(texts).alias("message"))


def text_features(messages: DataFrame, options: MessageOptions = MessageOptions()) -> DataFrame:
    """Modelling text, lengths and flags of each cleaned message."""
    text = F.col("message")
    modeling = modeling_text(
        text,
        enabled=options.build_modeling_text,
        max_tokens=options.modeling_max_tokens,
        strip_stopwords=options.modeling_strip_stopwords,
    )
    return messages.withColumn("message_for_modeling", modeling).withColumns(
        {
            "message_len_chars": F.length(text),
            "message_len_words": word_count(text),
            "message_modeling_len_tokens": word_count(F.col("message_for_modeling")),
            **flag_columns(text, options.flags),
        }
    )


def drop_duplicates(messages: DataFrame, options: MessageOptions = MessageOptions()) -> DataFrame:
    """Exact copies in one chat keep their lowest row id."""
    return keep_first(messages, DEDUP_KEY, ["source_row_id"]) if options.deduplicate else messages


def kept_messages(canonical: DataFrame, options: MessageOptions = MessageOptions()) -> DataFrame:
    """Filters, then exact de-duplication."""
    return drop_duplicates(filter_messages(canonical, options), options)


def user_messages(canonical: DataFrame, options: MessageOptions = MessageOptions()) -> DataFrame:
    """Canonical table -> cleaned, de-duplicated user messages with features and flags.

    Cheap filters come first, one exchange removes duplicates, and only the
    survivors pay for the modelling text and the flag patterns.
    """
    columns = [
        "source_row_id", "timestamp", "user", "chat_uuid", "chat_title", "role", "message", "message_raw",
        "message_len_chars", "message_len_words", "message_for_modeling", "message_modeling_len_tokens",
        "date", "week", "month", *options.flags,
    ]
    featured = text_features(kept_messages(canonical, options), options)
    return featured.withColumns(calendar_features(F.col("timestamp"))).select(*columns)
