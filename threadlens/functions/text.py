"""Text functions as plain column expressions (no Python workers)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(text: Column) -> Column:
    """Collapse every run of Unicode whitespace to one space and trim."""
    return F.trim(F.regexp_replace(text, fixed.UNCLEAN_WHITESPACE, " "))


def strip_text(text: Column) -> Column:
    """Trim Unicode whitespace at both ends only."""
    ws = fixed.WHITESPACE.removeprefix("(?U)")
    return F.regexp_replace(text, rf"(?U)^{ws}|{ws}\z", "")


def word_count(clean: Column) -> Column:
    """Number of words in cleaned text, where each space stands between two words."""
    spaces = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.when(clean == "", F.lit(0)).otherwise(spaces + 1)


def _mask(lowered: Column, word: str, pattern: str) -> Column:
    needles = fixed.MASK_NEEDLES.get(word)
    if not needles:
        return F.regexp_replace(lowered, pattern, f" {word} ")

    def guarded(text: Column) -> Column:
        possible = reduce(Column.__or__, [text.contains(needle) for needle in needles])
        return F.when(possible, F.regexp_replace(text, pattern, f" {word} ")).otherwise(text)

    return let(lowered, guarded)


def mask_entities(lowered: Column) -> Column:
    """Replace URLs, e-mails, paths, ids, dates and long numbers by a word each.

    A plain substring search spares most texts the costlier patterns.
    """
    return reduce(lambda text, mask: _mask(text, *mask), fixed.MASKS, lowered)


def strip_punctuation(masked: Column) -> Column:
    unfenced = F.replace(masked, F.lit(fixed.CODE_FENCE), F.lit(" "))
    return clean_text(F.regexp_replace(unfenced, fixed.PUNCTUATION, " "))


def modeling_tokens(
    clean: Column,
    max_tokens: int | None = None,
    strip_stopwords: bool = True,
    stopwords: Sequence[str] = fixed.MODELING_STOPWORDS,
    token_pattern: str = fixed.MODELING_TOKEN,
) -> Column:
    """Tokens of cleaned text that a topic model should see; never empty."""
    lowered = F.lower(clean)
    prepared = strip_punctuation(mask_entities(lowered))
    trimmed = F.transform(
        F.regexp_extract_all(prepared, F.lit(token_pattern), F.lit(0)),
        lambda t: F.btrim(t, F.lit(fixed.MODELING_TOKEN_EDGES)),
    )

    def wanted(token: Column) -> Column:
        keep = F.length(token) >= 2
        return keep & ~token.isin(*stopwords) if strip_stopwords and stopwords else keep

    tokens = F.filter(trimmed, wanted)
    if max_tokens:
        tokens = F.slice(tokens, 1, max_tokens)
    raw = F.regexp_extract_all(lowered, F.lit(token_pattern), F.lit(0))
    if max_tokens is not None:
        raw = F.slice(raw, 1, max(max_tokens, 1))
    fallback = let(raw, lambda r: F.when(F.size(r) > 0, r).otherwise(F.array(F.lit(fixed.MODELING_EMPTY))))
    return let(tokens, lambda t: F.when(F.size(t) > 0, t).otherwise(fallback))


def modeling_text(clean: Column, enabled: bool = True, **options) -> Column:
    """Modelling tokens joined by a space, or just the lowered text if disabled."""
    return F.array_join(modeling_tokens(clean, **options), " ") if enabled else F.lower(clean)


def keyword_tokens(text: Column, stopwords: Sequence[str] = fixed.KEYWORD_STOPWORDS) -> Column:
    """Lowered keyword tokens without stop words and pure numbers."""
    found = F.regexp_extract_all(F.lower(text), F.lit(fixed.KEYWORD_TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stopwords) & ~t.rlike("^[0-9]+$"))


def words(text: Column) -> Column:
    """Words of lowered text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(fixed.VECTORIZER_TOKEN), F.lit(0))


def ngrams(text: Column, low: int = 1, high: int = 1) -> Column:
    """Word n-grams of lowered text, lengths ``low`` to ``high``."""

    def grams(tokens: Column, n: int) -> Column:
        if n == 1:
            return tokens
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.coalesce(joined, F.array().cast("array<string>"))

    if high == 1:
        return words(text)
    return let(words(text), lambda w: F.concat(*[grams(w, n) for n in range(low, high + 1)]))


def auto_title(keywords: Column, fallback: Column) -> Column:
    """First three keywords, or the fallback when there are none."""
    return F.coalesce(F.when(F.size(keywords) > 0, F.array_join(F.slice(keywords, 1, 3), ", ")), fallback)


def display_title(llm_title: Column, title: Column, topic_id: Column) -> Column:
    """Enriched title unless blank, else the automatic one, else ``topic_<id>``."""
    return F.coalesce(
        F.when(strip_text(llm_title) != "", llm_title), title, F.concat(F.lit("topic_"), topic_id.cast("string"))
    )


def embedding_input(text: Column, max_chars: int | None = None, strip_nul: bool = True) -> Column:
    """What the embedding model is given: NULs to spaces, then the model's length limit."""
    if strip_nul:
        text = F.replace(text, F.lit("\0"), F.lit(" "))
    return F.substring(text, 1, max_chars) if max_chars is not None else text


def embedding_key(prepared: Column, *identity: object) -> Column:
    """Content hash of a prepared text under one provider/model identity."""
    return F.sha1(F.concat_ws("::", *[F.lit(str(part)) for part in identity], prepared))
