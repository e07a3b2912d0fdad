"""Quality rules: counts of every text, then a likelihood ratio between trusted documents and the whole corpus.

All 4-byte sequences of the texts (A-Z folded, every white space a blank) are hashed into 2^18 places.  Two multinomials
over the places are estimated, one from trusted documents and one from all documents; a text's verdict is the mean
logarithm of their ratio over its sequences against one threshold for all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DARK, LOWER, blocks, byte_class, grams, hash_words, mix, owners, staged, utf8, word_spans

PLACES = 1 << 18
GRAM = 4
REPEAT = 8
#: Least words, and most percent of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 20, 30
#: The threshold lies as far below this quantile of trusted scores as the quantile lies below their median.
LOW = 0.001
#: Places of the grid for each unit of the mean log ratio.
GRID = 10_000
#: The trusted multinomial is fitted on so many documents at most, those whose ids hash lowest; all else covers all rows.
MAX_TRUSTED = 200_000
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
LEAD = ~byte_class((0x80, 0xBF))  # first bytes of code points
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def repeats(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether (text, value) comes more than once, for each row, by sorting."""
    order = np.lexsort((value, text))
    same = (text[order][1:] == text[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(text), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text of a block."""
    starts, ends, first = word_spans(data, offsets, DARK)
    hashes = hash_words(data, starts, ends)
    text = owners(first)
    windows = grams(hashes, REPEAT)
    whole = np.flatnonzero(np.arange(len(windows)) + REPEAT <= first[1:][text[: len(windows)]])
    again = whole[repeats(text[whole], windows[whole])]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT, -1)
    covered = np.cumsum(change[:-1]) > 0
    line_starts, line_ends, line_first = word_spans(data, offsets, ~byte_class((0x0A, 0x0A)))
    dark = np.concatenate([[0], np.cumsum(DARK[data], dtype=np.int64)])
    said = dark[line_ends] > dark[line_starts]
    line_text, line_hash = owners(line_first)[said], hash_words(data, line_starts[said], line_ends[said])
    order = np.lexsort((line_hash, line_text))
    copy = (line_text[order][1:] == line_text[order][:-1]) & (line_hash[order][1:] == line_hash[order][:-1])
    dup = np.bincount(line_text[order][1:][copy], minlength=len(offsets) - 1)
    return [np.diff(first), _per_text(DARK[data] & LEAD[data], offsets), _per_text(SYMBOL[data], offsets), dup, _per_text(covered, first)]


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each 4-byte sequence that lies in one text, and for each text the number of sequences before it."""
    low = np.where(DARK[data], LOWER[data], np.uint8(0x20))
    n = max(0, len(low) - GRAM + 1)
    key = np.zeros(n, np.uint64)
    for i in range(GRAM):
        key = (key << np.uint64(8)) | low[i : i + n]
    sizes = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    cut = np.zeros(len(low) + 1, np.int64)
    inner = offsets[1:-1]
    for i in range(1, GRAM):  # sequences that begin up to three bytes before the end of a text
        cut[np.maximum(inner - i, 0)[inner >= i]] = 1
    whole = cut[:n] == 0
    return (mix(key[whole]) & np.uint64(PLACES - 1)).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def place_counts(docs: DataFrame) -> np.ndarray:
    """How often each place occurs in all texts; each task sends one number for each place at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PLACES, np.int64)
        for batch in blocks(batches):
            total += np.bincount(places(*utf8(batch["text"]))[0], minlength=PLACES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["place", "n"])

    found = docs.select("text").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(PLACES)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out


def log_ratio(trusted: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Logarithm of the ratio of the two multinomials at each place, each smoothed towards the corpus."""
    raw = (corpus + 0.5) / (corpus + 0.5).sum()
    return np.log((trusted + 0.5 * PLACES * raw) / (trusted.sum() + 0.5 * PLACES) / raw).astype(np.float32)


def score(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """Per row: doc_id, the base counts and ``llr``, the mean log ratio of its sequences (0 without any)."""
    weights = docs.sparkSession.sparkContext.broadcast(ratio)  # one megabyte, whatever the corpus
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, offsets = utf8(batch["text"])
            at, first = places(data, offsets)
            sums = np.diff(np.concatenate([[0.0], np.cumsum(weights.value[at], dtype=np.float64)])[first])
            llr = np.round(sums / np.maximum(np.diff(first), 1), 9)  # the block a text shares does not show
            columns = [pa.array(c.astype(np.int64)) for c in base_counts(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns, pa.array(llr)], ["doc_id", *(c.split()[0] for c in BASE.split(", ")), "llr"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {BASE}, llr double")


def exact_threshold(passed: DataFrame) -> float:
    """Twice the ``LOW`` quantile less the median of ``llr``, both exact on a grid; minus infinity without rows.

    All rows are counted by their place on the grid, so the order and partitions of the table do not show.  Mean log ratios
    lie between the bounds of the weights, so there are some 200,000 places at most.
    """
    cells = passed.groupBy(F.round(F.col("llr") * GRID).cast("bigint").alias("cell")).agg(F.count("*").alias("n")).orderBy("cell").toArrow()
    if not cells.num_rows:
        return float("-inf")
    upto = np.cumsum(cells["n"].to_numpy())
    low, middle = (int(cells["cell"].to_numpy()[np.searchsorted(upto, q * upto[-1])]) for q in (LOW, 0.5))
    return (2 * low - middle) / GRID


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, base counts, base_failed, llr, threshold and kept.

    Trusted are the documents with ``labels.quality`` 1.  The ratio is fitted on one half of them, by a hash of the id;
    the threshold comes from all scores of the other half and holds for every document.  Without trusted documents it
    is minus infinity.  Null and empty texts have counts of 0 and fail; repeated rows are judged each; a doc_id
    labelled twice counts once.
    """
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("half", F.xxhash64("doc_id", F.lit("half")) % 2 == 0)
    fitted = good.where("half").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRUSTED)  # a few megabytes, so texts stay where they are
    trusted = docs.select("doc_id", "text").join(F.broadcast(fitted), "doc_id", "left_semi")
    scored = staged(score(docs, log_ratio(place_counts(trusted), place_counts(docs))), "scores")
    passed = scored.where(f"n_words >= {MIN_WORDS}").join(good.where("NOT half"), "doc_id", "left_semi")
    threshold = exact_threshold(passed)
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words")
    out = scored.withColumn("base_failed", failed).withColumn("threshold", F.lit(threshold))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.col("threshold")))
