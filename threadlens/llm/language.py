"""Language identification: a bidirectional gated recurrent network labels every byte, a document pools its labels.

The network reads one word at a time (lower-cased runs of letters, with an edge on both sides; runs of over 24 bytes in
pieces), so the labels of a word are the same wherever it stands and are computed once for each different word that a
task meets.  A document's probabilities are the normalised exponentials of the mean log probabilities of all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks, byte_class, hash_words, owners, utf8, word_spans
from .gru import Network, padded

#: Bytes of text that are labelled at once.
BLOCK_BYTES = 1 << 20
#: Documents of each language learned from at most (lowest hashes of their ids), languages, and words of each language.
MAX_DOCUMENTS, MAX_LANGUAGES, MAX_WORDS = 300, 200, 4_000
SIZE, ROUNDS, STEPS, BATCH, RATE, SEED = 16, 6, 300, 128, 0.02, 7
PIECE = 24
#: Words whose labels a task remembers.
REMEMBERED = 400_000
UNKNOWN = "und"
LETTER = byte_class((0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Model:
    languages: list[str]
    network: Network | None


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, and start, end and text of each piece of a word, of the lower-cased texts."""
    data, offsets = utf8(pc.utf8_lower(batch["text"].cast(pa.large_string())))
    starts, ends, first = word_spans(data, offsets, LETTER)
    text, pieces = owners(first), -(-(ends - starts) // PIECE)
    if len(pieces) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends, text = np.repeat(starts, pieces) + PIECE * nth, np.repeat(ends, pieces), np.repeat(text, pieces)
        ends = np.minimum(ends, starts + PIECE)
    return data, starts, ends, text


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    whole = data.tobytes()
    return [whole[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


# --- learning -------------------------------------------------------------------------


def training_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n): the most frequent words of a bounded sample of the rows of ``docs`` that have a lang."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    named = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang").withColumn("rank", F.row_number().over(order))
    named = named.where(F.col("rank") <= MAX_DOCUMENTS).orderBy("rank", "lang").limit(MAX_DOCUMENTS * MAX_LANGUAGES).select("doc_id")
    sample = docs.select("doc_id", "lang", "text").join(F.broadcast(named.distinct()), "doc_id", "left_semi").where("lang IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, size=BLOCK_BYTES):
            data, starts, ends, text = _words(batch)
            langs = batch["lang"].take(pa.array(text)) if len(text) else pa.array([], pa.string())
            found = pa.table({"lang": langs, "word": pa.array(_cut(data, starts, ends), pa.binary())})
            found = found.group_by(["lang", "word"]).aggregate([([], "count_all")]).rename_columns(["lang", "word", "n"])
            yield from found.combine_chunks().to_batches()

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, word binary, n bigint")
    summed = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    return summed.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= MAX_WORDS).drop("rank")


def learn(docs: DataFrame) -> Model:
    """A network fitted on the words of at most ``MAX_DOCUMENTS`` documents of each language (columns doc_id, text, lang)."""
    rows = sorted(training_words(docs).collect(), key=lambda r: (r.lang, bytes(r.word)))
    languages = sorted({r.lang for r in rows})[:MAX_LANGUAGES]
    if not languages:
        return Model([], None)
    rows = [r for r in rows if r.lang in set(languages)]
    target = np.array([languages.index(r.lang) for r in rows])
    weight = np.sqrt(np.array([r.n for r in rows], np.float32))
    weight /= np.bincount(target, weight)[target]
    network = Network.fresh(len(languages), SIZE, SEED)
    rounds = max(ROUNDS, -(-STEPS // -(-len(rows) // BATCH)))  # few words are read more often
    network.train([bytes(r.word) for r in rows], target, weight, rounds, BATCH, RATE, SEED)
    return Model(languages, network)


# --- prediction -----------------------------------------------------------------------


def word_labels(network: Network, words: list[bytes]) -> np.ndarray:
    """Log probabilities of the languages, summed over the bytes of each word."""
    out = np.zeros((len(words), len(network.bias)))
    order = np.argsort([len(w) for w in words], kind="stable")
    for i in range(0, len(order), 4096):
        at = order[i : i + 4096]
        rows, lengths = padded([words[j] for j in at])
        logs = network.positions(rows, lengths)
        place = np.arange(rows.shape[1])[None, :]
        inside = (place >= 1) & (place < lengths[:, None] - 1)
        out[at] = (logs * inside[:, :, None]).sum(axis=1)
    return out


class _Memory:
    """Labels of the words met so far, found by their hashes."""

    def __init__(self, network: Network):
        self.network, self.hashes, self.labels = network, np.zeros(0, np.uint64), np.zeros((0, len(network.bias)))

    def of(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~np.isin(distinct, self.hashes, assume_unique=True)
        if new.any():
            if len(self.hashes) > REMEMBERED:
                self.hashes, self.labels, new = self.hashes[:0], self.labels[:0], np.ones(len(distinct), bool)
            made = word_labels(self.network, _cut(data, starts[at[new]], ends[at[new]]))
            merged = np.concatenate([self.hashes, distinct[new]])
            order = np.argsort(merged)
            self.hashes, self.labels = merged[order], np.concatenate([self.labels, made])[order]
        return self.labels[np.searchsorted(self.hashes, distinct)][back]


def _labelled(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    """Each batch with the language and score of its texts."""
    memory = _Memory(model.network) if model.network else None
    for batch in blocks(batches, size=BLOCK_BYTES):
        n = batch.num_rows
        if memory is None:
            yield batch, [UNKNOWN] * n, np.zeros(n)
            continue
        letters = pc.match_substring_regex(batch["text"].fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
        data, starts, ends, text = _words(batch)
        labels = memory.of(hash_words(data, starts, ends), data, starts, ends)
        sums = np.stack([np.bincount(text, labels[:, c], n) for c in range(labels.shape[1])], axis=1)
        size = np.bincount(text, ends - starts, n)
        mean = sums / np.maximum(size, 1)[:, None]
        chances = np.exp(mean - mean.max(axis=1, keepdims=True))
        chances /= chances.sum(axis=1, keepdims=True)
        best = chances.argmax(axis=1)
        known = letters & (size > 0)
        score = np.where(known, np.round(chances[np.arange(n), best], 6), 0.0)
        yield batch, [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred and score, the pooled probability of that language.

    Null texts and texts without a letter have ``und`` and score 0, and so has every text if nothing was learned from.
    Repeated rows are judged each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, score in _labelled(batches, model):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more; columns as given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, score in _labelled(batches, model):
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, score.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
